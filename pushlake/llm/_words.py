"""Word and shingle hashes of texts, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from pushlake.llm._util import only_cache

#: Hash of the end-of-text token (no word is empty).
END_HASH = xxhash.xxh64_intdigest(b"")
MAX_CACHED = 300_000
SHINGLE_WORDS = 5
_MULTIPLIERS = np.random.default_rng(20240501).integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """64-bit hash of a word; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased words between the separators 0x20 and 0x09-0x0D (exactly the
    white space of bytes.split). Null: none."""
    return text.encode().lower().split() if text else []


def hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))


def claim() -> None:
    """Called once per task by operators that hash words."""
    only_cache("word hashes", _HASHES)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray) -> np.ndarray:
    """Sorted distinct 5-word shingle hashes; the whole sequence when shorter."""
    n = len(h)
    if n == 0:
        return h
    w = min(n, SHINGLE_WORDS)
    total = np.full(n - w + 1, w, np.uint64)
    for k in range(w):
        total += h[k : n - w + 1 + k] * _MULTIPLIERS[k]
    return np.unique(mix(total))
