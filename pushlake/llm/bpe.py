"""Byte-pair merging shared by operators 1 and 10: the merge list and one
heap-and-linked-list merger.

The vocabulary file is a parameter. Its bytes are read once on the driver, bounded
by ``MAX_BROADCAST_BYTES`` and broadcast, so executors need no copy of the file.
"""

from __future__ import annotations

import heapq
import json
import re

import regex

SHIFT = 20
MASK = (1 << SHIFT) - 1
POS_BITS = 32
POS_MASK = (1 << POS_BITS) - 1


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte:
    printable Latin-1 bytes stand for themselves, the others are numbered from 256."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class MergeList:
    """Vocabulary, merge ranks and special strings of a tokenizer file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        if model["type"] != "BPE":
            raise ValueError("not a byte-pair vocabulary")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.symbols = byte_symbols()
        #: (left << SHIFT | right) -> rank << SHIFT | merged id
        self.pairs: dict[int, int] = {}
        #: (left, right, merged) ids in rank order
        self.rules: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, c = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.pairs[a << SHIFT | b] = rank << SHIFT | c
            self.rules.append((a, b, c))
        self.byte_ids = [self.vocab[s] for s in self.symbols]
        self.last_byte_ids = [self.vocab[s + self.suffix] for s in self.symbols]

    def token_bytes(self) -> dict[int, bytes]:
        """The bytes of every id; special strings stand for their own UTF-8."""
        back = {s: b for b, s in enumerate(self.symbols)}
        out = {}
        for token, i in self.vocab.items():
            out[i] = bytes(back[ch] for ch in token) if all(ch in back for ch in token) else token.encode()
        for token, i in self.specials.items():
            out[i] = token.encode()
        return out


def merge(symbols: list[int], pairs: dict[int, int]) -> int:
    """Merge ``symbols`` in place: a heap gives the lowest-rank adjacent pair
    (leftmost on ties), a doubly linked list of positions joins it, until no pair
    has a rank. Merged-away positions hold -1. Returns the number of merges."""
    n = len(symbols)
    heap = []
    get = pairs.get
    for i in range(n - 1):
        rule = get(symbols[i] << SHIFT | symbols[i + 1])
        if rule is not None:
            heap.append(rule >> SHIFT << POS_BITS | i)
    if not heap:
        return 0
    heapq.heapify(heap)
    push, pop = heapq.heappush, heapq.heappop
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = pop(heap)
        i = entry & POS_MASK
        a, j = symbols[i], after[i]
        if a < 0 or j >= n:
            continue
        rule = get(a << SHIFT | symbols[j])
        if rule is None or rule >> SHIFT != entry >> POS_BITS:
            continue  # the pair at this position has changed since it was pushed
        merged = rule & MASK
        symbols[i], symbols[j] = merged, -1
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            rule = get(merged << SHIFT | symbols[k])
            if rule is not None:
                push(heap, rule >> SHIFT << POS_BITS | i)
        h = before[i]
        if h >= 0:
            rule = get(symbols[h] << SHIFT | merged)
            if rule is not None:
                push(heap, rule >> SHIFT << POS_BITS | h)
    return merges


#: Ranges of letters and digits that are newer than the character tables of
#: the tokenizer library, which takes them for neither.
LATER_RANGES = [
    (0x0558, 0x0558), (0x058B, 0x058C), (0x088F, 0x088F), (0x0C5C, 0x0C5C), (0x0CDC, 0x0CDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]


class Splitter:
    """A split pattern with the letters and digits of the tokenizer library: texts without
    a later character take the plain pattern."""

    def __init__(self, pattern: str):
        later = "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER_RANGES)
        exact = pattern.replace(r"[^\s\p{L}\p{N}]", "(?:<other>)").replace(r"\p{L}", f"[\\p{{L}}--[{later}]]").replace(r"\p{N}", f"[\\p{{N}}--[{later}]]")
        self._plain = regex.compile(pattern)
        self._exact = regex.compile(exact.replace("<other>", rf"[^\s\p{{L}}\p{{N}}]|[{later}]"), regex.VERSION1)
        self._high = re.compile(f"[{chr(LATER_RANGES[0][0])}-\U0010ffff]")
        self._later = regex.compile(f"[{later}]")

    def findall(self, text: str) -> list[str]:
        if not text.isascii() and self._high.search(text) and self._later.search(text):
            return self._exact.findall(text)
        return self._plain.findall(text)
