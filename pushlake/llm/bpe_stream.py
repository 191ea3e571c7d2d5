"""Operator 1: byte-pair encoding and decoding as a bounded-lookahead transducer.

``sufficient_lookahead`` derives from the merge list how many bytes to the right of
a token can still change it. A piece of text is read through a window: the window
is merged, tokens that end at least that many bytes before its end are final and
are emitted, and the window slides on from there (merging never crosses a final
token border, so restarting at one gives the same tokens). Working memory is one
window and one text segment, however long a text or an unbroken word is. Decoding
feeds token bytes to an incremental UTF-8 state machine.

Edge cases: null text counts as empty (no ids, empty decoded text); strings of
special tokens in a text become their one special id, as the tokenizers library
does by default; ids of other columns or repeated rows need no care, since rows are
handled one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
from bisect import bisect_left
from itertools import chain
from typing import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pushlake.llm._util import broadcast_bytes, only_cache, slices
from pushlake.llm.bpe import MergeList, Splitter, merge

#: Fixed split pattern of byte-level vocabularies.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SEGMENT_CHARS = 1 << 16
CACHED_PIECE_CHARS = 48
CACHED_PIECES = 300_000


def sufficient_lookahead(merges: MergeList) -> int:
    """Bytes to the right of a token that can still change it, from the merge list.

    A token ending at p changes only if a rule (s, c) takes a part s of its right
    spine before that part's own merge. Whether c stands at p by then depends in the
    same way on what follows c, and only on rules of lower rank. So
    reach(s, c) = |c| + the largest reach of a lower-ranked rule whose left side lies
    on the right spine of c and that would come before the spine's own merge.
    Ranks strictly fall along the chain, so one pass in rank order computes it."""
    size: dict[int, int] = {}
    made_by: dict[int, tuple[int, int]] = {}  # token -> (rank of its rule, right part)
    ranks: dict[int, list[int]] = {}  # left side -> ranks of its rules, ascending
    best: dict[int, list[int]] = {}  # the same length: largest reach so far
    for i in merges.byte_ids:
        size[i] = 1
    top = 0
    for rank, (a, b, c) in enumerate(merges.rules):
        size[c] = size[a] + size[b]
        longest, part, limit = 0, b, rank
        while True:
            if part in ranks:
                k = bisect_left(ranks[part], limit)
                if k:
                    longest = max(longest, best[part][k - 1])
            if part not in made_by:
                break
            limit, part = made_by[part]
        reach = size[b] + longest
        top = max(top, reach)
        ranks.setdefault(a, []).append(rank)
        best.setdefault(a, []).append(max(reach, best[a][-1]) if best.get(a) else reach)
        made_by.setdefault(c, (rank, b))
    return top


class Transducer:
    """Streaming encoder and decoder of one vocabulary."""

    def __init__(self, data: bytes):
        self.merges = MergeList(data)
        self.lookahead = sufficient_lookahead(self.merges)
        self.window = max(1024, 4 * self.lookahead)
        self.pieces = Splitter(BYTE_LEVEL_PATTERN)
        self.special = regex.compile("|".join(regex.escape(s) for s in self.merges.specials)) if self.merges.specials else None
        table = self.merges.token_bytes()
        self.bytes_of = [table.get(i, b"") for i in range(max(table) + 1)]
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        self.cache: dict[str, tuple[int, ...]] = {}

    def _stable(self, data: bytes) -> Iterator[list[int]]:
        """Tokens of one piece, emitted as soon as they are final."""
        byte_ids, pairs, bytes_of = self.merges.byte_ids, self.merges.pairs, self.bytes_of
        start, window = 0, self.window
        while start < len(data):
            end = min(len(data), start + window)
            symbols = [byte_ids[b] for b in data[start:end]]
            merge(symbols, pairs)
            tokens = [t for t in symbols if t >= 0]
            if end < len(data):
                final, at = 0, start
                for t in tokens:
                    at += len(bytes_of[t])
                    if at > end - self.lookahead:
                        break
                    final += 1
                    start = at
                if not final:
                    window *= 2
                    continue
                tokens = tokens[:final]
            else:
                start = end
            yield tokens

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = tuple(chain.from_iterable(self._stable(piece.encode())))
        if len(piece) <= CACHED_PIECE_CHARS:
            if len(self.cache) >= CACHED_PIECES:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def _segments(self, text: str) -> Iterator[str]:
        """Cut a long text where a space follows a non-space: no piece spans that."""
        start = 0
        while len(text) - start > SEGMENT_CHARS:
            at = text.rfind(" ", start + 1, start + SEGMENT_CHARS)
            while at > start and text[at - 1].isspace():
                at = text.rfind(" ", start + 1, at)
            if at <= start:
                at = text.find(" ", start + SEGMENT_CHARS)
                while at > 0 and text[at - 1].isspace():
                    at = text.find(" ", at + 1)
                if at < 0:
                    break
            yield text[start:at]
            start = at
        yield text[start:]

    def _ordinary(self, text: str) -> Iterator[list[int]]:
        get, miss = self.cache.get, self._piece
        for segment in self._segments(text):
            yield list(chain.from_iterable([get(p) or miss(p) for p in self.pieces.findall(segment)]))

    def encode(self, text: str) -> Iterator[list[int]]:
        """Id lists of successive parts of ``text``."""
        at = 0
        if self.special is not None and "<" in text:
            for m in self.special.finditer(text):
                yield from self._ordinary(text[at : m.start()])
                yield [self.merges.specials[m.group()]]
                at = m.end()
        yield from self._ordinary(text[at:] if at else text)

    def decode(self, parts: Iterator[list[int]]) -> Iterator[str]:
        """Text of successive id lists; a character split over tokens or parts waits
        in the state machine, invalid bytes become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in parts:
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))
        yield machine.decode(b"", True)


_TRANSDUCERS: dict[int, Transducer] = {}


def _transducer(shared) -> Transducer:
    """One transducer per Python worker and broadcast."""
    key = id(shared.value)
    if key not in _TRANSDUCERS:
        _TRANSDUCERS.clear()
        _TRANSDUCERS[key] = Transducer(shared.value)
    only_cache("pieces", _TRANSDUCERS[key].cache)
    return _TRANSDUCERS[key]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids: array<int>): the token ids of every text."""
    shared = broadcast_bytes(docs.sparkSession, open(vocabulary, "rb").read())

    def run(batches):
        t = _transducer(shared)
        for batch in slices(batches):
            ids = [list(chain.from_iterable(t.encode(x or ""))) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Rows (id, text) from rows (id, ids)."""
    shared = broadcast_bytes(encoded.sparkSession, open(vocabulary, "rb").read())

    def run(batches):
        t = _transducer(shared)
        for batch in slices(batches):
            texts = ["".join(t.decode([x or []])) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = dict(encoded.dtypes)["id"]
    return encoded.select("id", "ids").mapInArrow(run, f"id {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text as one stream: (id, n_tokens, ids_sha256,
    decoded_sha256, round_trip). No id list or decoded text is held whole."""
    shared = broadcast_bytes(docs.sparkSession, open(vocabulary, "rb").read())

    def run(batches):
        t = _transducer(shared)
        text_of = t.text_of
        for batch in slices(batches):
            counts, id_hash, text_hash, same = [], [], [], []
            for x in batch.column(1).to_pylist():
                x = x or ""
                hi, ht, n = hashlib.sha256(), hashlib.sha256(), 0

                def tee():
                    nonlocal n
                    for ids in t.encode(x):
                        if ids:
                            hi.update(((b"," if n else b"") + ",".join(map(text_of.__getitem__, ids)).encode()))
                            n += len(ids)
                            yield ids

                for part in t.decode(tee()):
                    ht.update(part.encode())
                counts.append(n)
                id_hash.append(hi.hexdigest())
                text_hash.append(ht.hexdigest())
                same.append(ht.digest() == hashlib.sha256(x.encode()).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string()), pa.array(same, pa.bool_())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"],
            )

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    )
    return out.withColumnRenamed("id", id_col)
