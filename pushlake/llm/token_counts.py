"""Operator 10: token counts by heap-and-linked-list byte-pair merging.

Each word starts as its byte symbols; the lowest-rank adjacent pair is popped and
merged until none is left; the count is the number of initial symbols minus the
number of merges. No token list is built. Normalisation, word split and special
strings follow the vocabulary file (canonical composition, lower case per
character, white space dropped, a word-end mark on the last symbol).

Edge cases: null text counts as empty (0 bytes, 0 tokens); a special string in a
text is one token; very long texts are counted whole, in memory that grows with the
longest word only; an empty table gives an empty result. Rows are independent, so
repeated rows, ties and extra columns need no care.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import broadcast_bytes, only_cache, slices
from pushlake.llm.bpe import MergeList, Splitter, merge

#: Fixed word pattern of this vocabulary family.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"""

#: Letters whose lower case is newer than Python's character tables.
LATER_LOWER = {0xA7CB: 0x0264, 0xA7DC: 0x019B} | {c: c + 1 for c in (0x1C89, 0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)}
LATER_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}

CACHED_WORD_CHARS = 48
CACHED_WORDS = 400_000


class TokenCounter:
    def __init__(self, data: bytes):
        self.merges = MergeList(data)
        self.words = Splitter(WORD_PATTERN)
        self.special = regex.compile("|".join(regex.escape(s) for s in self.merges.specials)) if self.merges.specials else None
        self.later = regex.compile("[" + "".join(map(chr, LATER_LOWER)) + "]")
        self.cache: dict[str, int] = {}

    def _word(self, word: str) -> int:
        data = word.encode()
        symbols = [self.merges.byte_ids[b] for b in data]
        symbols[-1] = self.merges.last_byte_ids[data[-1]]
        n = len(symbols) - merge(symbols, self.merges.pairs)
        if len(word) <= CACHED_WORD_CHARS:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = n
        return n

    def _ordinary(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final-sigma rule
            text = text.translate(LATER_LOWER) if self.later.search(text) else text
        get, miss = self.cache.get, self._word
        return sum([get(w) or miss(w) for w in self.words.findall(text.lower())])

    def count(self, text: str) -> int:
        if self.special is None or "<" not in text:
            return self._ordinary(text)
        n = at = 0
        for m in self.special.finditer(text):
            n += self._ordinary(text[at : m.start()]) + 1
            at = m.end()
        return n + self._ordinary(text[at:])


_COUNTERS: dict[int, TokenCounter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text."""
    shared = broadcast_bytes(docs.sparkSession, open(vocabulary, "rb").read())

    def run(batches):
        key = id(shared.value)
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = TokenCounter(shared.value)
        counter = _COUNTERS[key]
        only_cache("word counts", counter.cache)
        for batch in slices(batches):
            counts = [counter.count(x) if x else 0 for x in batch.column(1).to_pylist()]
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
