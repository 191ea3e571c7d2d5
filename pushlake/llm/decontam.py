"""Operator 2: benchmark decontamination by q-gram lemma filtering.

A benchmark item leaks into a document when some window of ``WINDOW`` characters of
the item (the whole item when shorter) occurs there with at most ``EDITS`` edits per
window. By the q-gram lemma such a region shares at least
``window + 1 - q * (edits + 1)`` q-grams with it, inside a band of neighbouring
diagonals. So: (1) windows of a text with too few q-grams of any item are skipped;
(2) the remaining shared q-grams are counted per (document, item) in overlapping
diagonal bands; (3) regions that reach the count are verified by banded alignment.
Steps 1 and 2 lose nothing, step 3 decides. Texts are compared lower-cased with
white space runs as one space.

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters: each block is
broadcast and all documents pass it, so a benchmark of any size works and nothing
grows with the documents. There is no shuffle of documents and no group to be hot.

An item shorter than ``WINDOW`` has fewer edits, so that one common q-gram is left at
least: none below 24 characters, one below 36. An item shorter than a q-gram is found
where it stands exactly between word borders.

Edge cases: null or empty texts match nothing; an empty item matches nothing; items with
equal text each get a row; equal documents each get rows; item ids may be numbers or
texts, null too; very long texts are searched whole, region by region; an empty table on
either side gives an empty result; extra columns are ignored. One row per (document,
item): the first verified region.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import broadcast_bytes, slices

Q = 12
WINDOW = 80
EDITS = 5
BLOCK_CHARS = 2_000_000
#: Characters of documents handled at a time.
TEXT_CHARS = 1 << 20
FILTER_BITS = 21
HITS_AT_ONCE = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BREAK = 0x110000  # not a character: ends every text
_SPACES = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029, 0x3000], np.uint32)


def edit_budget(length: int) -> int:
    """Edits allowed in a window of ``length`` characters: EDITS in WINDOW, but fewer in a
    short one, where so many could leave it without a common q-gram."""
    return max(0, min(length * EDITS // WINDOW, (length - Q) // Q))


def least_shared(length: int) -> int:
    """Shared q-grams that a window within its edit budget has at least."""
    return length + 1 - Q * (edit_budget(length) + 1)


def _codes(text: str) -> np.ndarray:
    lower = text.lower()
    if len(lower) != len(text):  # keep one code point per code point
        lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, lower case, one space per white space run; and where each was."""
    codes = _codes(text)
    blank = np.isin(codes, _SPACES)
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    if len(keep):
        keep[0] = ~blank[0]
    at = np.flatnonzero(keep)
    codes = np.where(blank[at], np.uint32(32), codes[at])
    if len(codes) and codes[-1] == 32:
        codes, at = codes[:-1], at[:-1]
    return codes, at


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place (q = 12 = 8 + 4, by doubling)."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = codes.astype(np.uint64) + np.uint64(1)
    two = h[:-1] * _STEP + h[1:]
    two ^= two >> np.uint64(29)
    four = two[:-2] * _STEP + two[2:]
    four ^= four >> np.uint64(31)
    eight = four[:-4] * _STEP + four[4:]
    eight ^= eight >> np.uint64(30)
    out = eight[:n] * _STEP + four[8 : 8 + n]
    return out ^ (out >> np.uint64(32))


class _Block:
    """q-gram index of one block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.codes = [normalise(text)[0] for _, text in items]
        self.lengths = np.array([min(WINDOW, len(c)) for c in self.codes])
        grams = [_grams(c) for c in self.codes]
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.starts = np.unique(flat[order], return_index=True)
        self.stops = np.append(self.starts[1:], len(flat))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        used = self.lengths[[len(g) > 0 for g in grams]] if grams else self.lengths
        self.least = min((least_shared(int(n)) for n in set(used.tolist())), default=1)
        self.short: dict[bytes, list[int]] = {}
        for k, c in enumerate(self.codes):
            if 0 < len(c) < Q:
                self.short.setdefault(c.tobytes(), []).append(k)
        self.short_sizes = sorted({len(c) for c in self.codes if 0 < len(c) < Q})

    def exact_short(self, codes: np.ndarray) -> dict:
        """Items without a q-gram, where they stand between word borders."""
        found: dict[int, tuple[int, int, int]] = {}
        padded = np.concatenate([[32], codes, [32]]).astype(np.uint32)
        borders = np.flatnonzero(padded == 32)
        for n in self.short_sizes:
            for at in borders[(borders + n + 1 < len(padded)) & (padded[np.minimum(borders + n + 1, len(padded) - 1)] == 32)].tolist():
                for k in self.short.get(padded[at + 1 : at + 1 + n].tobytes(), ()):
                    found.setdefault(k, (at, at + n, 0))
        return found

    def dense(self, grams: np.ndarray) -> np.ndarray:
        """Places of grams that lie in some window with enough shared grams."""
        hit = self.filter[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
        span = WINDOW - Q + 1
        total = np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
        n = len(grams)
        ends = np.minimum(np.arange(n) + span, n)
        rich = total[ends] - total[:n] >= self.least  # window starting here
        reach = np.concatenate([[0], np.cumsum(rich, dtype=np.int32)])
        begins = np.maximum(np.arange(n) - span + 1, 0)
        return np.flatnonzero(hit & (reach[1:] > reach[begins]))

    def hits(self, grams: np.ndarray, places: np.ndarray):
        """(place, item, item place) of all equal q-grams, in bounded parts."""
        at = np.searchsorted(self.keys, grams[places])
        at = np.minimum(at, len(self.keys) - 1)
        same = self.keys[at] == grams[places]
        places, at = places[same], at[same]
        count = self.stops[at] - self.starts[at]
        return places, at, count

    def expand(self, places, at, count):
        total = int(count.sum())
        which = np.repeat(np.arange(len(places)), count)
        inner = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        entry = self.starts[at][which] + inner
        return places[which], self.item[entry], self.place[entry]

    def verify(self, text: np.ndarray, k: int, low: int, high: int, first: int, last: int) -> int | None:
        """Fewest edits of a window of item k that holds the q-grams at item places
        first..last, aligned to ``text`` on diagonals low..high (text place minus item
        place); None beyond the budget. All windows advance together."""
        item, w = self.codes[k], int(self.lengths[k])
        budget = edit_budget(w)
        starts = np.arange(max(0, last + Q - w), min(first, len(item) - w) + 1)
        if not len(starts):
            return None
        low, high = low - budget, high + budget
        width = high - low + 1
        lean = np.arange(width)
        cost = np.zeros((len(starts), width), np.int32)
        for r in range(w):
            place = starts[:, None] + r + low + lean[None, :]
            inside = (place >= 0) & (place < len(text))
            equal = inside & (text[np.clip(place, 0, len(text) - 1)] == item[starts + r][:, None])
            step = cost + ~equal
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(step - lean, axis=1) + lean
        best = int(cost.min())
        return best if best <= budget else None

    def search(self, codes: np.ndarray, grams: np.ndarray):
        """(item number, start, end, edits) of one text with at least one rich window."""
        found = {}
        places = self.dense(grams)
        if not len(places):
            return found
        places, at, count = self.hits(grams, places)
        cut = 0
        while cut < len(places):
            # a part ends after HITS_AT_ONCE hits; parts overlap by one window
            stop = int(np.searchsorted(np.cumsum(count[cut:]), HITS_AT_ONCE, "right")) + cut + 1
            stop = min(max(stop, int(np.searchsorted(places, places[cut] + 2 * WINDOW))), len(places))
            self._regions(codes, *self.expand(places[cut:stop], at[cut:stop], count[cut:stop]), found)
            if stop == len(places):
                break
            cut = max(cut + 1, int(np.searchsorted(places, places[stop - 1] - WINDOW)))
        return found

    def _regions(self, codes, place, item, inner, found) -> None:
        diagonal = place - inner
        band = EDITS + 1
        for shift in (0, band):  # two sets of bands of width 2 * band that overlap by half
            b = (diagonal + shift) // (2 * band)
            order = np.lexsort((place, b, item))
            o_item, o_b, o_place, o_inner = item[order], b[order], place[order], inner[order]
            need = np.array([least_shared(max(int(n), Q)) for n in self.lengths])[o_item]
            reach = np.arange(len(order)) + need - 1
            ok = reach < len(order)
            last = np.minimum(reach, len(order) - 1)
            ok &= (o_item[last] == o_item) & (o_b[last] == o_b) & (o_place[last] - o_place <= self.lengths[o_item] - Q + EDITS)
            for i in np.flatnonzero(ok).tolist():
                k = int(o_item[i])
                if k in found:
                    continue
                j = int(last[i])
                low = int(o_b[i]) * 2 * band - shift
                seen = o_inner[i : j + 1]
                edits = self.verify(codes, k, low, low + 2 * band - 1, int(seen.min()), int(seen.max()))
                if edits is None:
                    continue
                end = j
                while end + 1 < len(order) and o_item[end + 1] == k and o_b[end + 1] == o_b[i] and o_place[end + 1] - o_place[end] <= WINDOW:
                    end += 1
                found[k] = (int(o_place[i]), int(o_place[end]) + Q, edits)


def names_type(names: list) -> pa.DataType:
    return pa.string() if any(isinstance(n, str) for n in names) else pa.int64()


def _scan(batches, shared):
    items = pickle.loads(shared.value)
    block = _Block(items)
    short = bool(block.short)
    names = [i for i, _ in items]
    for batch in slices(batches):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows, at = [], 0
        while at < len(texts):
            part, n, stop = [], 0, at
            while stop < len(texts) and (n == 0 or n < TEXT_CHARS):
                part.append(normalise(texts[stop] or ""))
                n += len(part[-1][0]) + 1
                stop += 1
            flat = np.concatenate([x for c, _ in part for x in (c, np.array([_BREAK], np.uint32))])
            begin = np.cumsum([0] + [len(c) + 1 for c, _ in part])
            grams = _grams(flat)
            rich = np.unique(np.searchsorted(begin, block.dense(grams), "right") - 1) if len(block.keys) and len(grams) else []
            for d in rich:
                codes, where = part[d]
                for k, (lo, hi, edits) in block.search(codes, grams[begin[d] : max(begin[d], begin[d] + len(codes) - Q + 1)]).items():
                    rows.append((ids[at + d], names[k], int(where[lo]), int(where[hi - 1]) + 1, edits))
            if short:
                for d, (codes, where) in enumerate(part):
                    for k, (lo, hi, edits) in block.exact_short(codes).items():
                        rows.append((ids[at + d], names[k], int(where[lo]), int(where[hi - 1]) + 1, edits))
            at = stop
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], names_type(names)), *[pa.array(c, pa.int64()) for c in cols[2:]]], names=["id", "item_id", "start", "end", "edits"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, start, end, edits): the first region of every document that
    holds a window of an item; offsets are code points of the original text."""
    spark = docs.sparkSession
    number = dict(benchmark.dtypes)[item_col] in ("tinyint", "smallint", "int", "bigint")
    items = benchmark.select(benchmark[item_col].cast("long" if number else "string").alias("item"), benchmark[item_text].cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    out = None
    for b in range(blocks):
        # one block of the stated query set: about BLOCK_CHARS characters, size-checked
        rows = [(r["item"], r["text"]) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()]
        shared = broadcast_bytes(spark, pickle.dumps(sorted(rows, key=lambda r: (r[0] is None, r[0] or (0 if number else ""), r[1]))))
        part = texts.mapInArrow(lambda batches, shared=shared: _scan(batches, shared), f"id {kind}, item_id {'long' if number else 'string'}, start long, end long, edits long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)
