"""Operator 5: an interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark,
kept as sorted hash arrays and memory-mapped by the workers that score.

1. Words (64-bit hashes) are counted with map-side combine; each hash range becomes
   one sorted array with counts. A word's id is its position in that order.
2. Bigrams (id, id) are counted per task, packed per shard (sorted, delta coded,
   compressed) and merged shard by shard into sorted arrays. A shard holds all
   bigrams of a range of contexts; a context with more than a shard's share of all
   tokens gets as many shards of its own as it has shares, by ranges of its second
   word, and its totals are added up. So the shards and their files grow with the corpus.
3. Contexts get their total and the number of followers seen once, twice and more;
   second words get their number of distinct contexts (the unigram level).
   Order 3 counts trigrams in one such pass instead, with compact arrays: bigrams then
   count their distinct words before (those at the start of a text their occurrences).
4. Scoring maps the arrays and looks up the sorted distinct keys of a block of texts.

P(w|uv) = max(c(uvw) - D(c), 0) / c(uv.) + g(uv) P(w|v) in order 3;
P(w|v) = max(c(vw) - D(c), 0) / c(v.) + g(v) P(w); P(w) is the same over numbers of
distinct contexts, interpolated with 1 / (V + 1). Discounts follow from the counts of
counts of each level. The driver holds shard names, counts of counts and the totals
of about one heavy context and two hot bigrams per shard; the model grows with the corpus in the
shared folder only.

Edge cases: null and empty texts are one end token; a null id is trained on and not
held out; no training rows give uniform scores; equal rows count each; a word never
seen gets its share of 1 / (V + 1); extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import crc_remainder, materialize, slices
from pushlake.llm._words import END_HASH, claim, hashes, words
from pushlake.llm.arrays import Shard, SortedArrays, SplitArrays, write_array, write_compact, write_split
from pushlake.session import scratch_path

HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 7, 2
SHARD_TOKENS = 4_000_000
BLOCK_TOKENS = 500_000
#: Rows of a batch that are turned into Python objects at a time (some 1 million words).
SLICE_ROWS = 2000
SHIFT = np.uint64(32)
LOW = np.uint64(0xFFFFFFFF)


@dataclass
class Model:
    vocab: SortedArrays
    bigrams: SortedArrays
    contexts: SortedArrays
    heads: SortedArrays  # second words: number of distinct contexts
    tokens: int = 0
    types: int = 0
    bigram_types: int = 0
    order: int = 2
    pasts: SplitArrays | None = None  # order 3: totals of (word, word before it)
    hot: np.ndarray | None = None  # order 3: bigrams spread over shards, sorted
    hot_counts: np.ndarray | None = None  # their numbers of distinct words before
    hot_trigrams: SplitArrays | None = None  # (number of the hot bigram, word before)
    discounts: dict = field(default_factory=dict)  # level -> (D1, D2, D3)
    uniform: float = 1.0  # weight of 1 / (V + 1) at the unigram level


def _blocks(texts: list) -> "iter":
    """Token hashes of about BLOCK_TOKENS tokens at a time: (first row, flat hashes,
    length of each row); each row ends with the end token."""
    at, rows, n = 0, [], 0
    end = np.array([END_HASH], np.uint64)
    for i, x in enumerate(texts):
        h = hashes(words(x))
        rows.append(np.concatenate([h, end]))
        n += len(h) + 1
        if n >= BLOCK_TOKENS or i == len(texts) - 1:
            yield at, np.concatenate(rows), np.array([len(r) for r in rows])
            at, rows, n = i + 1, [], 0


def _previous(ids: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The token before each token; ``start`` before the first of a row."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return before


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted uint64 keys and counts, delta coded by byte planes."""
    deltas = np.diff(keys, prepend=np.uint64(0))
    planes = deltas.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(keys).to_bytes(8, "little") + zlib.compress(planes, 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(zlib.decompress(blob[8:]), np.uint8)
    deltas = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    counts = np.ascontiguousarray(planes[8 * n :].reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(deltas, dtype=np.uint64), counts


def _merge(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sum packed counts by key."""
    parts = [_unpack(b) for b in blobs]
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _shards(rows: list, columns: list[tuple[str, str]], named: bool = False) -> SortedArrays:
    """Shard table from rows (first, last, count, files) in key order; the names of
    compact files (``named``) begin with their columns."""
    out, base = [], 0
    for r in sorted((r for r in rows if r["count"]), key=lambda r: int(r["first"])):
        files = tuple((u.rpartition("/")[2].partition(".")[0], "", u) for u in r["files"]) if named else tuple((n, k, u) for (n, k), u in zip(columns, r["files"]))
        out.append(Shard(base, r["count"], int(r["first"]), int(r["last"]), files))
        base += r["count"]
    return SortedArrays(out)


META = "first string, last string, count long, files array<string>"


def _meta(keys: np.ndarray, files: list[str]) -> dict:
    return {"first": str(int(keys[0])) if len(keys) else "0", "last": str(int(keys[-1])) if len(keys) else "0", "count": len(keys), "files": files}


def _count_words(texts: DataFrame, folder: str, n_shards: int) -> tuple[SortedArrays, int, int]:
    """Sorted word hashes with counts; number of tokens; number of types."""

    def count(batches):
        claim()
        for batch in slices(batches, SLICE_ROWS):
            for _, flat, _ in _blocks(batch.column(0).to_pylist()):
                keys, counts = np.unique(flat, return_counts=True)
                shard = (keys >> SHIFT) * np.uint64(n_shards) >> SHIFT
                cut = np.searchsorted(shard, np.arange(n_shards + 1, dtype=np.uint64))
                used = [s for s in range(n_shards) if cut[s] < cut[s + 1]]
                blobs = [_pack(keys[cut[s] : cut[s + 1]], counts[cut[s] : cut[s + 1]]) for s in used]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

    def build(t: pa.Table) -> pa.Table:
        keys, counts = _merge(t.column("blob").to_pylist())
        files = [write_array(folder, "words", keys), write_array(folder, "counts", counts)]
        return pa.Table.from_pylist([_meta(keys, files) | {"tokens": int(counts.sum())}], pa.schema([("first", pa.string()), ("last", pa.string()), ("count", pa.int64()), ("files", pa.list_(pa.string())), ("tokens", pa.int64())]))

    packed = texts.mapInArrow(count, "shard int, blob binary")
    rows = packed.groupBy("shard").applyInArrow(build, META + ", tokens long").collect()  # one row per shard
    return _shards(rows, [("key", "<u8"), ("count", "<i8")]), sum(r["tokens"] for r in rows), sum(r["count"] for r in rows)


@dataclass
class _Spread:
    """Sorted keys with shards of their own: as many as a key has shares of the tokens,
    by ranges of the id of another word."""

    keys: np.ndarray
    first: np.ndarray  # number of the key's first shard
    pieces: np.ndarray
    span: np.uint64  # number of ids
    after: int  # number of the next shard

    def shards(self, keys: np.ndarray, others: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """The shard of each key with its other word; ``rest`` for keys that have none."""
        if not len(self.keys):
            return rest
        rank, mine = _ranks(self.keys, keys)
        return np.where(mine, self.first[rank] + others * self.pieces[rank] // self.span, rest)


def _spread(counts: dict[int, int], share: float, span: np.uint64, base: int) -> _Spread:
    """Shards from number ``base`` on for keys with these numbers of tokens."""
    keys = sorted(counts)
    pieces = np.array([max(1, math.ceil(counts[k] / share)) for k in keys], np.uint64)
    ends = np.uint64(base) + np.cumsum(pieces, dtype=np.uint64)
    return _Spread(np.array(keys, np.uint64), ends - pieces, pieces, span, int(ends[-1]) if keys else base)


def _heavy(vocab: SortedArrays, tokens: int, n_shards: int, start: int) -> tuple[_Spread, int]:
    """Contexts with more than a shard's share of the tokens (fewer than ``n_shards`` of
    them) and the start mark, and the number of shards of all other contexts, which come
    first. Reads one shard at a time."""
    counts = {}
    for i, shard in enumerate(vocab.shards):
        found = vocab._column(i, "count")
        counts |= {shard.base + int(k): int(found[k]) for k in np.flatnonzero(found * n_shards > tokens)}
    n_light = max(1, math.ceil((tokens - sum(counts.values())) * n_shards / tokens))
    # as many starts as ends
    counts[start] = int(vocab.find(np.array([END_HASH], np.uint64), ["count"])["count"][0])
    return _spread(counts, tokens / n_shards, np.uint64(start + 1), n_light), n_light


def _count_bigrams(texts: DataFrame, folder: str, model: Model, n_shards: int):
    """Bigram, context and second-word arrays."""
    vocab, types = model.vocab, model.types
    start = types
    span = np.uint64(types + 1)
    spread, n_light = _heavy(vocab, model.tokens, n_shards, start)
    heavy = spread.keys

    def count(batches):
        claim()
        for batch in slices(batches, SLICE_ROWS):
            for _, flat, lengths in _blocks(batch.column(0).to_pylist()):
                distinct, back = np.unique(flat, return_inverse=True)
                ids = vocab.find(distinct, ["position"])["position"][back].astype(np.uint64)
                keys, counts = np.unique(_previous(ids, lengths, start) << SHIFT | ids, return_counts=True)
                first, second = keys >> SHIFT, keys & LOW
                shard = spread.shards(first, second, first * np.uint64(n_light) // span)
                order = np.argsort(shard, kind="stable")
                keys, counts, shard = keys[order], counts[order], shard[order]
                cut = np.searchsorted(shard, np.arange(spread.after + 1, dtype=np.uint64))
                used = [s for s in range(spread.after) if cut[s] < cut[s + 1]]
                blobs = [_pack(keys[cut[s] : cut[s + 1]], counts[cut[s] : cut[s + 1]]) for s in used]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

    schema = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("blob", pa.binary()), ("files", pa.list_(pa.string())), ("first", pa.string()), ("last", pa.string()), ("count", pa.int64()), ("numbers", pa.list_(pa.int64()))])

    def build(t: pa.Table) -> pa.Table:
        keys, counts = _merge(t.column("blob").to_pylist())
        rows = [{"kind": "bigrams", "numbers": [int((counts == k).sum()) for k in (1, 2, 3, 4)]}]
        context = keys >> SHIFT
        rows[0] |= _meta(keys, [write_array(folder, "bigrams", keys), write_array(folder, "counts", counts)])
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        totals = [np.add.reduceat(x, first) for x in (counts, (counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts >= 3).astype(np.int64))]
        owners = context[first]
        if np.isin(owners, heavy).any():  # a piece of one heavy context
            rows.append({"kind": "heavy", "numbers": [int(owners[0]), *[int(x[0]) for x in totals]]})
        else:
            rows.append(_meta(owners, [write_array(folder, "contexts", owners), *[write_array(folder, "totals", x) for x in totals]]) | {"kind": "contexts"})
        seconds, n = np.unique(keys & LOW, return_counts=True)
        target = seconds * np.uint64(n_shards) // span
        cut = np.searchsorted(target, np.arange(n_shards + 1, dtype=np.uint64))
        rows += [{"kind": "heads", "shard": s, "blob": _pack(seconds[cut[s] : cut[s + 1]], n[cut[s] : cut[s + 1]])} for s in range(n_shards) if cut[s] < cut[s + 1]]
        return pa.Table.from_pylist(rows, schema)

    def build_heads(t: pa.Table) -> pa.Table:
        keys, counts = _merge(t.column("blob").to_pylist())
        files = [write_array(folder, "heads", keys), write_array(folder, "counts", counts)]
        row = _meta(keys, files) | {"numbers": [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int((counts >= 3).sum())]}
        return pa.Table.from_pylist([row], pa.schema([schema.field(n) for n in ("first", "last", "count", "files", "numbers")]))

    kinds = "kind string, shard int, blob binary, files array<string>, first string, last string, count long, numbers array<long>"
    built = materialize(texts.mapInArrow(count, "shard int, blob binary").groupBy("shard").applyInArrow(build, kinds), "bigrams")
    # shard names, counts of counts and heavy contexts: a few rows per shard
    rows = built.filter("kind <> 'heads'").drop("blob").collect()
    heads = built.filter("kind = 'heads'").select("shard", "blob").groupBy("shard").applyInArrow(build_heads, META + ", numbers array<long>").collect()
    model.bigrams = _shards([r for r in rows if r["kind"] == "bigrams"], [("key", "<u8"), ("count", "<i8")])
    model.contexts = _shards([r for r in rows if r["kind"] == "contexts"], [("key", "<u8"), *[(n, "<i8") for n in ("total", "n1", "n2", "n3")]])
    model.heads = _shards(heads, [("key", "<u8"), ("count", "<i8")])
    model.bigram_types = sum(r["count"] for r in rows if r["kind"] == "bigrams")
    totals: dict[int, np.ndarray] = {}
    for r in rows:
        if r["kind"] == "heavy":
            totals[r["numbers"][0]] = totals.get(r["numbers"][0], 0) + np.array(r["numbers"][1:])
    high = [sum(r["numbers"][k] for r in rows if r["kind"] == "bigrams" and r["numbers"]) for k in range(4)]
    low = [sum(r["numbers"][k] for r in heads) for k in range(5)]
    model.discounts = {"bigram": _discounts(high), "unigram": _discounts(low[:4])}
    d1, d2, d3 = model.discounts["unigram"]
    if model.bigram_types:
        model.uniform = (d1 * low[0] + d2 * low[1] + d3 * low[4]) / model.bigram_types
    return totals


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; 0 < D(k) < k holds them
    where a small corpus gives none."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))


def _hot_pairs(texts: DataFrame, model: Model, n_shards: int, spread: _Spread) -> _Spread:
    """Bigrams of heavy words with about a shard's share of the tokens, from a sample:
    fewer than 2 * ``n_shards`` of them. They only decide which shards count what."""
    heavy = spread.keys[spread.keys < model.types]
    if not len(heavy):
        return _spread({}, 1, spread.span, spread.after)
    vocab = model.vocab
    share = min(1.0, max(0.01, 1e6 / model.tokens))

    def count(batches):
        claim()
        for batch in slices(batches, SLICE_ROWS):
            for _, flat, lengths in _blocks(batch.column(0).to_pylist()):
                distinct, back = np.unique(flat, return_inverse=True)
                ids = vocab.find(distinct, ["position"])["position"][back].astype(np.uint64)
                before = _previous(ids, lengths, model.types)
                pairs = (before << SHIFT | ids)[np.isin(ids, heavy) & np.isin(before, heavy)]
                keys, counts = np.unique(pairs, return_counts=True)
                total = np.array([len(ids)])
                columns = [np.append(keys >> SHIFT, 0), np.append(keys & LOW, 0), np.append(counts, total), np.append(np.ones(len(keys), bool), False)]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(np.int64)), pa.array(columns[3].astype(bool))], names=["v", "w", "n", "pair"])

    found = texts.sample(share, 1).mapInArrow(count, "v long, w long, n long, pair boolean").groupBy("pair", "v", "w").agg(F.sum("n").alias("n"))
    rows = found.orderBy("pair", F.desc("n")).limit(2 * n_shards + 1).collect()  # the total, then the largest
    total = sum(r["n"] for r in rows if not r["pair"])
    counts = {r["v"] << 32 | r["w"]: r["n"] for r in rows if r["pair"] and r["n"] * 2 * n_shards > total}
    return _spread(counts, max(total, 1) / n_shards, spread.span, spread.after)


def _sums(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Columns summed by key, in key order."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], [np.add.reduceat(x[order], first) if len(keys) else x for x in columns]


def _marks(counts: np.ndarray) -> list[np.ndarray]:
    return [counts, (counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts >= 3).astype(np.int64)]


def _tally(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _split_shards(rows: list) -> SplitArrays:
    return SplitArrays(_shards([r for r in rows if r["count"]], [], named=True).shards)


def _write_pasts(folder: str, keys: np.ndarray, totals: list[np.ndarray]) -> list[str]:
    """Contexts of two words; equal rows of (total, n1, n2, n3) are kept once."""
    code = np.zeros(len(keys), np.uint64)
    for x in totals:
        code = np.unique(code << SHIFT | x.astype(np.uint64), return_inverse=True)[1].astype(np.uint64)
    rows = np.unique(code, return_index=True)[1]
    names = ("total", "n1", "n2", "n3")
    return write_split(folder, keys, code=code) + [write_compact(folder, n, x[rows]) for n, x in zip(names, totals)]


def _count_trigrams(texts: DataFrame, folder: str, model: Model, n_shards: int):
    """All levels of order 3 from one pass. A trigram (u, v, w) is counted where the
    bigram (v, w) lies, which gives the bigram's distinct words before it and, as all
    of v lies there, the totals of the context (u, v). Heavy v are spread by w, hot
    (v, w) by u; their partial totals are added up."""
    vocab, start = model.vocab, model.types
    span = np.uint64(start + 1)
    spread, n_light = _heavy(vocab, model.tokens, n_shards, start)
    spread_hot = _hot_pairs(texts, model, n_shards, spread)
    heavy, hot = spread.keys, spread_hot.keys

    def count(batches):
        claim()
        for batch in slices(batches, SLICE_ROWS):
            for _, flat, lengths in _blocks(batch.column(0).to_pylist()):
                distinct, back = np.unique(flat, return_inverse=True)
                ids = vocab.find(distinct, ["position"])["position"][back].astype(np.uint64)
                before = _previous(ids, lengths, start)
                pairs, which = np.unique(before << SHIFT | ids, return_inverse=True)
                keys, counts = np.unique(which.astype(np.uint64) << SHIFT | _previous(before, lengths, start), return_counts=True)
                place = spread.shards(pairs >> SHIFT, pairs & LOW, (pairs >> SHIFT) * np.uint64(n_light) // span)
                pair = (keys >> SHIFT).astype(np.int64)
                shard = spread_hot.shards(pairs[pair], keys & LOW, place[pair])
                order = np.argsort(shard, kind="stable")
                keys, counts, shard = keys[order], counts[order], shard[order]
                cut = np.searchsorted(shard, np.arange(spread_hot.after + 1, dtype=np.uint64))
                used = [s for s in range(spread_hot.after) if cut[s] < cut[s + 1]]
                blobs = []
                for s in used:
                    mine, inverse = np.unique(keys[cut[s] : cut[s + 1]] >> SHIFT, return_inverse=True)
                    head = _pack(pairs[mine.astype(np.int64)], np.zeros(len(mine)))
                    tail = _pack(inverse.astype(np.uint64) << SHIFT | keys[cut[s] : cut[s + 1]] & LOW, counts[cut[s] : cut[s + 1]])
                    blobs.append(len(head).to_bytes(8, "little") + head + tail)
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])

    schema = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("blob", pa.binary()), ("files", pa.list_(pa.string())), ("first", pa.string()), ("last", pa.string()), ("count", pa.int64()), ("numbers", pa.list_(pa.int64()))])

    def build(t: pa.Table) -> pa.Table:
        parts = []
        for blob in t.column("blob").to_pylist():
            n = 8 + int.from_bytes(blob[:8], "little")
            parts.append((_unpack(blob[8:n])[0], *_unpack(blob[n:])))
        keys = np.unique(np.concatenate([p for p, _, _ in parts]))
        trigrams = np.concatenate([np.searchsorted(keys, p)[(k >> SHIFT).astype(np.int64)].astype(np.uint64) << SHIFT | k & LOW for p, k, _ in parts])
        trigrams, (times,) = _sums(trigrams, [np.concatenate([c for _, _, c in parts]).astype(np.int64)])
        del parts
        local, past = (trigrams >> SHIFT).astype(np.int64), trigrams & LOW
        first = keys >> SHIFT
        inner = first[local] != start
        rows = [{"kind": "trigrams", "numbers": _tally(times[inner])}]
        # contexts of two words: whole here for light v, partial for heavy v, which fills its shards alone
        contexts, totals = _sums((first[local] << SHIFT | past)[inner], _marks(times[inner]))
        if np.isin(first, heavy).any():
            target = spread.shards(contexts >> SHIFT, contexts & LOW, np.zeros(len(contexts), np.uint64))
            for s in np.unique(target):
                mine = target == s
                packed = [_pack(contexts[mine], x[mine]) for x in totals]
                rows.append({"kind": "shared", "shard": int(s), "blob": b"".join(len(b).to_bytes(8, "little") + b for b in packed)})
        else:
            rows.append(_meta(contexts, _write_pasts(folder, contexts, totals)) | {"kind": "pasts"})
        # hot bigrams: the words before them that fall to this shard
        is_hot = np.isin(keys, hot)
        for k in np.flatnonzero(is_hot):
            rank, mine = int(np.searchsorted(hot, keys[k])), local == k
            own = np.uint64(rank) << SHIFT | past[mine]
            rows.append(_meta(own, write_split(folder, own, count=times[mine])) | {"kind": "hot", "numbers": [rank, int(mine.sum())]})
        number = np.bincount(local, minlength=len(keys))
        counts = np.where(first == start, np.bincount(local, times, len(keys)).astype(np.int64), number)
        if not is_hot.all():  # a shard holds one hot bigram or none
            files = write_split(folder, keys, count=counts, members=np.append(0, np.cumsum(number)))
            files += [write_compact(folder, "member", past), write_compact(folder, "times", times)]
            rows.append(_meta(keys, files) | {"kind": "bigrams", "numbers": _tally(counts)})
        keys, counts = keys[~is_hot], counts[~is_hot]
        owners, totals = _sums(keys >> SHIFT, _marks(counts))
        if np.isin(owners, heavy).any():
            rows.append({"kind": "heavy", "numbers": [int(owners[0]), *[int(x[0]) for x in totals]]})
        elif len(owners):
            rows.append(_meta(owners, [write_array(folder, "contexts", owners), *[write_array(folder, "totals", x) for x in totals]]) | {"kind": "contexts"})
        seconds, n = np.unique(keys & LOW, return_counts=True)
        rows += _heads(seconds, n)
        return pa.Table.from_pylist(rows, schema)

    def _heads(seconds: np.ndarray, n: np.ndarray) -> list[dict]:
        cut = np.searchsorted(seconds * np.uint64(n_shards) // span, np.arange(n_shards + 1, dtype=np.uint64))
        return [{"kind": "heads", "shard": s, "blob": _pack(seconds[cut[s] : cut[s + 1]], n[cut[s] : cut[s + 1]])} for s in range(n_shards) if cut[s] < cut[s + 1]]

    def build_second(t: pa.Table) -> pa.Table:
        blobs, kind = t.column("blob").to_pylist(), t.column("kind")[0].as_py()
        if kind == "heads":
            keys, counts = _merge(blobs)
            row = _meta(keys, [write_array(folder, "heads", keys), write_array(folder, "counts", counts)])
            return pa.Table.from_pylist([row | {"kind": kind, "numbers": _tally(counts) + [int((counts >= 3).sum())]}], schema)
        columns: list[list] = [[], [], [], [], []]
        for blob in blobs:
            at = 0
            for k in range(4):
                n = at + 8 + int.from_bytes(blob[at : at + 8], "little")
                keys, values = _unpack(blob[at + 8 : n])
                columns[k + 1].append(values.astype(np.int64))
                at = n
            columns[0].append(keys)
        keys, totals = _sums(np.concatenate(columns[0]), [np.concatenate(c) for c in columns[1:]])
        return pa.Table.from_pylist([_meta(keys, _write_pasts(folder, keys, totals)) | {"kind": "pasts"}], schema)

    kinds = "kind string, shard int, blob binary, files array<string>, first string, last string, count long, numbers array<long>"
    built = materialize(texts.mapInArrow(count, "shard int, blob binary").groupBy("shard").applyInArrow(build, kinds), "trigrams")
    # shard names, counts of counts, heavy contexts and hot bigrams: a few rows per shard
    rows = built.filter("kind not in ('heads', 'shared')").drop("blob").collect()
    second = built.filter("kind in ('heads', 'shared')").select("kind", "shard", "blob")
    before = np.zeros(len(hot), np.int64)
    for r in rows:
        if r["kind"] == "hot":
            before[r["numbers"][0]] += r["numbers"][1]
    seconds, n = np.unique(hot & LOW, return_counts=True)
    if len(hot):
        extra = [(r["kind"], r["shard"], bytearray(r["blob"])) for r in _heads(seconds, n)]
        second = second.unionByName(texts.sparkSession.createDataFrame(extra, "kind string, shard int, blob binary"))
    rows += second.groupBy("kind", "shard").applyInArrow(build_second, kinds).drop("blob").collect()
    of = lambda kind: [r for r in rows if r["kind"] == kind]
    model.bigrams, model.pasts, model.hot_trigrams = _split_shards(of("bigrams")), _split_shards(of("pasts")), _split_shards(of("hot"))
    model.hot, model.hot_counts = hot, before
    model.contexts = _shards(of("contexts"), [("key", "<u8"), *[(n, "<i8") for n in ("total", "n1", "n2", "n3")]])
    model.heads = _shards(of("heads"), [("key", "<u8"), ("count", "<i8")])
    model.bigram_types = sum(r["count"] for r in of("bigrams")) + len(hot)
    totals: dict[int, np.ndarray] = {}
    for r in of("heavy"):
        totals[r["numbers"][0]] = totals.get(r["numbers"][0], 0) + np.array(r["numbers"][1:])
    for k, x in zip(hot.tolist(), before):
        totals[k >> 32] = totals.get(k >> 32, 0) + np.array([x, x == 1, x == 2, x >= 3], np.int64)
    add = lambda kind, width: [sum(r["numbers"][k] for r in of(kind)) for k in range(width)]
    low = add("heads", 5)
    high = [a + b for a, b in zip(add("bigrams", 4), _tally(before))]
    model.discounts = {"trigram": _discounts(add("trigrams", 4)), "bigram": _discounts(high), "unigram": _discounts(low[:4])}
    d1, d2, d3 = model.discounts["unigram"]
    model.uniform = (d1 * low[0] + d2 * low[1] + d3 * low[4]) / model.bigram_types
    return totals


def train(docs: DataFrame, text_col: str = "text", order: int = 2) -> tuple[Model, dict]:
    """Model of order 2 or 3 of all rows of ``docs``, and the totals of its heavy
    contexts."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: the model has order 2 or 3")
    spark = docs.sparkSession
    texts = docs.select(docs[text_col].cast("string").alias("text"))
    folder = scratch_path(spark, "ngrams")
    # a shard is some 4 million tokens, estimated from the length of all texts
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n_shards = max(8, math.ceil(chars / 6 / SHARD_TOKENS))
    vocab, tokens, types = _count_words(texts, folder, n_shards)
    empty = SortedArrays([])
    model = Model(vocab, empty, empty, empty, tokens, types, order=order)
    count = _count_trigrams if order == 3 else _count_bigrams
    return model, (count(texts, folder, model, n_shards) if tokens else {})


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.select([counts == 0, counts == 1, counts == 2], [0.0, d[0], d[1]], d[2]), 0.0)


def _score_block(model: Model, heavy: dict, flat: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    rows = np.cumsum(lengths) - lengths
    n, v = model.tokens, model.types
    distinct, back = np.unique(flat, return_inverse=True)
    got = model.vocab.find(distinct, ["count", "position"])
    counts = got["count"]
    base = np.log10((counts + 1) / (n + (v + 1)))
    ids = np.where(got["position"] < 0, v + 1, got["position"]).astype(np.uint64)  # v: start mark, v + 1: unknown
    # unigram level, on distinct words
    order = np.argsort(ids, kind="stable")
    cont = np.zeros(len(ids), np.int64)
    cont[order] = _on_sorted(model.heads, ids[order], ["count"])["count"]
    if model.bigram_types:
        unigram = _discounted(cont, model.discounts["unigram"]) / model.bigram_types + model.uniform / (v + 1)
    else:
        unigram = np.full(len(ids), 1.0 / (v + 1))
    word = ids[back]
    before = _previous(word, lengths, v)
    keys, inverse = np.unique(before << SHIFT | word, return_inverse=True)
    at = model.bigrams.find(keys, ["count", "position"])
    pair = at["count"]
    if model.hot is not None and len(model.hot):
        rank, is_hot = _ranks(model.hot, keys)
        pair[is_hot] = model.hot_counts[rank[is_hot]]
    context, which = np.unique(keys >> SHIFT, return_inverse=True)
    total = {c: x.astype(float) for c, x in model.contexts.find(context, ["total", "n1", "n2", "n3"]).items()}
    for k, t in heavy.items():
        i = int(np.searchsorted(context, np.uint64(k)))
        if i < len(context) and context[i] == k:
            for c, x in zip(("total", "n1", "n2", "n3"), t):
                total[c][i] = x
    seen = np.maximum(total["total"], 1)
    d = model.discounts.get("bigram", (0.5, 1.0, 1.5))
    gamma = np.where(total["total"] > 0, (d[0] * total["n1"] + d[1] * total["n2"] + d[2] * total["n3"]) / seen, 1.0)
    high = (_discounted(pair, d) / seen[which])[inverse]
    p = high + gamma[which][inverse] * unigram[back]
    if model.pasts is not None:
        past = _previous(before, lengths, v)
        inner = np.flatnonzero(before != v)  # the first word of a text has one word of context
        p[inner] = _third(model, keys, at["position"], inverse[inner], before[inner], past[inner], p[inner])
    return {
        "n_known": np.add.reduceat((counts > 0).astype(np.int64)[back], rows),
        "base_score": np.add.reduceat(base[back], rows),
        "score": np.add.reduceat(np.log10(p), rows),
    }


def _ranks(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    rank = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return rank, table[rank] == keys


def _third(model: Model, pairs: np.ndarray, position: np.ndarray, which: np.ndarray, before: np.ndarray, past: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The trigram level over ``p``, of tokens that are bigram ``which`` after ``past``."""
    contexts, back = np.unique(before << SHIFT | past, return_inverse=True)
    total = {c: x.astype(float) for c, x in model.pasts.coded(contexts, ["total", "n1", "n2", "n3"]).items()}
    # trigrams in the order of their bigram's place in the arrays
    order = np.argsort(position, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    keys, inverse = np.unique(place[which].astype(np.uint64) << SHIFT | past, return_inverse=True)
    pair, words_before = order[(keys >> SHIFT).astype(np.int64)], keys & LOW
    times = model.bigrams.times(position[pair], words_before)
    if len(model.hot):
        rank, is_hot = _ranks(model.hot, pairs[pair])
        hot = rank[is_hot].astype(np.uint64) << SHIFT | words_before[is_hot]
        times[is_hot] = _on_sorted(model.hot_trigrams, hot, ["count"])["count"]
    d = model.discounts["trigram"]
    seen = np.maximum(total["total"], 1)
    gamma = np.where(total["total"] > 0, (d[0] * total["n1"] + d[1] * total["n2"] + d[2] * total["n3"]) / seen, 1.0)
    return _discounted(times, d)[inverse] / seen[back] + gamma[back] * p


def _on_sorted(arrays: SortedArrays, keys: np.ndarray, columns: list[str]) -> dict[str, np.ndarray]:
    """``find`` for sorted keys that may repeat."""
    distinct, back = np.unique(keys, return_inverse=True)
    return {c: x[back] for c, x in arrays.find(distinct, columns).items()}


def score(docs: DataFrame, model: Model, heavy: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, perplexity) of every text."""

    def run(batches):
        claim()
        for batch in slices(batches, SLICE_ROWS):
            texts = batch.column(1).to_pylist()
            for at, flat, lengths in _blocks(texts):
                got = _score_block(model, heavy, flat, lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(lengths)), pa.array(lengths.astype(np.int64)), *[pa.array(got[c]) for c in ("n_known", "base_score", "score")], pa.array(10 ** (-got["score"] / lengths))],
                    names=["id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
                )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens long, n_known long, base_score double, score double, perplexity double"
    )


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_remainder(id_col, HELD_OUT_MODULUS) == HELD_OUT_REMAINDER, F.lit(False))


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """Learn from the rows that are not held out, score all rows."""
    model, heavy = train(docs.filter(~held_out(id_col)), text_col, order)
    out = score(docs, model, heavy, id_col, text_col).withColumnRenamed("id", id_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
