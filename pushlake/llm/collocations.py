"""Operator 11: collocations of every language by Toivonen's sampling method.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at
spaces and tabs into words. A phrase of up to ``MAX_WORDS`` words is frequent with at
least ``MIN_COUNT`` occurrences inside pieces of its language.

1. A sample of the documents (by a hash of id and text) is mined at a lowered threshold.
   Its phrases are the proposal.
2. One pass over all documents counts the proposal and its negative border: phrases not
   proposed, but without their first and without their last word they are (and all single
   words). Most of these are rare, so their occurrences are counted in 2**36 hash buckets:
   a bucket under the threshold holds no frequent phrase.
3. A full bucket of the border is a failure of the sample. A further pass counts the
   phrases in full buckets one by one, and with them all longer phrases that were out of
   scope and whose parts are in a full bucket or counted by this pass themselves. Every
   frequent phrase is counted by then, so the search is closed.

Proposal and buckets travel as bitmaps of at most ``MAX_BITMAP`` bytes, built by Spark. A
false hit counts a phrase too much in scope and changes no count, so the result is exact at
any size. Inside a task, occurrences are grouped by dense integer names (exact, pair by
pair) and flushed in bounded portions: one row for each language and range of phrases, with
the phrases and their counts as arrays, so that the rows of a task do not grow with the
number of phrases. Each range is added up by itself. Buckets are sorted arrays by range of
the bucket number, and ranges are split further while one would be too large for a task.

Cutting a phrase after k words scores floor(1000 * a * n / (l * r)); the least score
counts, then the least k. Products are exact decimals of 38 digits. A phrase inside a
longer one of the same count is dropped: it is enough to look one word further.

Edge cases: null and empty texts have no words; a null language is ``und``; words are
never cut, whatever their length; repeated rows count each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pushlake.llm._util import MAX_BROADCAST_BYTES, drop_tables, materialize, measured
from pushlake.llm._words import mix

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Share of the documents in the sample, and of the scaled threshold used there.
SAMPLE = 0.1
LOWERED = 0.4
MAX_BITMAP = MAX_BROADCAST_BYTES
#: Bytes of texts that a task reads at a time; phrases and bucket entries it holds before
#: it writes them.
CHUNK = 1 << 21
MAX_HELD = 400_000
MAX_BORDER = 2_000_000
#: A bucket is the top bits of a phrase hash; a range of buckets its top RANGE_BITS.
BUCKET_BITS = 36
RANGE_BITS = 8
#: Most bucket entries that one task adds up.
MAX_RANGE = 16_000_000
#: Phrases of a range of phrases, more or less; there are 2**RANGE_BITS ranges at least.
PER_RANGE = 4096
_SALTS = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)

_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = range(0x61, 0x7B)
_TABLE[0x09] = 0x20
for _b in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_b] = 0x0A
_TABLE = bytes(_TABLE)


class Bitmap:
    """A set of buckets, by their low bits."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - BUCKET_BITS)) & self.mask
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def _bitmap(buckets: DataFrame, count: int) -> np.ndarray:
    """The bitmap of a column ``bucket``: a grouped OR of bits, of bounded size."""
    bits = 1 << min((MAX_BITMAP * 8).bit_length() - 1, max(16, (count * 64).bit_length()))
    at = F.col("bucket").bitwiseAND(F.lit(bits - 1))
    rows = buckets.select(F.shiftright(at, 6).alias("w"), at.bitwiseAND(F.lit(63)).cast("int").alias("b"))
    got = rows.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("v")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got.column("w").to_numpy()] = got.column("v").to_numpy()
    return out.view(np.uint64)


class _Chunk:
    """The words of some texts, and their phrases level by level."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.data = b"\n".join(texts).translate(_TABLE)
        raw = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = (raw != 0x20) & (raw != 0x0A)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.count = len(self.start)
        self.piece = np.cumsum(raw == 0x0A, dtype=np.int32)[self.start]
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.start, side="right")
        # words before which more than one space stands, counted: phrases over them are no slice of the data
        self.spaced = np.zeros(max(2, self.count + 1), np.int32)
        self.spaced[2:] = np.cumsum(self.start[1:] - self.end[:-1] > 1)
        self.names = sorted(set(langs))
        index = {x: i for i, x in enumerate(self.names)}
        self.lang = np.array([index[x] for x in langs], np.int64)[text]
        words = self.data.split()
        ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
        self.word = np.fromiter(map(ids.__getitem__, words), np.int64, self.count)
        self.kinds = len(ids)
        own = np.fromiter(map(xxhash.xxh64_intdigest, ids), np.uint64, self.kinds)
        self.hash = mix(own[self.word] ^ np.array([_salt(x) for x in self.names], np.uint64)[self.lang])

    def longer(self, extend: np.ndarray, n: int) -> np.ndarray:
        """Starts of phrases of n + 1 words in one piece whose phrases of n words, the
        first and the last, are marked in ``extend``."""
        out = np.zeros(self.count, bool)
        out[:-n] = extend[:-n] & extend[1 : self.count - n + 1] & (self.piece[:-n] == self.piece[n:])
        return out

    def next_hash(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the phrases of n + 1 words from those of n (0 past the end)."""
        out = np.zeros(self.count, np.uint64)
        out[:-n] = mix(hashes[:-n] * _STEP + self.hash[n:])
        return out

    def phrases(self, heads: np.ndarray, n: int) -> list[bytes]:
        """The phrases of n words at ``heads``, joined by one space."""
        data = self.data
        out = [data[a:b] for a, b in zip(self.start[heads].tolist(), self.end[heads + n - 1].tolist())]
        for i in np.flatnonzero(self.spaced[heads + n] > self.spaced[heads + 1]).tolist():
            out[i] = b" ".join(out[i].split())
        return out


def _salt(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 1)


class _Held:
    """Counts of phrases by language, written in bounded portions."""

    def __init__(self):
        self.counts: dict[str, dict[bytes, int]] = {}

    def size(self) -> int:
        return sum(map(len, self.counts.values()))

    def add(self, lang: str, phrases: list[bytes], counts: list[int]) -> None:
        own = self.counts.setdefault(lang, {})
        get = own.get
        for p, c in zip(phrases, counts):
            own[p] = get(p, 0) + c

    def rows(self, bits: int):
        """One row for each language and range of phrases, by the top ``bits`` of a hash."""
        for lang, own in self.counts.items():
            if not own:
                continue
            ranges = (np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, len(own)) >> np.uint64(64 - bits)).astype(np.int32)
            order = np.argsort(ranges, kind="stable")
            firsts = np.flatnonzero(np.diff(ranges[order], prepend=-1))
            phrases = pa.array(own.keys(), pa.binary(), size=len(own)).cast(pa.string()).take(pa.array(order))
            counts = pa.array(np.fromiter(own.values(), np.int64, len(own))[order])
            cuts, n = pa.array(np.append(firsts, len(own)).astype(np.int32)), len(firsts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))), pa.array(ranges[order][firsts]), pa.ListArray.from_arrays(cuts, phrases), pa.ListArray.from_arrays(cuts, counts), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                names=_COLUMNS,
            )
        self.counts = {}


_COLUMNS = ["lang", "range", "phrases", "counts", "n", "entries"]
_ROWS = "lang string, range int, phrases array<string>, counts array<long>, n long, entries binary"


def _entries(hashes: list[np.ndarray]):
    """Rows (range, entries): bucket numbers and counts of border occurrences."""
    buckets, counts = np.unique(np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS), return_counts=True)
    yield from _ranges(buckets.astype(np.int64), counts, BUCKET_BITS - RANGE_BITS)


def _ranges(buckets: np.ndarray, counts: np.ndarray, shift: int):
    """Sorted buckets as one row for each value of their bits above ``shift``."""
    parts = buckets >> shift
    cuts = np.flatnonzero(np.diff(parts)) + 1
    firsts = np.concatenate([[0], cuts])
    packed = [_pack(b, c) for b, c in zip(np.split(buckets, cuts), np.split(counts, cuts))]
    n = len(packed)
    nothing = [pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.int64()))]
    sizes = np.diff(np.append(firsts, len(buckets)))
    yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.array(parts[firsts], pa.int32()), *nothing, pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], names=_COLUMNS)


def _pack(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """Gaps of sorted buckets and their counts, as little-endian byte planes, compressed."""
    gaps = np.diff(buckets, prepend=0).astype("<u8")
    planes = [gaps.view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes(), counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()]
    return len(gaps).to_bytes(8, "little") + pa.compress(b"".join(planes), codec="lz4", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=9 * n, codec="lz4", asbytes=True), np.uint8)
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :5] = raw[: 5 * n].reshape(5, n).T
    counts = np.ascontiguousarray(raw[5 * n :].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(gaps.view("<u8").ravel().astype(np.int64)), counts.astype(np.int64)


def _added(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of several packed arrays, added up."""
    both = [_unpack(p) for p in parts]
    buckets, inverse = np.unique(np.concatenate([b for b, _ in both]), return_inverse=True)
    return buckets, np.bincount(inverse, np.concatenate([c for _, c in both]), len(buckets)).astype(np.int64)


def _portions(batches):
    texts, langs, size = [], [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            data = (batch.column(1)[row].as_py() or "").encode()
            texts.append(data)
            langs.append(batch.column(0)[row].as_py())
            size += len(data)
            if size >= CHUNK:
                yield texts, langs
                texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def _scan(docs: DataFrame, rule, totals: bool = False, bits: int = RANGE_BITS) -> DataFrame:
    """One pass over the texts. ``rule(n, scope, hashes)`` tells of the phrases of n words
    that are in scope: which are counted one by one, which in buckets, and which may be
    part of longer phrases in scope. Phrases are dealt into 2**``bits`` ranges. With
    ``totals`` an empty phrase counts the words of each language."""

    def scan(batches):
        decide = rule()
        held, border, waiting = _Held(), [], 0
        for texts, langs in _portions(batches):
            chunk = _Chunk(texts, langs)
            if not chunk.count:
                continue
            if totals:
                for i, c in enumerate(np.bincount(chunk.lang).tolist()):
                    held.add(chunk.names[i], [b""], [c])
            scope, hashes, names, state = np.ones(chunk.count, bool), chunk.hash, chunk.lang * chunk.kinds + chunk.word, None
            for n in range(1, MAX_WORDS + 1):
                at = np.flatnonzero(scope)
                if not len(at):
                    break
                single, bucketed, extend, state = decide(chunk, n, at, hashes[at], state)
                if bucketed.any():
                    border.append(hashes[at[bucketed]])
                    waiting += len(border[-1])
                keep = at[single | extend]
                if not single.any() and not extend.any():
                    break
                rank = np.zeros(chunk.count, np.int64)
                _, first, inverse, counts = np.unique(names[keep], return_index=True, return_inverse=True, return_counts=True)
                rank[keep] = inverse
                wanted = single[single | extend][first]
                heads, counts = keep[first[wanted]], counts[wanted]
                for i, name in enumerate(chunk.names):
                    own = chunk.lang[heads] == i
                    held.add(name, chunk.phrases(heads[own], n), counts[own].tolist())
                if n == MAX_WORDS:
                    break
                marked = np.zeros(chunk.count, bool)
                marked[at[extend]] = True
                scope = chunk.longer(marked, n)
                hashes = chunk.next_hash(hashes, n)
                names = np.zeros(chunk.count, np.int64)
                names[:-n] = rank[:-n] * chunk.kinds + chunk.word[n:]
            if held.size() >= MAX_HELD:
                yield from held.rows(bits)
            if waiting >= MAX_BORDER:
                yield from _entries(border)
                border, waiting = [], 0
        yield from held.rows(bits)
        if border:
            yield from _entries(border)

    return docs.select("lang", "text").mapInArrow(scan, _ROWS)


def _counted(rows: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, n) of the phrases that were counted one by one, ``least``
    times or more, and of the empty phrase. A range of a language is added up at a time."""

    def summed(group):
        parts = pa.table({"phrase": pc.list_flatten(group.column("phrases")), "n": pc.list_flatten(group.column("counts"))})
        sums = parts.group_by("phrase", use_threads=False).aggregate([("n", "sum")])
        sums = sums.filter(pc.or_(pc.greater_equal(sums.column("n_sum"), least), pc.equal(sums.column("phrase"), "")))
        lang = group.column("lang").combine_chunks().take(pa.array(np.zeros(len(sums), np.int32)))
        return pa.table({"lang": lang, "phrase": sums.column("phrase"), "n": sums.column("n_sum")})

    rows = rows.filter(F.col("phrases").isNotNull()).select("lang", "range", "phrases", "counts")
    rows = rows.groupBy("lang", "range").applyInArrow(summed, "lang string, phrase string, n long")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return rows.select("lang", "phrase", words.alias("words"), "n")


def _full_buckets(rows: DataFrame, least: int) -> np.ndarray:
    """The bitmap of the buckets with ``least`` occurrences or more. A range of more
    than MAX_RANGE entries is split by the next bits of the bucket number, in tasks that
    each split some of its arrays."""
    ranges = materialize(rows.select("range", "entries", "n"), "ranges")
    shift = BUCKET_BITS - RANGE_BITS
    while (ranges.groupBy("range").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0) > MAX_RANGE and shift > 0:
        shift = max(0, shift - RANGE_BITS)

        def split(batches, shift=shift):
            for batch in batches:
                for entries in batch.column(1):
                    buckets, counts = _unpack(entries.as_py())
                    for part in _ranges(buckets, counts, shift):
                        yield part.select(["range", "entries", "n"])

        wider = ranges
        ranges = materialize(wider.mapInArrow(split, "range int, entries binary, n long"), "ranges")
        drop_tables(wider)

    def full(group):
        buckets, counts = _added([e.as_py() for e in group.column("entries")])
        return pa.table({"bucket": pa.array(buckets[counts >= least], pa.int64())})

    found, size = measured(ranges.groupBy("range").applyInArrow(full, "bucket long"), "buckets", n=F.count(F.lit(1)))
    drop_tables(ranges)
    return _bitmap(found, size["n"])


def _sample(docs: DataFrame, min_count: int, share: float) -> np.ndarray:
    """The proposal: the buckets that are full in the sample at a lowered threshold, found
    level by level."""
    drawn = F.pmod(F.xxhash64("id", "text", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20))
    drawn = materialize(docs.filter(drawn).select("lang", "text"), "sample")
    least = max(2, int(min_count * share * LOWERED))
    proposal, sent = None, None

    def rule():
        known = None if sent is None else Bitmap(sent.value)

        def decide(chunk, n, at, hashes, state):
            none = np.zeros(len(at), bool)
            if n == level:
                return none, ~none, none, None
            return none, none, known.holds(hashes), None

        return decide

    for level in range(1, MAX_WORDS + 1):
        full = _full_buckets(_scan(drawn, rule), least)
        if not full.any():
            break
        proposal = full if proposal is None else _union(proposal, full)
        sent = docs.sparkSession.sparkContext.broadcast(proposal)
    drop_tables(drawn)
    return proposal if proposal is not None else np.zeros(1 << 10, np.uint64)


def _union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two bitmaps at the size of the larger one."""
    size = max(len(a), len(b))
    return np.tile(a, size // len(a)) | np.tile(b, size // len(b))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: float = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): exact counts (lang, phrase, words, n) of all phrases with at
    least ``min_count`` occurrences, and the words of each language (lang, total)."""
    docs = docs.select(docs[id_col].alias("id"), F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    spark = docs.sparkSession
    proposal = spark.sparkContext.broadcast(_sample(docs, min_count, sample))

    def first():
        proposed = Bitmap(proposal.value)

        def decide(chunk, n, at, hashes, state):
            none = np.zeros(len(at), bool)
            return none, ~none, proposed.holds(hashes), None

        return decide

    full = spark.sparkContext.broadcast(_full_buckets(_scan(docs, first), min_count))

    def further():
        proposed, filled = Bitmap(proposal.value), Bitmap(full.value)

        def decide(chunk, n, at, hashes, state):
            # state: the starts that were in scope of the first pass
            before = np.ones(len(at), bool) if state is None else state[at]
            single = filled.holds(hashes) | ~before
            was = np.zeros(chunk.count, bool)
            was[at] = before & proposed.holds(hashes)
            return single, np.zeros(len(at), bool), single, chunk.longer(was, n)

        return decide

    # more ranges for more phrases: a range has PER_RANGE of them, from each task that met them
    bits = max(RANGE_BITS, (int(np.bitwise_count(full.value).sum()) // PER_RANGE).bit_length())
    counts = materialize(_counted(_scan(docs, further, totals=True, bits=bits), min_count), "counts")
    return counts.filter("words > 0").select("lang", "phrase", "words", "n"), counts.filter("words = 0").select("lang", F.col("n").alias("total"))


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more that no longer
    phrase of the same count holds."""
    split = F.split("phrase", " ")
    long = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), split.alias("w"))
    inner = phrases.filter("words > 2").select("lang", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    inner = inner.select("lang", "a", F.explode(F.array(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"))).alias("w"))
    inner = inner.select("lang", "a", F.array_join("w", " ").alias("phrase")).distinct()
    long = long.join(inner, ["lang", "phrase", "a"], "left_anti")
    cuts = long.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ").alias("rest"))
    parts = phrases.select("lang", "phrase", "n")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    over, under = (F.lit(1000).cast("decimal(4,0)") * wide("a") * F.col("total").cast("decimal(15,0)")).cast("decimal(38,0)"), (wide("l") * wide("r")).cast("decimal(38,0)")
    cuts = cuts.withColumn("over", over).withColumn("under", under)
    cuts = cuts.withColumn("score", F.expr("cast((over - over % under) / under as decimal(38,0))").cast("long"))
    best = cuts.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top_collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, **columns) -> DataFrame:
    """The first ``top`` phrases of every language by score, count and phrase."""
    best = scored(*frequent_phrases(docs, min_count, **columns))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # salted first, so that no task ranks all phrases of a language
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
