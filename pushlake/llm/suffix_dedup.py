"""Operator 12: removal of repeated byte strings by distributed prefix doubling.

Every text is its UTF-8 bytes. A byte goes when it is covered by a string of
``length`` bytes that also starts anywhere else, in the same text or another one.

The doubling sorts positions, so positions that cannot matter leave before it, and
none of these steps can lose a repeat:

1. Every start belongs to the least of the ``length / 4``-byte hashes in its string
   (its anchor, the leftmost of ties). Equal strings have equal anchors at equal
   distances, so a start whose anchor occurs once is unique. Consecutive starts of one
   anchor are a run: one row.
2. Runs of equal anchor, extent and context (all bytes their strings cover) are
   repeated throughout; one of them stands for all from here on.
3. Runs that still share their anchor with another run are cut into stretches of
   ``STRETCH`` starts, by distance from the anchor, and step 2 is done on these. A
   stretch stays open when the bytes that all its strings share occur elsewhere with
   another context.

Prefix doubling decides the open starts: Spark range-partitions and sorts the pairs of
ranks at a position and one offset further (an eighth of the length, then a quarter,
then what is left), equal pairs get one new rank, and a start with a unique position
leaves. Starts that keep a rank for the whole length are repeated. The first ranks
are 64-bit hashes of an eighth of the length, so a pair has 128 bits.

Each step is an aggregate with map-side combine or a join that Spark can split; a
string that a third of all texts hold is one run per distinct context. Sorted pairs of
one value are numbered as a stream and never gathered.

Edge cases: null and empty texts have no bytes; texts under ``length`` bytes keep all;
very long texts are read in pieces that overlap by ``length - 1`` bytes; rows that are
equal in id and text are copies of each other, whatever the id (null too); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import MAX_BROADCAST_BYTES, drop_tables, materialize, measured
from pushlake.llm._words import mix

LENGTH = 200
STRETCH = 8
#: Bytes of texts that are hashed at a time.
CHUNK = 1 << 17
#: Bytes that a broadcast hash table takes for each long key.
KEY_BYTES = 40
#: Low bits of a window's key: the place in the chunk, below the hash.
PLACE_BITS = 24
_PLACE = np.uint64((1 << PLACE_BITS) - 1)
#: Numbers kept for the starts of a run (it has fewer than ``length``).
_RUN_STARTS = 1 << 11


class _Hasher:
    """64-bit polynomial hashes of all substrings of a byte buffer."""

    def __init__(self, multiplier: int, size: int):
        m = multiplier | 1
        self.powers = self._powers(m, size)
        self.inverse = self._powers(pow(m, -1, 1 << 64), size)

    @staticmethod
    def _powers(m: int, size: int) -> np.ndarray:
        out = np.full(size, m, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start, end) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverse[start])


_HASHERS: dict[int, tuple[_Hasher, _Hasher]] = {}


def _hashers(size: int) -> tuple[_Hasher, _Hasher]:
    """Two hashers for buffers of up to ``size`` bytes (sizes are powers of two)."""
    size = 1 << max(19, (size + 1).bit_length())
    if size not in _HASHERS:
        _HASHERS.clear()
        _HASHERS[size] = (_Hasher(0x9E3779B97F4A7C15, size), _Hasher(0xC2B2AE3D27D4EB4F, size))
    return _HASHERS[size]


def _runs(data: np.ndarray, ends: np.ndarray, length: int):
    """Runs of the texts that are joined in ``data`` and end at ``ends``: first start,
    number of starts, distance of the anchor from the first, anchor hash, context hash."""
    n, k = len(data), length // 4
    if n < length:
        return (np.empty(0, np.int64),) * 5
    one, two = _hashers(n)
    s1, s2 = one.sums(data), two.sums(data)
    grams = one.of(s1, np.arange(n - k + 1), np.arange(k, n + 1))
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span, have = length - k + 1, 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    anchor = (least & _PLACE).astype(np.int64)
    text = np.searchsorted(ends, np.arange(n - length + 1), side="right")
    inside = np.arange(n - length + 1) + length <= ends[text]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & inside)
    last = np.minimum(np.append(np.flatnonzero(new)[1:], len(anchor))[np.cumsum(new)[first] - 1] - 1, ends[text[first]] - length)
    d = anchor[first] - first
    context = two.of(s2, first, last + length) + mix((d * 4096 + (last - first)).astype(np.uint64))
    return first, last - first + 1, d, grams[anchor[first]], context


def _texts(batches, columns: int, overlap: int):
    """Lists of (row values, offset, bytes) of about CHUNK bytes from batches whose last
    column is the text; a longer text comes in pieces that overlap."""
    held, size = [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            data = (batch.column(columns)[row].as_py() or "").encode()
            values = [batch.column(c)[row].as_py() for c in range(columns)]
            for at in range(0, max(1, len(data) - overlap), CHUNK):
                piece = data[at : at + CHUNK + overlap]
                held.append((values, at, piece))
                size += len(piece)
                if size >= CHUNK:
                    yield held
                    held, size = [], 0
    if held:
        yield held


RUN_ROWS = "did long, th long, lo int, n int, d int, kh long, ctx long"


def _run_rows(docs: DataFrame, length: int) -> DataFrame:
    def rows(batches):
        for held in _texts(batches, 2, length - 1):
            sizes = np.array([len(p) for _, _, p in held])
            ends = np.cumsum(sizes)
            first, n, d, kh, ctx = _runs(np.frombuffer(b"".join(p for _, _, p in held), np.uint8), ends, length)
            if not len(first):
                continue
            of = np.searchsorted(ends, first, side="right")
            ids = np.array([v for v, _, _ in held], np.int64)[of]
            lo = first - (ends - sizes)[of] + np.array([at for _, at, _ in held])[of]
            columns = [ids[:, 0], ids[:, 1], lo.astype(np.int32), n.astype(np.int32), d.astype(np.int32), kh.view(np.int64), ctx.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["did", "th", "lo", "n", "d", "kh", "ctx"])

    return docs.mapInArrow(rows, RUN_ROWS)


def _whole_texts(docs: DataFrame, name: str, of_runs: DataFrame, at: str, schema: str, length: int, body) -> DataFrame:
    """``body(bytes, items)`` -> columns, for the texts with items in ``of_runs`` (did, th,
    ``name`` array of structs with a start ``at``). A long text comes in pieces, each with
    the items that start there. Rows of equal id and text come each: they are copies."""

    def rows(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(1)[row].as_py().encode(), np.uint8)
                items = batch.column(0)[row].values
                chunk = _field(items, at) // CHUNK
                for c in np.unique(chunk):
                    own = {f.name: _field(items, f.name)[chunk == c] for f in items.type}
                    own[at] = own[at].astype(np.int64) - int(c) * CHUNK
                    piece = data[int(c) * CHUNK : (int(c) + 1) * CHUNK + _RUN_STARTS + length]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in body(piece, own)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.join(of_runs, ["did", "th"]).select(name, "text").mapInArrow(rows, schema)


def _field(struct: pa.StructArray, name: str) -> np.ndarray:
    return struct.field(name).to_numpy(zero_copy_only=False)


STRETCH_ROWS = "ck long, fk long, place long, n int, done boolean"


def _stretches(length: int):
    """Stretches of the runs of one text: key of anchor, distance and shared bytes; key
    of that and the context; place (run and start in it) and number of starts."""

    def body(data, runs):
        hasher = _hashers(len(data))[0]
        sums = hasher.sums(data)
        lo, n, d = (runs[c].astype(np.int64) for c in ("lo", "n", "d"))
        least, most = d - n + 1, d  # distances of a run's starts from its anchor
        blocks = most // STRETCH - least // STRETCH + 1
        of = np.repeat(np.arange(len(lo)), blocks)
        block = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks) + (least // STRETCH)[of]
        near, far = np.maximum(least[of], block * STRETCH), np.minimum(most[of], block * STRETCH + STRETCH - 1)
        anchor = (lo + d)[of]
        core = hasher.of(sums, anchor - block * STRETCH, anchor - (block * STRETCH + STRETCH - 1) + length)
        context = hasher.of(sums, anchor - far, anchor - near + length)
        kh = runs["kh"].astype(np.int64).view(np.uint64)[of]
        ck = mix(mix(core) + kh * np.uint64(3) + block.astype(np.uint64))
        fk = mix(context) + mix((far * 4096 + near).astype(np.uint64))
        place = runs["rid"][of] * _RUN_STARTS + (anchor - far - lo[of])
        return ck.view(np.int64), fk.view(np.int64), place, (far - near + 1).astype(np.int32), runs["done"][of]

    return body


def _offsets(length: int) -> tuple[int, list[int]]:
    """Bytes of the first ranks, and the offsets at which ranks are paired."""
    first = -(-length // 8)
    return first, [first, 2 * first, length - 4 * first]


def _first_pairs(length: int):
    """Hash pairs at the four positions that each open start needs."""
    first, (step, second, third) = _offsets(length)
    slots = np.array([0, second, third, third + second])

    def body(data, stretches):
        hasher = _hashers(len(data))[0]
        sums = hasher.sums(data)
        n = stretches["n"].astype(np.int64)
        of = np.repeat(np.arange(len(n)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(stretches["at"][of] + within, 4)
        pid = np.repeat(stretches["place"][of] + within, 4)
        slot = np.tile(np.arange(4, dtype=np.int32), len(of))
        at = start + slots[slot]
        a, b = hasher.of(sums, at, at + first), hasher.of(sums, at + step, at + step + first)
        return pid, slot, a.view(np.int64), b.view(np.int64)

    return body


def _rerank(pairs: DataFrame) -> DataFrame:
    """(pid, slot, a, b) -> (pid, slot, rank) of the rows whose pair is not unique. The
    sorted rows of a range are numbered as they stream by; only the last row of a batch
    waits for the next one."""

    def number(batches):
        base, last = TaskContext.get().partitionId() << 40, None  # last: (pid, slot, a, b, known to repeat)
        count = -1
        for batch in batches:
            if not batch.num_rows:
                continue
            pid, slot, a, b = (batch.column(c).to_numpy() for c in range(4))
            fresh = np.ones(len(a), bool)
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            fresh[0] = last is None or (a[0], b[0]) != last[2:4]
            rank = count + np.cumsum(fresh)
            repeat = ~fresh
            repeat[:-1] |= ~fresh[1:]
            if last is not None and (last[4] or not fresh[0]):
                yield _ranked([last[0]], [last[1]], [base + count])
            held = len(a) - 1
            keep = repeat[:held]
            yield _ranked(pid[:held][keep], slot[:held][keep], base + rank[:held][keep])
            last, count = (pid[held], slot[held], a[held], b[held], bool(repeat[held])), int(rank[held])
        if last is not None and last[4]:
            yield _ranked([last[0]], [last[1]], [base + count])

    return pairs.repartitionByRange("a", "b").sortWithinPartitions("a", "b").mapInArrow(number, "pid long, slot int, rank long")


def _ranked(pid, slot, rank) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(pid, np.int64)), pa.array(np.asarray(slot, np.int32)), pa.array(np.asarray(rank, np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["pid", "slot", "rank"])


def _paired(ranked: DataFrame, slots: int) -> DataFrame:
    """The next pairs of the starts that have a rank at all of their ``slots``."""
    rank = [F.max(F.when(F.col("slot") == s, F.col("rank"))).alias(f"r{s}") for s in range(slots)]
    whole = ranked.groupBy("pid").agg(*rank).dropna()
    pair = [F.struct(F.lit(s // 2).alias("slot"), F.col(f"r{s}").alias("a"), F.col(f"r{s + 1}").alias("b")) for s in range(0, slots, 2)]
    return whole.select("pid", F.inline(F.array(*pair)))


def _few(df: DataFrame, name: str, row_bytes: Column) -> DataFrame:
    """``df`` written; broadcast when its rows are within the size bound."""
    df, size = measured(df, name, bytes=F.coalesce(F.sum(row_bytes), F.lit(0)))
    return F.broadcast(df) if size["bytes"] <= MAX_BROADCAST_BYTES else df


def _of_texts(rows: DataFrame, name: str, *fields) -> DataFrame:
    """Rows as one array per text, broadcast when small."""
    grouped = rows.groupBy("did", "th").agg(F.collect_list(F.struct(*fields)).alias(name))
    return _few(grouped, name, F.size(name) * 64 + 64)


def _merged(batches):
    for batch in batches:
        spans = []
        for value in batch.column(2):
            s, e = _field(value.values, "s"), _field(value.values, "e")
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate(e[order])
            new = np.append(True, s[1:] > e[:-1])
            spans.append([{"s": int(x), "e": int(y)} for x, y in zip(s[new], e[np.append(new[1:], True)])])
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], names=["did", "th", "spans"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return docs.select("id", F.xxhash64("id").alias("did"), F.xxhash64("text").alias("th"), "text")


def find_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, spans): every row with its maximal spans of repeated bytes, as an array
    of (s, e), end exclusive, in order (null: none). ``length`` is 16 to 1,600 bytes."""
    if not 16 <= length <= 1600:
        raise ValueError(f"length {length} is not in 16 to 1600")
    docs = _keyed(docs, id_col, text_col)
    long = docs.filter(F.octet_length("text") >= length)
    end = F.col("lo") + F.col("n") - 1 + length
    # 1: runs whose anchor occurs again
    runs = materialize(_run_rows(long.select("did", "th", "text"), length), "runs")
    anchors = _few(runs.groupBy("kh").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("kh"), "anchors", F.lit(KEY_BYTES))
    shared = runs.join(anchors, "kh", "left_semi")
    # 2: runs of equal context are repeated; one stands for all
    one = [F.first(c).alias(c) for c in ("did", "th", "lo", "n", "d")]
    classes = materialize(shared.groupBy("kh", "ctx").agg(F.count(F.lit(1)).alias("c"), *one), "classes")
    copied = _few(classes.filter("c > 1").select("kh", "ctx"), "copied", F.lit(2 * KEY_BYTES))
    found = shared.join(copied, ["kh", "ctx"], "left_semi").select("did", "th", F.col("lo").alias("s"), end.alias("e"))
    several = _few(classes.groupBy("kh").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("kh"), "several", F.lit(KEY_BYTES))
    stand = classes.join(several, "kh", "left_semi").select("did", "th", "lo", "n", "d", "kh", (F.col("c") > 1).alias("done"))
    stand = materialize(stand.withColumn("rid", F.monotonically_increasing_id()), "standing")
    of_texts = _of_texts(stand, "open_runs", "lo", "n", "d", "kh", "rid", "done")
    # 3: stretches of the runs that are still open
    stretches = materialize(_whole_texts(long, "open_runs", of_texts, "lo", STRETCH_ROWS, length, _stretches(length)), "stretches")
    kinds = stretches.groupBy("ck", "fk").agg(F.count(F.lit(1)).alias("c"), F.first("place").alias("place"), F.first("n").alias("n"))
    kinds = materialize(kinds, "kinds")
    again = _few(kinds.filter("c > 1").select("ck", "fk"), "again", F.lit(2 * KEY_BYTES))
    rid = F.floor(F.col("place") / _RUN_STARTS).cast("long").alias("rid")
    start = (F.col("place") % _RUN_STARTS).cast("int")
    homes = stand.select("rid", "did", "th", "lo")
    pieces = stretches.filter("not done").join(again, ["ck", "fk"], "left_semi").select(rid, start.alias("start"), "n").join(homes, "rid")
    at = F.col("lo") + F.col("start")
    found = found.unionByName(pieces.select("did", "th", at.alias("s"), (at + F.col("n") - 1 + length).alias("e")))
    # prefix doubling over the open starts
    open_keys = _few(kinds.groupBy("ck").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("ck"), "open_keys", F.lit(KEY_BYTES))
    left = kinds.join(open_keys, "ck", "left_semi").select(rid, start.alias("start"), "place", "n").join(homes, "rid")
    of_texts = _of_texts(left, "open_starts", at.alias("at"), "place", "n")
    pairs = _whole_texts(long, "open_starts", of_texts, "at", "pid long, slot int, a long, b long", length, _first_pairs(length))
    for slots in (4, 2):
        pairs = _paired(_rerank(materialize(pairs, "pairs")), slots)
    place = _rerank(materialize(pairs, "pairs")).select(F.col("pid").alias("place"))
    starts = place.select(rid, start.alias("start")).join(homes, "rid").select("did", "th", at.alias("s"), (at + length).alias("e"))
    found = found.unionByName(starts).groupBy("did", "th").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    found, size = measured(found.mapInArrow(_merged, found.schema), "spans", bytes=F.coalesce(F.sum(F.size("spans") * 16 + 48), F.lit(0)))
    drop_tables(runs, classes, stand, stretches, kinds)
    found = F.broadcast(found) if size["bytes"] <= MAX_BROADCAST_BYTES else found
    out = docs.join(found, ["did", "th"], "left")
    return out.select(F.col("id").alias(id_col), "text", "spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row; ``kept`` is
    binary, as a removed span may end inside a character."""

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sizes, removed, counts, kept = [], [], [], []
                for text, spans in zip(part.column(1), part.column(2)):
                    data = text.as_py().encode()
                    spans = [(x["s"], x["e"]) for x in spans.as_py() or ()]
                    edges = [0, *[x for span in spans for x in span], len(data)]
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    sizes.append(len(data))
                    removed.append(len(data) - len(kept[-1]))
                    counts.append(len(spans))
                digests = [hashlib.sha256(x).hexdigest() for x in kept]
                columns = [part.column(0), *[pa.array(x, pa.int64()) for x in (sizes, removed, counts)], pa.array(kept, pa.binary()), pa.array(digests)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    found = find_repeats(docs, length, id_col, text_col)
    kind = found.schema[id_col].dataType.simpleString()
    return found.mapInArrow(cut, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
