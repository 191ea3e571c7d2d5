"""Operator 4: near-duplicate classes by a chosen-path similarity join on minwise
tokens.

Documents with equal shingle sets are one class first (a grouped minimum), so groups
of copies cost one row. Then independent trees branch the classes: the root splits
by one minwise token; the classes of every node are compared with ``PIVOTS`` of them
that the node draws, and the links found are contracted before any other comparison.
The pivots of all trees together reach most members of a group of near copies, so it
becomes one component at a cost in proportion to its size. From there only classes of
different components are compared, and nodes inside one component end. A node is small
when at most ``LEAF`` of its classes lie outside its largest component: each of its
classes is compared with those, so a small node costs its size times ``LEAF`` at most
and returns only pairs that may be links. A larger node branches again by ``BRANCHES``
minwise tokens that it selects (their four bits in the sketch, so no values are joined
back); the first of these levels draws pivots and contracts once more, for groups that
all lie inside a much larger node. What is still larger at the last level is compared
in the same way, so nothing is capped.

A pair of similarity 0.75 meets in a small root child with probability 0.75 a tree;
where nodes are large, its branching process survives with probability 0.89. Over
``TREES`` trees the recall is 0.99998 or more. Candidate pairs pass a sketch test
(128 four-bit minwise values, at least ``SKETCH_MATCHES`` equal: a pair at the
threshold fails with probability 5e-5), a size test and a parity test, and every link
is confirmed on the full shingle sets. The parity test loses nothing: each set has
``PARITY_BITS`` bits, each the parity of the shingles hashed to it, so two sets differ
in at least as many shingles as bits, and linked sets in a seventh of their sizes at
most. It turns away the many pairs of a large group that are just under the threshold.

Cost is bounded by rows x TREES at the first level; no group is collected in one
task: a node's pivots are the first rows of a window, which Spark cuts before the
shuffle, and nodes are grouped with map-side combine and joined by key (splittable).

Edge cases: null and empty texts have no shingles and link with nothing; texts under
five words are one shingle; rows that repeat a doc_id share its component; rows with
a null id get a null component and are not kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pushlake.llm._util import MAX_BROADCAST_BYTES, materialize, measured, slices
from pushlake.llm._words import claim, hashes, shingles, words
from pushlake.llm.components import connected_components

PERCENT = 75
COORDINATES = 128
TREES = 10
LEAF = 1024
BRANCHES = 2
LEVELS = 7
PIVOTS = 8
#: Levels that compare with pivots and contract the links before anything else.
CONTRACTED = 2
#: Bytes that an id takes in a broadcast besides its text.
ID_OVERHEAD = 56
SKETCH_MATCHES = 80
SKETCH = [f"k{i}" for i in range(COORDINATES // 16)]
PARITY_BITS = 512
PARITY = [f"x{i}" for i in range(PARITY_BITS // 64)]
#: Columns of a set that node rows carry besides its size.
CARRIED = [*SKETCH, *PARITY]

_rng = np.random.default_rng(7251)
_A = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_BLOCK = 1 << 16  # shingles hashed at a time, to stay in cache


def _minwise(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise values (rows x COORDINATES, uint32) of non-empty shingle sets."""
    out = np.full((len(sets), COORDINATES), 0xFFFFFFFF, np.uint32)
    i = 0
    while i < len(sets):
        j, n = i, 0
        while j < len(sets) and (j == i or n + len(sets[j]) <= _BLOCK):
            n += len(sets[j])
            j += 1
        flat = np.concatenate(sets[i:j])
        starts = np.cumsum([0] + [len(s) for s in sets[i : j - 1]])
        for k in range(COORDINATES):
            out[i:j, k] = np.minimum.reduceat((flat * _A[k] + _B[k]) >> np.uint64(32), starts).astype(np.uint32)
        i = j
    return out


def _sketch(mins: np.ndarray) -> list[np.ndarray]:
    """64-bit words of sixteen 4-bit values each."""
    low = (mins & np.uint32(15)).astype(np.uint64)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return [np.bitwise_or.reduce(low[:, 16 * w : 16 * w + 16] << shifts, axis=1).view(np.int64) for w in range(len(SKETCH))]


def _parities(s: np.ndarray) -> np.ndarray:
    """64-bit words of the parities of a shingle set."""
    odd = np.bincount((s % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, v1, v2, k0-k7, x0-x7, mins): size and 128-bit hash of the shingle set,
    sketch, parities and the minwise values of the roots. No shuffle; one pass over the texts."""

    def run(batches):
        claim()
        for batch in slices(batches):
            sets = [shingles(hashes(words(x))) for x in batch.column(1).to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            mins = np.zeros((len(sets), COORDINATES), np.uint32)
            full = np.flatnonzero(n)
            if len(full):
                mins[full] = _minwise([sets[i] for i in full])
            digest = [(int(np.bitwise_xor.reduce(s * _A[0] ^ (s >> np.uint64(7)))), int(np.add.reduce((s ^ _B[1]) * _A[2] ^ (s >> np.uint64(11))))) if len(s) else (0, 0) for s in sets]
            v = np.array(digest, np.uint64).view(np.int64)
            odd = np.array([_parities(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(v[:, 0]), pa.array(v[:, 1]), *map(pa.array, _sketch(mins)), *[pa.array(odd[:, w]) for w in range(len(PARITY))]]
                + [pa.FixedSizeListArray.from_arrays(pa.array(mins[:, :TREES].ravel().view(np.int32)), TREES).cast(pa.list_(pa.int32()))],
                names=["id", "n", "v1", "v2", *CARRIED, "mins"],
            )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n long, v1 long, v2 long, {', '.join(k + ' long' for k in CARRIED)}, mins array<int>"
    )


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, set: array<long>) of every text."""

    def run(batches):
        claim()
        for batch in slices(batches):
            sets = [shingles(hashes(words(x))).view(np.int64) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"id {kind}, set array<long>")


def _plausible(a: str, b: str) -> Column:
    """Size, sketch and parity test of two rows given by their column prefixes."""
    n1, n2 = F.col(f"{a}n"), F.col(f"{b}n")
    differ = F.lit(0)
    for k in SKETCH:
        x = F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111))
        differ = differ + F.bit_count(x)
    odd = sum((F.bit_count(F.col(f"{a}{x}").bitwiseXOR(F.col(f"{b}{x}"))) for x in PARITY), F.lit(0))
    apart = (100 + PERCENT) * odd <= (100 - PERCENT) * (n1 + n2)
    return (100 * F.least(n1, n2) >= PERCENT * F.greatest(n1, n2)) & (differ <= COORDINATES - SKETCH_MATCHES) & apart


def _pairs(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _roots(classes: DataFrame) -> DataFrame:
    """Rows (key, id, comp, n, sketch) of the root children that hold several classes.
    Only ids and keys are grouped; sketches join what is left."""
    base = classes.select("id", F.posexplode("mins").alias("tree", "token"))
    base = base.select(F.xxhash64("tree", "token").alias("key"), "id")
    shared = base.groupBy("key").agg(F.min("id").alias("i0"), F.max("id").alias("i1")).filter("i0 <> i1").select("key")
    return base.join(shared, "key").join(classes.select("id", "n", *CARRIED), "id").select("key", "id", F.col("id").alias("comp"), "n", *CARRIED)


def _stars(rows: DataFrame) -> DataFrame:
    """Pairs of different components, each a class and a pivot of its node. Every node
    draws pivots of its own, so trees that hold the same group draw different ones."""
    drawn = Window.partitionBy("key").orderBy(F.xxhash64("key", "id"))
    pivots = rows.withColumn("place", F.row_number().over(drawn)).filter(F.col("place") <= PIVOTS)
    pivots = pivots.select("key", *[F.col(c).alias(f"p_{c}") for c in ["id", "comp", "n", *CARRIED]])
    both = rows.join(pivots, "key").filter((F.col("comp") != F.col("p_comp")) & _plausible("", "p_"))
    return both.select(*_pairs("id", "p_id")).distinct()


def _inside(rows: DataFrame, level: int) -> tuple[DataFrame, bool]:
    """Rows of the nodes that hold several components, with their node's largest
    component ``top`` and the number ``outside`` of its classes outside that; and
    whether any node is large. ``rows``: (key, id, comp, n, sketch)."""
    parts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"))
    nodes = parts.groupBy("key").agg(F.sum("k").alias("m"), F.max(F.struct("k", "comp")).alias("t")).filter("m > t.k")
    nodes = nodes.select("key", (F.col("m") - F.col("t.k")).alias("outside"), F.col("t.comp").alias("top"))
    inside, seen = measured(rows.join(nodes, "key"), f"nodes{level}", most=F.max("outside"))
    return inside, (seen["most"] or 0) > LEAF


def _compare(inside: DataFrame) -> DataFrame:
    """Pairs of different components inside nodes: every class against the classes
    outside its node's largest component."""
    rows = inside.select("key", "top", "id", "comp", "n", *CARRIED)
    other = rows.filter(F.col("comp") != F.col("top")).select("key", *[F.col(c).alias(f"o_{c}") for c in ["id", "comp", "n", *CARRIED]])
    once = (F.col("comp") == F.col("top")) | (F.col("id") < F.col("o_id"))
    both = rows.join(other, "key").filter(once & (F.col("comp") != F.col("o_comp")) & _plausible("", "o_"))
    return both.select(*_pairs("id", "o_id")).distinct()


def _merged(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, component) of the links and the components found before."""
    if found is not None:
        links = links.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return materialize(connected_components(links), "components")


def _contract(rows: DataFrame, found: DataFrame) -> DataFrame:
    found = found.select("id", F.col("component").alias("c"))
    return rows.drop("comp").join(found, "id", "left").select("key", "id", F.coalesce("c", "id").alias("comp"), "n", *CARRIED)


def _branch(rows: DataFrame, level: int) -> DataFrame:
    """The rows in the children of their nodes: branch j of a node takes the value of
    a sketch coordinate that the node selects, beyond those of the roots."""
    rows = rows.withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(BRANCHES)])))
    rows = rows.withColumn("at", (F.pmod(F.xxhash64("key", "j", F.lit(level)), F.lit(COORDINATES - TREES)) + TREES).cast("int"))
    word = F.element_at(F.array(*SKETCH), (F.floor(F.col("at") / 16) + 1).cast("int"))
    value = F.call_function("shiftrightunsigned", word, 4 * (F.col("at") % 16)).bitwiseAND(F.lit(15))
    return rows.select(F.xxhash64("key", "at", value).alias("key"), "id", "comp", "n", *CARRIED)


def confirm(docs: DataFrame, pairs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ids, size = measured(ids, "ids", bytes=F.coalesce(F.sum(F.length(F.col("id").cast("string")) + ID_OVERHEAD), F.lit(0)))
    # ids of a checked size go to the texts; beyond that the texts are shuffled once
    few = size["bytes"] <= MAX_BROADCAST_BYTES
    wanted = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(ids) if few else ids, "id", "left_semi")
    sets = materialize(shingle_sets(wanted, "id", "text"), "sets")
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    sized = both.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb")).alias("s"))
    return sized.filter(100 * F.col("i").cast("long") >= PERCENT * (F.col("s") - F.col("i")).cast("long")).select("a", "b").distinct()


def classes_and_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, found): rows (id, n, v1, v2) per document, classes (v1, v2, id,
    size) of equal sets, found (id, component) of the class representatives that the
    confirmed links join with others."""
    sigs = materialize(signatures(docs, id_col, text_col), "signatures")
    classes = sigs.filter("n > 0 and id is not null").groupBy("v1", "v2").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("size"), *[F.first(c).alias(c) for c in ["n", *CARRIED, "mins"]]
    )
    classes = materialize(classes, "classes")
    rows = materialize(_roots(classes), "roots")
    tried = found = late = None
    for level in range(1, LEVELS + 1):
        if level <= CONTRACTED:
            pairs = _stars(rows)
            pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
            tried = pairs if tried is None else tried.unionByName(pairs)
            found = _merged(found, confirm(docs, pairs, id_col, text_col))
            rows = _contract(rows, found)
        inside, grows = _inside(rows, level)
        last = level == LEVELS or not grows
        pairs = _compare(inside if last else inside.filter(F.col("outside") <= LEAF))
        late = pairs if late is None else late.unionByName(pairs)
        if last:
            break
        rows = _branch(inside.filter(F.col("outside") > LEAF), level + 1)
        if level < CONTRACTED:
            rows = materialize(rows, "branched")
    pairs = materialize(late.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    return sigs, classes, _merged(found, confirm(docs, pairs, id_col, text_col))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document."""
    sigs, classes, found = classes_and_components(docs, id_col, text_col)
    labels = classes.join(found, "id", "left").filter("size > 1 or component is not null")
    labels = labels.select(F.col("v1").alias("l1"), F.col("v2").alias("l2"), F.coalesce("component", "id").alias("label"))
    out = sigs.join(labels, (F.col("v1") == F.col("l1")) & (F.col("v2") == F.col("l2")) & (F.col("n") > 0), "left")
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("label", "id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
