"""Star-schema cube operators.

The cube is materialised as one table of all cuboids with a ``gid`` column
(Spark's ``grouping_id()``: bit i set when dimension i is rolled up, first
dimension = highest bit). Measures are mergeable (row count, sums as decimals,
HLL sketches), so every cuboid can be rolled up from any parent cuboid.

Scale: the fact table is shuffled once into the base cuboid; all other cuboids
are computed from the base cuboid, never from the fact table: with Spark's ``cube``
(Expand + partial aggregate), or with ``by_layer`` layer by layer, each cuboid from its
smallest parent one dimension wider, with each layer checkpointed to cut lineage. A
wide cube can hold chosen cuboids only (``cuboids``); queries are routed to the smallest
one that covers them (``query_cube``).
"""

from __future__ import annotations

import itertools
import os
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pushlake.session import checkpoint_root


def flat_table(fact: DataFrame, joins: Sequence[tuple[DataFrame, str, str]], columns: Sequence[str | Column]) -> DataFrame:
    """Fact joined with dimension tables (each ``(dim, fact_key, dim_key)``),
    projected to ``columns``. Spark broadcasts a dimension when its size in bytes, as
    planned or as measured at run time, is under the session's threshold."""
    out = fact
    for dim, fk, dk in joins:
        out = out.join(dim, out[fk] == dim[dk], "inner") if fk != dk else out.join(dim, fk, "inner")
    return out.select(*columns)


def redistribute(df: DataFrame, n: int) -> DataFrame:
    """Count, then spread rows evenly over ``n`` partitions (round robin)."""
    return df.repartition(n)


def dim_values(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The distinct values of every dimension as (dim, value) text rows."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])).alias("_p"))
    return long.select("_p.dim", "_p.value").distinct()


def encode_dim(df: DataFrame, col: str, n_ranges: int | None = None, out: str | None = None) -> DataFrame:
    """C4: dictionary code of a dimension: dense 0-based rank (bigint) of its value
    among the distinct values (nulls get no code), joined back to the rows."""
    from pushlake.operators.ordered import dense_index

    out = out or f"{col}_code"
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    coded = dense_index(values, [col], n_ranges, out="_code").select(col, F.col("_code").alias(out))
    known = df.filter(F.col(col).isNotNull()).join(coded, col, "left")
    # rows without a value need no code: they stay out of the join and its hash key
    missing = df.filter(F.col(col).isNull()).withColumn(out, F.lit(None).cast("bigint"))
    return known.unionByName(missing)


HLL_LG_K = 12


def base_cuboid(df: DataFrame, dims: Sequence[str], measures: dict[str, Column],
                distinct: dict[str, str] | None = None) -> DataFrame:
    """C6 + C8: all dimensions, ``n`` = row count, one sum per measure, and one
    mergeable HLL sketch per ``distinct`` measure (name -> column)."""
    sketches = [F.hll_sketch_agg(c, HLL_LG_K).alias(k) for k, c in (distinct or {}).items()]
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"), *[m.alias(k) for k, m in measures.items()], *sketches)


def _merged(sums: Sequence[str], sketches: Sequence[str]) -> list[Column]:
    """Roll-up aggregates: counts and sums add, sketches union."""
    return [F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums], *[F.hll_union_agg(s).alias(s) for s in sketches]]


def _rollup(parent: DataFrame, keep: Sequence[str], dims: Sequence[str], sums: Sequence[str], sketches: Sequence[str] = ()) -> DataFrame:
    gid = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in keep)
    return parent.groupBy(*keep).agg(*_merged(sums, sketches)).select(
        *[F.col(d) if d in keep else F.lit(None).cast(parent.schema[d].dataType).alias(d) for d in dims],
        F.lit(gid).cast("bigint").alias("gid"),
        "n",
        *sums,
        *sketches,
    )


def build_cube(df: DataFrame, dims: Sequence[str], measures: dict[str, Column], by_layer: bool = False,
               distinct: dict[str, str] | None = None, cuboids: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Every cuboid of ``dims`` with ``n``, the measure sums and the
    ``distinct`` sketches (read them with ``hll_sketch_estimate``), plus ``gid``.

    ``cuboids`` names the dimensions of the cuboids to hold instead of all of them.
    ``by_layer`` builds every cuboid from its smallest parent: for wide cubes, where
    ``cube`` would expand each base row once per cuboid."""
    base = base_cuboid(df, dims, measures, distinct)
    sums, sketches = list(measures), list(distinct or {})
    if by_layer:
        if cuboids is not None:
            raise ValueError("a cube built by layer holds all cuboids")
        return _cube_by_layer(base, dims, sums, sketches)
    grouped = base.cube(*dims) if cuboids is None else base.groupingSets([[d for d in dims if d in c] for c in cuboids], *dims)
    return grouped.agg(F.grouping_id().alias("gid"), *_merged(sums, sketches)).select(*dims, "gid", "n", *sums, *sketches)


def smallest_parent(dims: Sequence[str], keep: Sequence[str], rows: dict[int, int]) -> int:
    """Of the cuboids one dimension wider than ``keep``, the one with the fewest rows
    (``rows`` by gid, as in C5; ties: the lowest gid)."""
    gid = _gid_of(keep, dims)
    parents = [gid & ~(1 << i) for i in range(len(dims)) if gid & (1 << i)]
    return min((p for p in parents if p in rows), key=lambda p: (rows[p], p))


def cuboid_rows(cube: DataFrame) -> dict[int, int]:
    """Rows of every cuboid that a cube holds, by gid (one entry per cuboid)."""
    return {r.gid: r.n_rows for r in cube.groupBy("gid").agg(F.count(F.lit(1)).alias("n_rows")).collect()}


def _cube_by_layer(base: DataFrame, dims: Sequence[str], sums: Sequence[str], sketches: Sequence[str] = ()) -> DataFrame:
    """Layer k (k dimensions) is rolled up from layer k+1, each cuboid from its
    smallest parent by the row counts of the layer above; each layer is checkpointed
    (written to the shared checkpoint folder)."""
    checkpoint_root(base.sparkSession)
    above = _rollup(base, dims, dims, sums, sketches).checkpoint()
    out = [above]
    for k in range(len(dims) - 1, -1, -1):
        rows = cuboid_rows(above)
        if not rows:  # no base rows: only the grand total would differ, and cube has none either
            break
        parts = []
        for keep in itertools.combinations(dims, k):
            parent = above.filter(F.col("gid") == smallest_parent(dims, keep, rows))
            parts.append(_rollup(parent, keep, dims, sums, sketches))
        above = parts[0]
        for p in parts[1:]:
            above = above.unionByName(p)
        above = above.checkpoint()
        out.append(above)
    result = out[0]
    for p in out[1:]:
        result = result.unionByName(p)
    return result


def _gid_of(keep: Sequence[str], dims: Sequence[str]) -> int:
    return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in keep)


def cuboid_stats(df: DataFrame, dims: Sequence[str], exact: bool = True) -> DataFrame:
    """Number of rows of every cuboid, by ``gid`` and the list of its dimensions.

    Exact by default (column ``rows``: distinct groups of ``cube`` over the base
    cuboid). ``exact=False`` asks for HyperLogLog estimates instead (column
    ``rows_estimate``): one sketch per cuboid in a single pass over the base cuboid."""
    base = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    names = F.array_compact(
        F.array(*[F.when(F.col("gid").bitwiseAND(F.lit(1 << (len(dims) - 1 - i))) == 0, F.lit(d)) for i, d in enumerate(dims)])
    )
    if exact:
        groups = base.cube(*dims).agg(F.grouping_id().alias("gid"))
        stats = groups.groupBy("gid").agg(F.count(F.lit(1)).alias("rows"))
    else:
        n = len(dims)
        aggs = []
        for gid in range(1 << n):
            keep = [d for i, d in enumerate(dims) if not gid & (1 << (n - 1 - i))]
            key = F.xxhash64(*[F.col(d) for d in keep]) if keep else F.lit(0)
            aggs.append(F.struct(F.lit(gid).cast("bigint").alias("gid"), F.approx_count_distinct(key).alias("rows_estimate")))
        stats = base.agg(F.array(*aggs).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.gid", "_s.rows_estimate")
    return stats.select("gid", F.array_join(names, ",").alias("dims"), "rows" if exact else "rows_estimate")


def with_derived(cube: DataFrame, dims: Sequence[str], dim_table: DataFrame, key: str, table_key: str, derived: str, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """A derived dimension: ``derived`` is looked up from ``dim_table`` by the
    cube's ``key`` after the roll-up (it is not stored in the cube), then the
    cuboid of ``group`` + ``key`` is re-aggregated by ``group`` + ``derived``."""
    need = list(group) + [key]
    cub = cube.filter(F.col("gid") == _gid_of(need, dims))
    d = dim_table.select(F.col(table_key).alias(key), derived)
    joined = cub.join(d, key, "inner")
    return joined.groupBy(*group, derived).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums])


def cardinalities(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Approximate distinct count of each column (HyperLogLog), one row of
    (column, approx) per column; ``hll_sketches`` gives mergeable sketches."""
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("approx")) for c in cols])).alias("_c")).select("_c.*")


#: Relative standard deviation of ``approx_count_distinct`` as it is asked for here.
HLL_RSD = 0.05


def within_bound(estimate: str, exact: str, rsd: float = HLL_RSD) -> Column:
    """Whether an estimated distinct count is within three standard deviations."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), 3 * rsd * F.col(exact))


def hll_sketches(df: DataFrame, group: Sequence[str], col: str, lg_k: int = 12) -> DataFrame:
    """Mergeable HLL sketch per group; combine with ``hll_union_agg`` and read
    with ``hll_sketch_estimate``."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(col, lg_k).alias(f"{col}_hll"))


def filter_columns(df: DataFrame, where: Column, candidates: Sequence[str]) -> list[str]:
    """The ``candidates`` that a filter reads: those without which it does not resolve
    against an empty table. A filter on any other column raises."""
    def resolves(names: Sequence[str]) -> bool:
        schema = StructType([f for f in df.schema.fields if f.name in names])
        try:
            df.sparkSession.createDataFrame([], schema).filter(where).schema
            return True
        except AnalysisException:
            return False

    if not resolves(candidates):
        raise ValueError(f"the filter reads a column that is none of {list(candidates)}")
    return [c for c in candidates if not resolves([x for x in candidates if x != c])]


def route(dims: Sequence[str], need: Sequence[str], rows: dict[int, int]) -> int | None:
    """C11: the gid of the smallest stored cuboid that has all dimensions of ``need``
    (``rows`` by gid; ties: the highest gid, the fewest dimensions); None if none has."""
    if not set(need) <= set(dims):
        return None
    missing = _gid_of(need, dims)  # bits that may be rolled up
    fit = [g for g in rows if g & ~missing == 0]
    return min(fit, key=lambda g: (rows[g], -g), default=None)


def query_cube(cube: DataFrame, dims: Sequence[str], want: Sequence[str], measure: str | Sequence[str], where: Column | None = None,
               base: DataFrame | None = None, fallback: bool = False, rows: dict[int, int] | None = None) -> DataFrame:
    """C11: ``sum(measure)`` by ``want`` under a filter on any dimensions, from the
    smallest stored cuboid that covers both, rolled up where it has more dimensions.

    ``rows`` are the stored cuboids' row counts by gid; without them they are counted
    (one small aggregate over the cube). When no stored cuboid covers the query,
    ``fallback`` aggregates ``base`` instead; otherwise it raises."""
    measures = [measure] if isinstance(measure, str) else list(measure)
    try:
        used = [] if where is None else filter_columns(cube, where, dims)
        gid = route(dims, [*want, *used], cuboid_rows(cube) if rows is None else rows)
    except ValueError:
        if not fallback:
            raise
        gid = None
    if gid is not None:
        source = cube.filter(F.col("gid") == gid)
    elif fallback and base is not None:
        source = base
    else:
        raise ValueError(f"no stored cuboid covers {list(want)} and the filter, and fallback is off")
    if where is not None:
        source = source.filter(where)
    if gid == _gid_of(want, dims):
        return source.select(*want, *measures)
    # the row count is a column of the cube, but not of the base table
    counted = [F.count(F.lit(1)).alias(m) if m == "n" and m not in source.columns else F.sum(m).alias(m) for m in measures]
    out = source.groupBy(*want).agg(*counted)
    # a total over no rows is no row, as in the cube itself
    return out if want else out.filter(F.col(measures[0]).isNotNull())


def segment_name(start: str, end: str) -> str:
    """``start_end`` with both bounds in yyyyMMddHHmmss (half-open range)."""
    return f"{start}_{end}"


def check_segments(new: Sequence[tuple[str, str]], stored: Sequence[tuple[str, str]] = ()) -> None:
    """Raise when a new segment is empty or overlaps another one. A stored segment
    of the same range is none: it is replaced."""
    if len(set(new)) != len(new):
        raise ValueError("a segment is named twice")
    for start, end in new:
        if not start < end:
            raise ValueError(f"segment {segment_name(start, end)} is empty")
    ranges = sorted(set(new) | set(stored))
    for (a, b), (c, d) in zip(ranges, ranges[1:]):
        if c < b and ((a, b) in set(new) or (c, d) in set(new)):
            raise ValueError(f"segments {segment_name(a, b)} and {segment_name(c, d)} overlap")


def _stored_ranges(spark, path: str) -> list[tuple[str, str]]:
    return [tuple(n.split("_", 1)) for n in list_segments(spark, path)]


def _write_segments(rows: DataFrame, path: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("segment")
        .parquet(path)
    )


def add_segment(cube_rows: DataFrame, path: str, start: str, end: str) -> None:
    """Write one segment as partition ``segment=start_end``, replacing only it. A
    range that overlaps another stored segment is refused."""
    check_segments([(start, end)], _stored_ranges(cube_rows.sparkSession, path))
    _write_segments(cube_rows.withColumn("segment", F.lit(segment_name(start, end))), path)


def segment_of(time_key: Column, segments: Sequence[tuple[str, str]]) -> Column:
    """The name of the segment whose half-open range holds a yyyyMMddHHmmss text
    key; null outside all of them."""
    ranges = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(segment_name(a, b)).alias("name")) for a, b in segments])
    return F.get(F.filter(ranges, lambda r: (time_key >= r["a"]) & (time_key < r["b"])), 0)["name"]


def add_segments(facts: DataFrame, path: str, time_key: Column, segments: Sequence[tuple[str, str]], dims: Sequence[str],
                 measures: dict[str, Column], finish=lambda cube: cube) -> None:
    """The cubes of several segments in one pass: every fact row gets the segment of
    its ``time_key``, one base cuboid by segment and dimensions is rolled up to all
    cuboids, and one dynamic overwrite writes the segments' partitions. ``finish`` maps
    the cube's rows before they are written; it keeps ``segment``.

    Overlapping ranges are refused. Rows outside all ranges belong to no segment. A
    segment without rows has no partition; a stored one of its range is removed."""
    spark = facts.sparkSession
    stored = _stored_ranges(spark, path)
    check_segments(segments, stored)
    if not segments:
        return
    rows = facts.withColumn("segment", segment_of(time_key, segments)).filter(F.col("segment").isNotNull())
    base = base_cuboid(rows, ["segment", *dims], measures)
    subsets = [list(c) for k in range(len(dims), -1, -1) for c in itertools.combinations(dims, k)]
    cube = base.groupingSets([["segment", *c] for c in subsets], "segment", *dims)
    # segment is in every grouping set, so grouping_id has its bit 0 on top
    cube = cube.agg(F.grouping_id().alias("gid"), *_merged(list(measures), []))
    replaced = [r for r in stored if r in set(segments)]
    _write_segments(finish(cube.select("segment", *dims, "gid", "n", *measures)), path)
    if replaced:
        filled = {r.segment for r in rows.select("segment").distinct().collect()}  # one row per segment
        for start, end in replaced:
            if segment_name(start, end) not in filled:
                _delete(spark, path, segment_name(start, end))


def merge_segments(spark, path: str, start: str, end: str, dims: Sequence[str], sums: Sequence[str]) -> None:
    """The stored segments inside [start, end), which must be adjacent and fill it,
    become one, rolled up from their rows; the old ones go after the new one is written.
    Their rows add up, so no fact is read again."""
    parts = [r for r in _stored_ranges(spark, path) if start <= r[0] and r[1] <= end]
    edges = [start, *[x for r in parts for x in r], end]
    if len(parts) < 2 or any(a != b for a, b in zip(edges[::2], edges[1::2])):
        raise ValueError(f"the stored segments do not fill {segment_name(start, end)}")
    rows = spark.read.parquet(*[os.path.join(path, f"segment={segment_name(*r)}") for r in parts])
    merged = rows.groupBy(*dims, "gid").agg(*_merged(list(sums), []))
    _write_segments(merged.withColumn("segment", F.lit(segment_name(start, end))), path)
    for r in parts:
        _delete(spark, path, segment_name(*r))


def list_segments(spark, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("segment="))


def drop_segment(spark, path: str, start: str, end: str) -> None:
    """Delete a segment; only the first or the last may go."""
    segs = list_segments(spark, path)
    name = segment_name(start, end)
    if name not in segs:
        raise ValueError(f"no segment {name}")
    if name not in (segs[0], segs[-1]):
        raise ValueError(f"segment {name} is in the middle; only the first or last can be dropped")
    _delete(spark, path, name)


def _delete(spark, path: str, name: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"segment={name}"))
    p.getFileSystem(conf).delete(p, True)
