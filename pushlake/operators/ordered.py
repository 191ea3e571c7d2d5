"""Order-dependent operators (W1-W4) and a distributed dense index.

The reference walks a file line by line. Spark has no line numbers and must not
pull all rows into one task, so order is an explicit, totally ordered key (for
text: file, block, position; see ``sources.readers.read_lines``) and all
sequential work is done per *segment*: a contiguous range of that order whose
size is bounded by the input split or by a range partition. Only a per-segment
summary (one row per segment) crosses segment borders.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pushlake.session import checkpoint_root


def _shared(df: DataFrame) -> DataFrame:
    """``df`` is read by two branches that must see the same range partitions. Range
    bounds are sampled anew for every plan that is not the very same, so the rows are
    written once to the shared checkpoint folder and both branches read that."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


#: Bytes (as planned) of a range segment, and lines of a segment of a file split.
SEGMENT_BYTES = 128 << 20
SEGMENT_LINES = 1 << 20


#: Planned sizes beyond this are no sizes: Spark's default for unknown ones, and products
#: of joined tables.
UNKNOWN_BYTES = 1 << 52


def planned_bytes(df: DataFrame) -> int | None:
    """The size of a DataFrame as Spark's optimizer plans it (file sizes, or an upper
    estimate after operators); None where it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else None


def segment_count(size: int, least: int) -> int:
    """Ranges for ``size`` bytes: SEGMENT_BYTES each, at least ``least`` of them."""
    return max(least, -(-size // SEGMENT_BYTES))


def range_segments(df: DataFrame, order: Sequence[str], n: int | None = None, out: str = "_seg") -> DataFrame:
    """Add ``out``: the index of a contiguous range of ``order``. Spark's range
    partitioner samples the keys and cuts them into ``n`` ranges of about equal
    size; by default as many as the input's planned size takes at SEGMENT_BYTES each
    (at least the session's shuffle partitions), so a segment is bounded at any data
    size; the segment is the range partition id."""
    if n is None:
        size = planned_bytes(df)
        if size is None:  # counted instead: as many rows as lines of a file segment
            size = df.count() * (SEGMENT_BYTES // SEGMENT_LINES)
        n = segment_count(size, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(n, *order).withColumn(out, F.spark_partition_id())


def line_segments(lines: DataFrame, size: int = SEGMENT_LINES, out: str = "_sub") -> tuple[DataFrame, list[str]]:
    """(lines, segment columns) for text lines with their order key: a file split, and
    inside it ``out``, a contiguous range of at most ``size`` lines, so that a file that
    cannot be split (gzip) is many segments too."""
    local = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.withColumn(out, F.floor(local / size).cast("long")), ["_file", "_block", out]


def dense_index(df: DataFrame, order: Sequence[str], n_ranges: int | None = None, out: str = "idx") -> DataFrame:
    """0-based dense position of every row in ``order`` (which must be unique).

    One range shuffle sorts rows into ``n_ranges`` ordered partitions (default: the
    session's shuffle partitions), which are checkpointed; the position
    inside a partition comes from ``monotonically_increasing_id`` after a sort within
    the partition, and partition offsets from a one-row-per-partition count table."""
    n_ranges = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    ranged = _shared(ranged.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    ))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per range partition: n_ranges rows, a proven bound
    offsets = counts.select(
        "_part", (F.sum("_cnt").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off")
    )
    return (
        ranged.join(F.broadcast(offsets), "_part", "inner")
        .withColumn(out, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local"))
        .drop("_mid", "_part", "_local", "_off")
    )


def group_runs(
    df: DataFrame,
    key: str,
    value: str,
    order: Sequence[str],
    segment: Sequence[str] | None = None,
    sep: str = "|",
    n_segments: int | None = None,
    pieces: bool = False,
) -> DataFrame:
    """Runs of consecutive rows (in ``order``, which must be unique, as the text
    reader's (file, block, position) is) with equal ``key`` ->
    (key, run_start, values joined by ``sep`` in order, n).

    Rows given here are the accepted ones: a rejected line between two equal keys
    does not break their run. ``segment`` names columns that cut ``order`` into
    contiguous ranges (for text: file and block); without it, ``n_segments`` range
    partitions of ``order`` are used (one range shuffle). Runs may span segments: a one-row-per-segment table
    carries the open run across borders, so no task ever sees more than a segment
    and no key is routed to a single task.

    With ``pieces`` a run is returned as one row per segment it touches
    (``piece_start`` = its first order value): no value is larger than a segment,
    and the pieces of a run joined in ``piece_start`` order give its value."""
    ordc = F.struct(*[F.col(c) for c in order])
    if segment is None:
        df = _shared(range_segments(df, order, n_segments))
        segment = ["_seg"]
    # One struct column per row: both consumers below (the runs and the per-segment
    # summary) read it whole, so column pruning leaves their inputs identical and
    # Spark runs the scan, parse and shuffle once and reuses that exchange.
    base = df.select(*segment, F.struct(F.col(key).alias("k"), F.col(value).alias("v"), ordc.alias("o")).alias("_row"))
    k, o = F.col("_row.k"), F.col("_row.o")
    w = Window.partitionBy(*segment).orderBy(o)
    a = base.withColumn("_prev", F.lag(k).over(w))
    inner_start = F.col("_prev").isNotNull() & (F.col("_prev") != k)
    a = a.withColumn(
        "_start_local",
        F.max(F.when(inner_start, o)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    segs = a.groupBy(*segment).agg(
        F.min_by("_row", o).alias("_first"),
        F.max_by("_row", o).alias("_last"),
        F.max("_start_local").alias("inner_last"),
    )
    # one row per segment: the segments are walked in order on this small table only
    ws = Window.orderBy(*segment)
    prev_last = F.lag(F.col("_last.k")).over(ws)
    segs = segs.withColumn("first_is_start", prev_last.isNull() | (prev_last != F.col("_first.k")))
    segs = segs.withColumn("own_tail", F.coalesce("inner_last", F.when(F.col("first_is_start"), F.col("_first.o"))))
    segs = segs.withColumn("tail", F.last("own_tail", ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, 0)))
    segs = segs.withColumn(
        "carry", F.when(F.col("first_is_start"), F.col("_first.o")).otherwise(F.lag("tail").over(ws))
    ).select(*segment, "carry")
    runs = a.join(segs, list(segment), "inner").withColumn("_run", F.coalesce("_start_local", "carry"))
    keys = [k.alias(key), F.col("_run").alias("run_start")] + ([F.col(c) for c in segment] if pieces else [])
    out = runs.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(o.alias("o"), F.col("_row.v").alias("v")))), lambda x: x["v"]), sep).alias(value),
        F.count(F.lit(1)).alias("n"),
        F.min(o).alias("piece_start"),
    )
    return out.select(key, "run_start", value, "n", "piece_start") if pieces else out.drop("piece_start")


def last_run(runs: DataFrame, key: str, value: str) -> DataFrame:
    """A key seen in a later run is overwritten: the last run of each key wins."""
    return runs.groupBy(key).agg(F.max_by(value, "run_start").alias(value))


def last_run_pieces(pieces: DataFrame, key: str, value: str) -> DataFrame:
    """W2 on runs as pieces (``group_runs(pieces=True)``): the last run of each key, as
    (key, part, value) with its pieces counted from 0 in order. A key's window has one
    row per segment that its last run touches."""
    last = pieces.groupBy(key).agg(F.max("run_start").alias("_last"))
    own = pieces.join(last, key).filter(F.col("run_start") == F.col("_last"))
    part = F.row_number().over(Window.partitionBy(key).orderBy("piece_start")) - 1
    return own.select(key, part.alias("part"), value)


def last_write_wins(df: DataFrame, key: str, order: Sequence[str] | str, fields: Sequence[str]) -> DataFrame:
    """Per key, the fields of the last row in ``order`` (a hash aggregate with
    map-side combine, so a hot key is one row per task before the shuffle)."""
    order = [order] if isinstance(order, str) else list(order)
    pick = F.max(F.struct(*[F.col(c) for c in order], F.struct(*[F.col(f) for f in fields]).alias("_f")))
    return df.groupBy(key).agg(pick.alias("_p")).select(key, *[F.col(f"_p._f.{f}").alias(f) for f in fields])
