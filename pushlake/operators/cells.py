"""Versioned cells as a table, and the keyed lookups over them.

A cell table has columns ``rowkey, family, qualifier, ts (bigint ms), value
(string)``; every (rowkey, family, qualifier) may have many versions. The
reference reads such cells with multi-gets against a store; here each read is a
join of the probe keys with the cell table:

* J1 ``lookup_reversed`` / P10 ``pivot_user``: reversed-key row get, pivoted.
* J2 ``lookup_sum`` / A3 / J5: md5-key get of one column, summed, misses 0.0.
* J3 ``lookup_docs``: document multi-get, duplicates kept.
* J4 ``send_time_value``: chained two-step get (A4 then A5).
* J6 ``exists_split``: semi / anti split.
* U2 ``compact_cells``: same full key replaces, a new ts adds a version.

Scale notes. Versions of one cell are collapsed with hash aggregates that combine
partially on every map task, so a cell with millions of versions costs one row
per task before the shuffle. Joins carry no broadcast hint: AQE turns a join into
a broadcast join at run time when the measured probe side is under the
broadcast threshold, and otherwise keeps a sort-merge join (with skew splitting).
The one exception are the groups beyond ``BROADCAST_N`` rows (``_near_top``), of which
a table has at most a row for each ``BROADCAST_N``.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pushlake.functions import text as X

CELL_COLUMNS = ["rowkey", "family", "qualifier", "ts", "value"]
CELL_KEY = ["rowkey", "family", "qualifier"]
# User-dimension qualifiers (P10) and the family of the report / offline tables.
USER_QUALIFIERS = ("appkey", "apkver", "sdkver", "channel")
REPORT_FAMILY = "A"
# Fixed value: versions summed per cell by the offline lookup (A5).
MAX_VERSIONS = 10000


def compact_cells(cells: DataFrame, write_order: str | None = None) -> DataFrame:
    """One version per (rowkey, family, qualifier, ts): the last write wins
    (by ``write_order`` when given, else the largest value, to stay deterministic)."""
    key = CELL_KEY + ["ts"]
    if write_order:
        pick = F.max_by("value", write_order)
    else:
        pick = F.max("value")
    return cells.groupBy(*key).agg(pick.alias("value")).select(*CELL_COLUMNS)


def latest_cells(cells: DataFrame) -> DataFrame:
    """A4 (value form): the newest version of every cell (a plain get returns one
    version per cell). Ties on ts go to the largest value."""
    return cells.groupBy(*CELL_KEY).agg(F.max(F.struct("ts", "value")).alias("_v")).select(
        *CELL_KEY, F.col("_v.ts").alias("ts"), F.col("_v.value").alias("value")
    )


def latest_ts(cells: DataFrame, family: str | None = None, qualifier: str | Column | None = None) -> DataFrame:
    """A4: (rowkey, qualifier, ts_s): timestamp of the newest version, ms -> s by
    integer division."""
    c = cells
    if family is not None:
        c = c.filter(F.col("family") == family)
    if qualifier is not None:
        c = c.filter(F.col("qualifier") == (qualifier if isinstance(qualifier, Column) else F.lit(qualifier)))
    return c.groupBy("rowkey", "qualifier").agg(F.floor(F.max("ts") / 1000).cast("bigint").alias("ts_s"))


def _rank(d: DataFrame, part: Sequence[str], order: str, n: int, ascending: bool = False) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(F.col(order).asc() if ascending else F.col(order).desc())
    return d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def _salted_rank(rows: DataFrame, keys: Sequence[str], order: str, n: int, ascending: bool = False) -> DataFrame:
    """Top ``n`` per group in three levels: salt over ``s1`` buckets (about four per
    core of the cluster), then ``sqrt(s1)`` buckets, then the group itself. A level
    ranks at most one salt bucket of a group, and every later level at most
    ``n`` rows per bucket it merges, so no task sorts a whole hot group."""
    s1 = max(2, 4 * rows.sparkSession.sparkContext.defaultParallelism)
    s2 = max(2, int(s1 ** 0.5))
    out = rows.withColumn("_s", F.pmod(F.xxhash64(*rows.columns), F.lit(s1)))
    out = _rank(out, list(keys) + ["_s"], order, n, ascending).withColumn("_s", F.pmod(F.col("_s"), F.lit(s2)))
    return _rank(_rank(out, list(keys) + ["_s"], order, n, ascending), keys, order, n, ascending).drop("_s")


# Ranges of the order column counted per group in one step towards its n-th row, and the steps.
RANGES = 1024
STEPS = 2


# From this n on the heavy groups, at most a row for each n of the table, go to the rows.
BROADCAST_N = 10000


def _place(df: DataFrame, order: str, ascending: bool) -> Column | None:
    """An integer ``order`` as a bigint that is larger nearer the top; nulls rank as in a
    window: last, or first with ``ascending``. None for other types."""
    if not isinstance(df.schema[order].dataType, IntegralType):
        return None
    at = F.coalesce(F.col(order).cast("bigint"), F.lit(-(1 << 63)))
    return F.bitwise_not(at) if ascending else at


def _extent(at: Column | None) -> list[Column]:
    return [] if at is None else [F.min(at).alias("_lo"), F.max(at).alias("_hi")]


def _near_top(rows: DataFrame, keys: Sequence[str], order: str, n: int, ascending: bool, heavy: DataFrame) -> DataFrame:
    """The rows of the ``heavy`` groups (keys, and ``_extent`` of their places) down to
    about their ``n``-th, without a sort of a whole group. Each step counts a group's rows
    by equal ranges of an integer ``order`` (partial aggregates) and goes on inside the
    range that holds the ``n``-th row, between the values seen there, so that a far outlier
    costs one step. What is left is the first ``n`` rows and the rest of one range.
    ``order`` of another type: all rows."""
    inner = [f"_k{i}" for i in range(len(keys))]
    few = F.broadcast if n >= BROADCAST_N else (lambda df: df)
    edge = heavy.withColumnsRenamed(dict(zip(keys, inner)))
    at = _place(rows, order, ascending)
    if at is None:
        return rows.join(few(edge), _same(keys), "left_semi")
    edge = edge.withColumn("_left", F.lit(n).cast("long"))
    for _ in range(STEPS):
        lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
        part = F.floor((F.col("_at").cast("double") - lo) / (hi - lo + 1) * RANGES)
        inside = rows.select(*keys, at.alias("_at")).join(few(edge), _same(keys)).filter(F.col("_at").between(F.col("_lo"), F.col("_hi")))
        counts = inside.groupBy(*inner, "_left", part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"), *_extent(F.col("_at")))
        above = Window.partitionBy(*inner).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_over", F.sum("_c").over(above) - F.col("_c"))
        edge = counts.filter((F.col("_over") < F.col("_left")) & (F.col("_over") + F.col("_c") >= F.col("_left")))
        edge = edge.select(*inner, "_lo", "_hi", (F.col("_left") - F.col("_over")).alias("_left"))
    return rows.withColumn("_at", at).join(few(edge.select(*inner, "_lo")), _same(keys)).filter(F.col("_at") >= F.col("_lo")).select(*rows.columns)


def _same(keys: Sequence[str]) -> Column:
    """The keys equal ``_k0``, ``_k1``...; null is a key as well."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


# Largest n ranked with one window: Spark cuts each group to n rows per map task,
# so a hot group reaches one reducer with n rows per task (n * tasks rows in all).
PLAIN_TOP_N = 100


def _use_salt(df: DataFrame, n: int, salted: bool | None) -> bool:
    if salted is not None:
        return salted
    # the per-task group limit exists only up to the session's threshold
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    return n > min(threshold, PLAIN_TOP_N)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: str, n: int, salted: bool | None = None,
                    ascending: bool = False) -> DataFrame:
    """The ``n`` rows with the largest ``order`` (smallest with ``ascending``) of
    every group of ``keys``. ``order`` must be unique within a group.

    For small ``n`` (``PLAIN_TOP_N``, and within the session's
    ``spark.sql.optimizer.windowGroupLimitThreshold``) Spark cuts each group to ``n``
    rows on every map task before the shuffle, so one window is enough. For larger
    ``n`` a hot group would reach one task with ``n`` rows per map task or all its
    rows, so groups are counted first (a partial aggregate): groups with at most
    ``n`` rows are kept as they are, and only the first rows of larger groups
    (``_near_top``) are ranked, in salted levels."""
    if not _use_salt(df, n, salted):
        return _rank(df, keys, order, n, ascending)
    heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), *_extent(_place(df, order, ascending))).filter(F.col("_c") > n).drop("_c")
    light = df.join(heavy.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]), _same(keys), "left_anti")
    return light.unionByName(_salted_rank(_near_top(df, keys, order, n, ascending, heavy), keys, order, n, ascending))


def sum_versions(cells: DataFrame, n: int = MAX_VERSIONS, salted: bool | None = None) -> DataFrame:
    """A5: per cell, the sum of the newest ``n`` versions read as ints, as bigint
    (no 32-bit wrap, D8).

    Skew-safe without sorting ordinary cells: one partial aggregate gives every
    cell's version count and full sum, which is the answer for cells with at most
    ``n`` versions. Only the rows of cells with more versions are read again, cut to
    those near the newest ``n`` (``_near_top``) and ranked in salted levels."""
    val = F.col("value").try_cast("int").cast("bigint")
    if not _use_salt(cells, n, salted):
        return _rank(cells, CELL_KEY, "ts", n).groupBy(*CELL_KEY).agg(F.sum(val).alias("total"))
    per = cells.groupBy(*CELL_KEY).agg(F.count(F.lit(1)).alias("_c"), F.sum(val).alias("total"), *_extent(_place(cells, "ts", False)))
    light = per.filter(F.col("_c") <= n).select(*CELL_KEY, "total")
    heavy = per.filter(F.col("_c") > n).drop("_c", "total")
    heavy = _salted_rank(_near_top(cells, CELL_KEY, "ts", n, False, heavy), CELL_KEY, "ts", n)
    return light.unionByName(heavy.groupBy(*CELL_KEY).agg(F.sum(val).alias("total")))


def pivot_user(cells: DataFrame, qualifiers: Sequence[str] = USER_QUALIFIERS) -> DataFrame:
    """P10: one row per rowkey with the newest value of each qualifier (family ignored);
    an absent qualifier is null."""
    aggs = [
        F.max(F.when(F.col("qualifier") == q, F.struct("ts", "value")))["value"].alias(q) for q in qualifiers
    ]
    return cells.filter(F.col("qualifier").isin(*qualifiers)).groupBy("rowkey").agg(*aggs)


def lookup_reversed(keys: DataFrame, key_col: str, cells: DataFrame, qualifiers: Sequence[str] = USER_QUALIFIERS) -> DataFrame:
    """J1 + P10: rows stored under the reversed key; key set made distinct, misses
    omitted, the original key restored."""
    probe = keys.select(F.col(key_col).cast("string").alias("uid")).distinct().withColumn("rowkey", X.reverse_key("uid"))
    # one join brings the original key along; rowkey and uid are 1:1, so pivoting by
    # uid is pivoting by row
    hit = cells.filter(F.col("qualifier").isin(*qualifiers)).join(probe, "rowkey", "inner")
    aggs = [F.max(F.when(F.col("qualifier") == q, F.struct("ts", "value")))["value"].alias(q) for q in qualifiers]
    return hit.groupBy("uid").agg(*aggs)


def lookup_sum(
    keys: DataFrame,
    key_col: str,
    cells: DataFrame,
    family: str,
    qualifier: str | None,
    key_fn: Callable[[Column], Column] = X.md5_key,
    default: float = 0.0,
) -> DataFrame:
    """J2 + A3 + J5: per distinct key, the sum of the matching cells of row
    ``key_fn(key)`` (each cell read at its newest version), as double; a key without
    cells gets ``default``. ``qualifier=None`` sums every qualifier of the family."""
    c = cells.filter(F.col("family") == family)
    if qualifier is not None:
        # one column per row is left, so the newest version per row key is the answer:
        # one aggregate (one shuffle) instead of newest-per-cell then sum-per-row
        newest = c.filter(F.col("qualifier") == qualifier).groupBy("rowkey").agg(F.max(F.struct("ts", "value")).alias("_v"))
        per_row = newest.select("rowkey", F.col("_v.value").try_cast("double").alias("total"))
    else:
        per_row = latest_cells(c).groupBy("rowkey").agg(F.sum(F.col("value").try_cast("double")).alias("total"))
    probe = keys.select(F.col(key_col).cast("string").alias("key")).distinct().withColumn("rowkey", key_fn(F.col("key")))
    return fill_missing(probe, per_row, "rowkey", "total", default).select("key", "total")


def fill_missing(keys: DataFrame, result: DataFrame, on: str, col: str, default) -> DataFrame:
    """Every key of ``keys`` with its ``col`` from ``result``, ``default`` for misses."""
    return keys.join(result, on, "left").withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def lookup_docs(keys: DataFrame, key_col: str, docs: DataFrame, doc_key: str = "uid") -> DataFrame:
    """The document of every probe key; misses omitted, duplicate keys kept."""
    probe = keys.select(F.col(key_col).cast("string").alias(doc_key))
    return probe.join(docs, doc_key, "inner")


def exists_split(updates: DataFrame, docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(updates whose key exists in ``docs``, updates whose key does not)."""
    ids = docs.select(key)
    return updates.join(ids, key, "left_semi"), updates.join(ids, key, "left_anti")


def send_time_value(
    msg_keys: DataFrame,
    key_col: str,
    report_cells: DataFrame,
    offline_cells: DataFrame,
    appkey: str,
    column: str,
    n_versions: int = MAX_VERSIONS,
) -> DataFrame:
    """For every input line (duplicates kept): msgid = trimmed line; ts = newest
    report-cell time of (msgid, A:appkey) in seconds; lines without a positive ts are
    dropped (F6); value = sum of the newest versions of offline cell
    (msgid + appkey + ts, A:column), 0 when absent. Output (msgid, ts, value)."""
    lines = msg_keys.select(X.java_trim(F.col(key_col).cast("string")).alias("msgid"))
    probe = lines.select("msgid").distinct()
    sent = latest_ts(report_cells.join(probe.withColumnRenamed("msgid", "rowkey"), "rowkey", "left_semi"), REPORT_FAMILY, appkey)
    sent = sent.select(F.col("rowkey").alias("msgid"), F.col("ts_s").alias("ts")).filter(F.col("ts") > 0)
    sent = sent.withColumn("rowkey", X.concat_key("msgid", F.lit(appkey), "ts"))
    offline = offline_cells.filter((F.col("family") == REPORT_FAMILY) & (F.col("qualifier") == column))
    offline = offline.join(sent.select("rowkey"), "rowkey", "left_semi")
    totals = sum_versions(offline, n_versions).select("rowkey", "total")
    keyed = fill_missing(sent, totals, "rowkey", "total", 0)
    return lines.join(keyed.select("msgid", "ts", F.col("total").cast("bigint").alias("value")), "msgid", "inner")


def to_cells(
    df: DataFrame,
    rowkey: Column,
    family: str | Column,
    qualifier: str | Column,
    value: Column,
    ts: Column | int,
    key_fn: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """K6: project rows to cells; ``ts`` is a column (per-row time) or one literal
    (batch time); ``key_fn`` (e.g. ``md5_key``) transforms the row key on write, the
    same function lookups take, so both sides agree (D5)."""
    k = rowkey.cast("string")
    return df.select(
        (key_fn(k) if key_fn else k).alias("rowkey"),
        (F.lit(family) if isinstance(family, str) else family).alias("family"),
        (F.lit(qualifier) if isinstance(qualifier, str) else qualifier).alias("qualifier"),
        (F.lit(ts) if isinstance(ts, int) else ts).cast("bigint").alias("ts"),
        value.cast("string").alias("value"),
    )


def newest_versions(cells: DataFrame, n: int, salted: bool | None = None) -> DataFrame:
    """The newest ``n`` versions of every cell (see ``top_n_per_group``)."""
    return top_n_per_group(cells, CELL_KEY, "ts", n, salted)
