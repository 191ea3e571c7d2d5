"""Aggregations (A1, A2, A6-A11) and paging.

All of them are Spark aggregates with partial (map-side) aggregation, so a hot
key is combined on each map task before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pushlake.functions._cols import ColumnOrName, as_col
from pushlake.session import scratch_path


def applist_time(itime: ColumnOrName) -> Column:
    """A2: group timestamp: a positive 10-digit itime times 1000, else null (the store's
    own time). Several candidates: the largest wins (D7)."""
    t = as_col(itime)
    ok = (F.length(t.cast("string")) == 10) & (t > 0)
    return (F.max(F.when(ok, t)) * 1000).cast("bigint")


def applist_by_imei(df: DataFrame, salt_buckets: int = 0, max_items: int | None = None) -> DataFrame:
    """A1 + A2: group app rows by imei -> (imei, itime_ms, applist JSON of sorted
    ``{name, pkg}``); empty imei dropped.

    The list is the output, so one imei's rows end in one value. ``collect_list``
    aggregates partially on every map task; with ``salt_buckets`` > 0 a second
    salted stage splits the sort of very hot imeis before the final merge. With
    ``max_items`` no value holds more than about that many apps: an imei's list is
    cut into ``part`` rows (``parts`` of them), hash-assigned after a distributed
    count, each sorted; their union is the imei's list."""
    src = df.filter(F.length("imei") > 0).select(
        "imei", F.struct(F.col("name"), F.col("pkg")).alias("app"), "itime"
    )
    if max_items:
        per = src.groupBy("imei").agg(
            applist_time("itime").alias("itime_ms"),
            F.ceil(F.count(F.lit(1)) / F.lit(max_items)).cast("int").alias("parts"),
        )
        tagged = src.join(per.select("imei", "parts"), "imei").withColumn(
            "part", F.pmod(F.xxhash64("app", "itime"), F.col("parts")).cast("int")
        )
        lists = tagged.groupBy("imei", "part", "parts").agg(F.to_json(F.sort_array(F.collect_list("app"))).alias("applist"))
        return lists.join(per.select("imei", "itime_ms"), "imei").select("imei", "part", "parts", "itime_ms", "applist")
    if salt_buckets and salt_buckets > 1:
        salted = src.withColumn("_salt", F.pmod(F.xxhash64("app", "itime"), F.lit(salt_buckets)))
        part = salted.groupBy("imei", "_salt").agg(
            F.sort_array(F.collect_list("app")).alias("apps"),
            F.max(F.when((F.length(F.col("itime").cast("string")) == 10) & (F.col("itime") > 0), F.col("itime"))).alias("t"),
        )
        return part.groupBy("imei").agg(
            (F.max("t") * 1000).cast("bigint").alias("itime_ms"),
            F.to_json(F.sort_array(F.flatten(F.collect_list("apps")))).alias("applist"),
        )
    return src.groupBy("imei").agg(
        applist_time("itime").alias("itime_ms"),
        F.to_json(F.sort_array(F.collect_list("app"))).alias("applist"),
    )


def row_count(df: DataFrame) -> DataFrame:
    """Global row count as one row; 0 on empty input (``count`` not
    ``sum(1)``)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def global_agg(df: DataFrame, *aggs: Column) -> DataFrame:
    """A global aggregate without GROUP BY: always exactly one row, also on empty
    input (the HAVING COUNT(1) > 0 of BI tools is dropped)."""
    return df.agg(*aggs)


def top_groups(df: DataFrame, dims: Sequence[str], measure: str, n: int, order: Sequence[Column] | None = None) -> DataFrame:
    """Sum of a measure by dimensions, limited to ``n`` groups. An explicit order
    makes the limit deterministic (top-k)."""
    out = df.groupBy(*dims).agg(F.sum(measure).alias(f"sum_{measure}"))
    if order is not None:
        out = out.orderBy(*order)
    return out.limit(n)


def hour_day_stats(df: DataFrame, day: str, hour: str, aggs: Sequence[Column], extra_keys: Sequence[str] = ()) -> DataFrame:
    """Hour stats and day stats of the same input in one pass
    (GROUPING SETS ((keys, day, hour), (keys, day))), with ``grain`` = hour / day.

    One scan serves both grains, for any aggregates. Exact distinct counts expand each
    row once per distinct column and grain before the partial aggregate: use
    ``hour_day_counts`` where counts are all that is wanted, or
    ``hour_day_stats_sketched`` for estimates."""
    keys = list(extra_keys) + [day, hour]
    # Column-API grouping sets: one Expand + one partial aggregate, one shuffle.
    return df.groupingSets([keys, list(extra_keys) + [day]], *keys).agg(
        F.when(F.grouping(hour) == 1, F.lit("day")).otherwise(F.lit("hour")).alias("grain"), *aggs
    )


HOURS = 24


def hour_day_counts(df: DataFrame, day: str, hour: str, count: str, distinct: dict[str, str]) -> DataFrame:
    """A11 with exact distinct counts from one partitioning: rows per hour and day
    (``count``) and distinct values of each ``distinct`` entry (name -> column), as
    (day, hour, grain, counts...). ``day`` is an int yyyyMMdd, ``hour`` yyyyMMddHH.

    A record becomes one row per counted column, whatever the grains. These are grouped
    once by (day, column, value) with a bit for every hour the value was seen in: the
    groups of a day are its distinct values, and those with the bit of an hour are the
    hour's. So there is no Expand by grain, both grains come from one shuffle with map-side
    combine, and a hot day or hour is spread by value."""
    kinds = {df.schema[c].dataType for c in distinct.values()}
    value = (lambda c: F.col(c)) if len(kinds) == 1 else (lambda c: F.col(c).cast("string"))
    nothing = F.lit(None).cast(kinds.pop() if len(kinds) == 1 else "string")
    bit = F.expr(f"shiftleft(1L, cast(`{hour}` % 100 as int))")
    # the rows of an hour are one group, told apart from values by its tag
    parts = [F.struct((F.lit(-1) - F.col(hour) % 100).cast("int").alias("tag"), nothing.alias("value"))]
    parts += [F.struct(F.lit(i).alias("tag"), value(c).alias("value")) for i, c in enumerate(distinct.values())]
    rows = df.select(F.col(day).alias("day"), bit.alias("bit"), F.inline(F.array(*parts))).filter("tag < 0 or value is not null")
    seen = rows.groupBy("day", "tag", "value").agg(F.count(F.lit(1)).alias("c"), F.bit_or("bit").alias("hours"))
    # by day and column: one number for each hour and one for the day
    adds = F.when(F.col("tag") < 0, F.col("c")).otherwise(1)
    seen = seen.select("day", F.greatest("tag", F.lit(-1)).alias("tag"), adds.alias("adds"), "hours")
    in_hour = [F.sum(F.when(F.shiftright("hours", h).bitwiseAND(F.lit(1)) == 1, F.col("adds")).otherwise(0)).alias(f"h{h}") for h in range(HOURS)]
    days = seen.groupBy("day", "tag").agg(F.sum("adds").alias("all"), *in_hour)
    slots = [F.struct(F.lit(h).alias("h"), F.col(f"h{h}").alias("x")) for h in range(HOURS)] + [F.struct(F.lit(HOURS).alias("h"), F.col("all").alias("x"))]
    long = days.select("day", "tag", F.inline(F.array(*slots)))
    names = [count, *distinct]
    out = long.groupBy("day", "h").agg(*[F.coalesce(F.max(F.when(F.col("tag") == i - 1, F.col("x"))), F.lit(0)).alias(n) for i, n in enumerate(names)])
    is_day = F.col("h") == HOURS
    return out.filter(F.col(count) > 0).select(
        F.col("day").alias(day),
        F.when(~is_day, F.col("day") * 100 + F.col("h")).cast(df.schema[hour].dataType).alias(hour),
        F.when(is_day, "day").otherwise("hour").alias("grain"),
        *names,
    )


def page(df: DataFrame, order: Sequence[ColumnOrName], limit: int = 0, offset: int = 0) -> DataFrame:
    """LIMIT / OFFSET paging over a total order; a limit or offset <= 0 means none.

    With an offset the rows are written once in range partitions of ``order`` and counted
    by partition; only the partitions that hold the page are read again, and only in
    the first and the last of them are rows counted. So no task sorts or skips more
    than one range, at any depth."""
    keys = [as_col(c) for c in order]
    if offset <= 0:
        out = df.orderBy(*keys)
        return out.limit(limit) if limit > 0 else out
    path = scratch_path(df.sparkSession, "pages")
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    ranged.write.partitionBy("_part").parquet(path)
    stored = df.sparkSession.read.schema(ranged.schema).parquet(path)
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()  # one row per range
    return _cut(stored, keys, [(r["_part"], r.n) for r in sizes], limit, offset).drop("_part").orderBy(*keys)


def page_parts(sizes: Sequence[tuple[int, int]], limit: int, offset: int) -> list[tuple[int, int, int]]:
    """(part, first, end) of the rows of a page, counted from 1 inside each of the ordered
    parts (part, rows) that hold it."""
    end = offset + limit if limit > 0 else sum(n for _, n in sizes)
    out, before = [], 0
    for part, n in sizes:
        first, last = max(offset - before, 0), min(end - before, n)
        if first < last:
            out.append((part, first + 1, last))
        before += n
    return out


def _cut(stored: DataFrame, keys: Sequence[Column], sizes: Sequence[tuple[int, int]], limit: int, offset: int) -> DataFrame:
    whole = dict(sizes)
    parts = page_parts(sizes, limit, offset)
    inner = [p for p, first, last in parts if first == 1 and last == whole[p]]
    out = stored.filter(F.col("_part").isin(inner)) if inner else stored.filter("false")
    for p, first, last in parts:
        if p not in inner:
            place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
            edge = stored.filter(F.col("_part") == p).withColumn("_place", place)
            out = out.unionByName(edge.filter(F.col("_place").between(first, last)).drop("_place"))
    return out


def first_n_per_group(df: DataFrame, group: Sequence[str], order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group in ascending ``order`` (unique within a
    group); skew-safe for large ``n`` (``cells.top_n_per_group``)."""
    from pushlake.operators.cells import top_n_per_group

    return top_n_per_group(df, group, order, n, ascending=True)


def group_page(df: DataFrame, group: Sequence[str], order: str, size: int, number: int) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows of each group in ascending ``order``
    (unique within a group). One range partitioning by group and order gives every row its
    place in the whole table, and the first place of each group (a small aggregate) the
    place in its group: so any page is a filter, and a hot group spreads over ranges."""
    from pushlake.operators.ordered import dense_index

    placed = dense_index(df, [*group, order], out="_at")
    first = placed.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(F.min("_at").alias("_first"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    place = F.col("_at") - F.col("_first")
    return placed.join(first, same).filter((place >= size * (number - 1)) & (place < size * number)).select(*df.columns)


def observe_counts(parsed: DataFrame, observation, reason_col: str = "reject_reason") -> DataFrame:
    """A10: attach accepted / rejected / total counters to a parsed DataFrame; they
    are filled by the first action, with no extra pass over the data."""
    return parsed.observe(
        observation,
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col(reason_col).isNull(), 1)).alias("accepted"),
        F.count(F.col(reason_col)).alias("rejected"),
    )


#: Relative standard deviation of a sketch of 2**12 registers.
SKETCH_RSD = 0.0163


def hour_day_stats_sketched(df: DataFrame, day: str, hour: str, distinct: dict[str, str], count: str = "n",
                            lg_k: int = 12) -> DataFrame:
    """A11 at scale with approximate distinct counts: hour rows aggregate the input
    once (a count and one HLL sketch per ``distinct`` entry, name -> column); day
    rows are rolled up from the hour rows (counts add, sketches union), so the
    input is read and shuffled once and no distinct-count Expand is needed. Same
    output shape as ``hour_day_stats``, with estimated distinct counts."""
    hours = df.groupBy(day, hour).agg(
        F.count(F.lit(1)).alias(count), *[F.hll_sketch_agg(c, lg_k).alias(f"_{k}") for k, c in distinct.items()]
    )
    days = hours.groupBy(day).agg(F.sum(count).alias(count), *[F.hll_union_agg(f"_{k}").alias(f"_{k}") for k in distinct])
    est = [F.hll_sketch_estimate(f"_{k}").alias(k) for k in distinct]
    return hours.select(day, hour, F.lit("hour").alias("grain"), count, *est).unionByName(
        days.select(day, F.lit(None).cast(df.schema[hour].dataType).alias(hour), F.lit("day").alias("grain"), count, *est)
    )
