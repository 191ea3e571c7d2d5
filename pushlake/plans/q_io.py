"""Checked queries: sources and sinks as round trips through files (S1-S9, K1-K4,
K8, K9, U3, E1). Files go to a fresh folder under the session's checkpoint dir."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.functions.timekeys import ntz_key, ntz_parts
from pushlake.operators import parse as P
from pushlake.plans import fixtures as fx
from pushlake.plans.fixture_sql import (
    APPLIST_ROWS, HTTP_LINES, HTTP_RECORDS, MSG_KEY_LINES, PAIR_LINES, PUSH_EVENTS, PUSH_OBJECTS, PUSH_ROWS, STATS_CELLS, USER_CELLS,
)
from pushlake.plans.q_parse import HOUR_STATS_SQL, _jt, hour_stats_of, http_records
from pushlake.plans.registry import register
from pushlake.session import scratch_path
from pushlake.sources import readers as S
from pushlake.sources import sinks as K

HTTP_COLS = ", ".join(P.HTTP_API_COLUMNS)
RECORDS_SQL = f"WITH {HTTP_LINES}, {HTTP_RECORDS} SELECT {HTTP_COLS} FROM http_records"


def write_lines(df: DataFrame, path: str, order: str | None = None) -> str:
    out = df.repartitionByRange(4, order).sortWithinPartitions(order) if order else df
    out.select("line").write.text(path)
    return path


@register("s1_read_lines", sql=RECORDS_SQL)
def s1_read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1: HTTP lines written as text and parsed back line by line."""
    path = write_lines(fx.http_lines(spark, sf_dir), scratch_path(spark, "http_lines"), "event_id")
    return P.accepted(P.parse_http_api(S.read_lines(spark, path))).select(*P.HTTP_API_COLUMNS)


@register("s2_read_many", sql=f"""
WITH {HTTP_LINES}, {PAIR_LINES}
SELECT line AS value FROM http_lines UNION ALL SELECT line AS value FROM pair_lines""")
def s2_read_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two text inputs read as one."""
    a = write_lines(fx.http_lines(spark, sf_dir), scratch_path(spark, "http_lines"))
    b = write_lines(fx.pair_lines(spark, sf_dir), scratch_path(spark, "pair_lines"))
    return S.read_many(spark, f"{a},{b}", "text")


@register("s3_read_applist_orc", sql=f"""
WITH {APPLIST_ROWS}
SELECT imei, pkg, name, itime FROM applist_rows WHERE imei IS NOT NULL AND pkg IS NOT NULL AND name IS NOT NULL AND itime IS NOT NULL""")
def s3_read_applist_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: app rows written as ORC, read back with the declared schema; null rows dropped."""
    path = scratch_path(spark, "applist_orc")
    K.to_orc(fx.applist_rows(spark, sf_dir), path)
    return S.read_applist_orc(spark, path)


@register("s3_rejects", sql=f"""
WITH {APPLIST_ROWS}
SELECT imei, pkg, name, itime, CASE WHEN imei IS NULL THEN 'imei' WHEN pkg IS NULL THEN 'pkg' WHEN name IS NULL THEN 'name' WHEN itime IS NULL THEN 'itime' ELSE 'accepted' END AS outcome
FROM applist_rows""")
def s3_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + P11: accepted and rejected app rows written from one evaluation; together they
    are all rows."""
    orc, good, bad = (scratch_path(spark, n) for n in ("applist_orc", "applist_good", "applist_bad"))
    K.to_orc(fx.applist_rows(spark, sf_dir), orc, options=K.ORC_PLAIN)
    K.write_split(S.checked_applist_orc(spark, orc), lambda rows: K.to_orc(rows, good, options=K.ORC_PLAIN), lambda rows: rows.write.orc(bad))
    columns = ["imei", "pkg", "name", "itime"]
    rejected = spark.read.orc(bad).select(*columns, F.col(P.REJECT).alias("outcome"))
    return spark.read.schema(S.APPLIST_SCHEMA).orc(good).select(*columns, F.lit("accepted").alias("outcome")).unionByName(rejected)


HOUR_TEMPLATE = "y={yyyy}/m={MM}/d={dd}/h={yyyyMMddHH}"


def write_hour_dirs(spark: SparkSession, sf_dir: str, files: int = 1) -> tuple[str, dt.datetime, dt.datetime]:
    """HTTP lines under one directory per (UTC) hour of their event, up to ``files`` files
    each."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    lines = fx.http_lines(spark, sf_dir).join(ev, "event_id")
    p = ntz_parts("ts")
    lines = lines.select("line", p["yyyy"].alias("y"), p["MM"].alias("m"), p["dd"].alias("d"), ntz_key("ts", "hour").alias("h"))
    path = scratch_path(spark, "hour_dirs")
    lines.repartition("h", *([F.pmod(F.xxhash64("line"), F.lit(files))] if files > 1 else [])).write.partitionBy("y", "m", "d", "h").text(path)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    return path, lo, hi + dt.timedelta(hours=1)


@register("s4_read_hours", sql=RECORDS_SQL)
def s4_read_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP lines in hour directories, read for the events' hour range."""
    base, start, end = write_hour_dirs(spark, sf_dir)
    lines = S.read_hours(spark, base, start, end, template=HOUR_TEMPLATE, absent="skip")
    return P.accepted(P.parse_http_api(lines)).select(*P.HTTP_API_COLUMNS)


@register("s5_scan_two_as_text", sql="SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, coalesce(c_name, 'null') AS c_name FROM customer")
def s5_scan_two_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two customer columns as text."""
    return S.scan_two_as_text(fx.table(spark, sf_dir, "customer"))


STATS_TEMPLATE_SQL = "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM {view} GROUP BY event_type"


@register("e1_stats_template", sql=STATS_TEMPLATE_SQL.format(view="events"))
def e1_stats_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepare (register the input) -> make SQL -> query -> (save)."""
    view = "pushlake_events_stats_input"
    return S.run_stats(
        spark,
        mk_sql=lambda: STATS_TEMPLATE_SQL.format(view=view),
        prepare=lambda: fx.table(spark, sf_dir, "events").createOrReplaceTempView(view),
    )


@register("s7_topic_values", sql=f"WITH {HTTP_LINES} SELECT line AS body FROM http_lines WHERE event_id % 23 <> 0")
def s7_topic_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 on message rows shaped like a topic's (binary ``value``, some null)."""
    lines = fx.http_lines(spark, sf_dir)
    msgs = lines.select(F.when(F.col("event_id") % 23 != 0, F.col("line").cast("binary")).alias("value"))
    return S.topic_values(msgs)


@register("s8_read_cells_tsv", sql=f"WITH {STATS_CELLS} SELECT * FROM stats_cells")
def s8_read_cells_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells written as five-field TSV lines and read back."""
    path = scratch_path(spark, "cells_tsv")
    c = fx.stats_cells(spark, sf_dir)
    c.select(F.concat_ws("\t", "rowkey", F.col("ts").cast("string"), "value", "family", "qualifier").alias("line")).write.text(path)
    return S.read_cells_tsv(spark, path)


@register("s8_rejects", sql=f"""
WITH {STATS_CELLS}
SELECT ts % 3 AS k, CASE ts % 3 WHEN 1 THEN 'ts' WHEN 2 THEN 'fields' ELSE 'accepted' END AS outcome, count(*) AS n FROM stats_cells GROUP BY ts % 3""")
def s8_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + P11: cell lines, of which a third has no valid time and a third four fields:
    rejects and cells from one evaluation add up to all lines."""
    path, good, bad = (scratch_path(spark, n) for n in ("cells_tsv", "cells_good", "cells_bad"))
    k, ts = F.col("ts") % 3, F.col("ts").cast("string")
    time = F.when(k == 1, F.concat(F.lit("t"), ts)).otherwise(ts)
    line = F.concat_ws("\t", F.concat_ws(":", k.cast("string"), "rowkey"), time, "value", "family", F.when(k != 2, F.col("qualifier")))
    fx.stats_cells(spark, sf_dir).select(line.alias("line")).write.text(path)
    K.write_split(S.checked_cells_tsv(spark, path), lambda rows: rows.drop("line").write.parquet(good), lambda rows: rows.select("line", P.REJECT).write.parquet(bad))
    cells = spark.read.parquet(good).select(F.substring("rowkey", 1, 1).cast("long").alias("k"), F.lit("accepted").alias("outcome"))
    rejected = spark.read.parquet(bad).select(F.substring("line", 1, 1).cast("long").alias("k"), F.col(P.REJECT).alias("outcome"))
    return cells.unionByName(rejected).groupBy("k", "outcome").agg(F.count(F.lit(1)).alias("n"))


@register("s9_read_keys", sql=f"WITH {MSG_KEY_LINES} SELECT {_jt('line')} AS key FROM msg_key_lines")
def s9_read_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key file read back with Java trim."""
    path = write_lines(fx.msg_key_lines(spark, sf_dir), scratch_path(spark, "keys"))
    return S.read_keys(spark, path, trim=True)


@register("k1_to_orc", sql=RECORDS_SQL)
def k1_to_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: parsed records through ORC."""
    path = scratch_path(spark, "http_orc")
    K.to_orc(http_records(spark, sf_dir).select(*P.HTTP_API_COLUMNS), path)
    return spark.read.orc(path)


@register("k2_to_parquet_typed", sql=RECORDS_SQL)
def k2_to_parquet_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: parsed records through the typed GZIP Parquet writer."""
    path = scratch_path(spark, "http_parquet")
    K.to_parquet_typed(http_records(spark, sf_dir).select(*P.HTTP_API_COLUMNS), path)
    return spark.read.parquet(path)


PUSH_LINES_SQL = f"""
WITH {PUSH_EVENTS}, {PUSH_OBJECTS}, {PUSH_ROWS}
SELECT appkey || chr(1) || platform || chr(1) || CAST(msg_id AS VARCHAR) || chr(1) || CAST(uid AS VARCHAR) || chr(1) || CAST(itime AS VARCHAR) AS value
FROM push_rows"""


@register("k3_to_ctrl_a_text", sql=PUSH_LINES_SQL)
def k3_to_ctrl_a_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: push rows written as \\u0001 text."""
    from pushlake.streaming.consume import push_records

    path = scratch_path(spark, "push_text")
    K.to_ctrl_a_text(push_records(fx.push_messages(spark, sf_dir)), P.PUSH_COLUMNS, path)
    return spark.read.text(path)


@register("k4_topic_records", sql=f"WITH {HTTP_LINES} SELECT {_jt('line')} AS value FROM http_lines")
def k4_topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: lines as topic values (trimmed)."""
    return K.topic_records(fx.http_lines(spark, sf_dir))


@register("k8_to_sorted_cells", sql=f"WITH {USER_CELLS} SELECT * FROM user_cells")
def k8_to_sorted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: user cells through the sorted bulk-load writer."""
    path = scratch_path(spark, "sorted_cells")
    K.to_sorted_cells(fx.user_cells(spark, sf_dir), 4, path)
    return spark.read.parquet(path)


DAY_SQL = f"""
WITH stats AS ({HOUR_STATS_SQL.replace('WITH ', 'WITH ', 1)})
SELECT CAST(iday // 100 AS VARCHAR) AS month, lpad(CAST(iday % 100 AS VARCHAR), 2, '0') AS day, n_msgs, n_appkeys, n_msgids
FROM stats WHERE grain = 'day'"""

DAY_SCHEMA = "n_msgs bigint, n_appkeys bigint, n_msgids bigint, month string, day string"


def _day_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = hour_stats_of(http_records(spark, sf_dir)).filter(F.col("grain") == "day")
    return stats.select(
        "n_msgs", "n_appkeys", "n_msgids",
        (F.col("iday") / 100).cast("bigint").cast("string").alias("month"),
        F.lpad((F.col("iday") % 100).cast("string"), 2, "0").alias("day"),
    )


@register("k9_to_day_partitions", sql=DAY_SQL)
def k9_to_day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: day stats written to month/day partitions."""
    path = scratch_path(spark, "day_stats")
    K.to_day_partitions(_day_rows(spark, sf_dir), path)
    return spark.read.schema(DAY_SCHEMA).parquet(path)


@register("u3_rerun_day", sql=DAY_SQL)
def u3_rerun_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running the day job again replaces its days instead of adding rows."""
    path = scratch_path(spark, "day_stats")
    rows = _day_rows(spark, sf_dir)
    K.to_day_partitions(rows, path)
    K.to_day_partitions(rows, path)
    return spark.read.schema(DAY_SCHEMA).parquet(path)


BY_APP_SQL = "SELECT user_id % 7 AS app, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {view} GROUP BY user_id % 7"


@register("s6_run_stats", sql=BY_APP_SQL.format(view="events"))
def s6_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arbitrary SQL text run on the warehouse tables through the job template;
    the result is saved by the caller's ``save`` (here: kept as the DataFrame)."""
    view = "pushlake_events_by_app"
    saved = []
    out = S.run_stats(
        spark,
        mk_sql=lambda: BY_APP_SQL.format(view=view),
        prepare=lambda: fx.table(spark, sf_dir, "events").createOrReplaceTempView(view),
        save=saved.append,
    )
    return saved[0] if saved else out
