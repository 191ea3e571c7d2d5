"""Checked queries: versioned cells and keyed lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.functions import text as X
from pushlake.functions.timekeys import ms_of_ntz
from pushlake.operators import cells as C
from pushlake.operators import parse as P
from pushlake.plans import fixtures as fx
from pushlake.plans.fixture_sql import (
    DOCS, MSG_KEY_LINES, OFFLINE_CELLS, REPORT_CELLS, STATS_CELLS, USER_CELLS,
)
from pushlake.plans.q_parse import PARSED_APKVER, _jt
from pushlake.plans.registry import register

PIVOT_SQL = """
l AS (SELECT rowkey, qualifier, arg_max(value, ts) AS v FROM user_cells
      WHERE qualifier IN ('appkey', 'apkver', 'sdkver', 'channel') GROUP BY rowkey, qualifier),
pv AS (SELECT rowkey, max(CASE WHEN qualifier = 'appkey' THEN v END) AS appkey, max(CASE WHEN qualifier = 'apkver' THEN v END) AS apkver,
              max(CASE WHEN qualifier = 'sdkver' THEN v END) AS sdkver, max(CASE WHEN qualifier = 'channel' THEN v END) AS channel
       FROM l GROUP BY rowkey)"""


@register("p10_pivot_user", sql=f"WITH {USER_CELLS}, {PIVOT_SQL} SELECT * FROM pv")
def p10_pivot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: newest value of each user qualifier per row key."""
    return C.pivot_user(fx.user_cells(spark, sf_dir))


@register("j1_lookup_reversed", sql=f"""
WITH {USER_CELLS}, {PIVOT_SQL},
probe AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS uid FROM orders)
SELECT uid, appkey, apkver, sdkver, channel FROM probe JOIN pv ON reverse(uid) = pv.rowkey""")
def j1_lookup_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order customers looked up by reversed key; misses omitted."""
    keys = fx.table(spark, sf_dir, "orders")
    return C.lookup_reversed(keys, "o_custkey", fx.user_cells(spark, sf_dir))


def _lookup_sum_sql(qual_filter: str) -> str:
    return f"""
WITH {STATS_CELLS},
l AS (SELECT rowkey, qualifier, arg_max(CAST(value AS DOUBLE), ts) AS v FROM stats_cells WHERE family = 'A' {qual_filter} GROUP BY rowkey, qualifier),
s AS (SELECT rowkey, sum(v) AS total FROM l GROUP BY rowkey),
k AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS key FROM customer)
SELECT key, round(coalesce(total, 0.0), 6) AS total FROM k LEFT JOIN s ON md5(key) = s.rowkey"""


@register("j2_lookup_sum", sql=_lookup_sum_sql("AND qualifier = 'purchase'"))
def j2_lookup_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + J5: newest purchase value per customer key via md5 row keys; 0.0 for misses."""
    keys = fx.table(spark, sf_dir, "customer")
    out = C.lookup_sum(keys, "c_custkey", fx.stats_cells(spark, sf_dir), "A", "purchase")
    return out.select("key", F.round("total", 6).alias("total"))


@register("a3_sum_cells", sql=_lookup_sum_sql(""))
def a3_sum_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: per customer key, the sum of the newest value of every qualifier of the family."""
    keys = fx.table(spark, sf_dir, "customer")
    out = C.lookup_sum(keys, "c_custkey", fx.stats_cells(spark, sf_dir), "A", None)
    return out.select("key", F.round("total", 6).alias("total"))


@register("j5_fill_missing", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS key, coalesce(n, 0) AS n
FROM customer LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY user_id) e ON CAST(c_custkey AS VARCHAR) = e.k""")
def j5_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with its event count, 0 when it has none."""
    keys = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    counts = fx.table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return C.fill_missing(keys, counts, "key", "n", 0)


@register("j3_lookup_docs", sql=f"""
WITH {DOCS}
SELECT k.uid, d.appkey, d.apkver, d.sdkver, d.channel
FROM (SELECT CAST(o_custkey AS VARCHAR) AS uid FROM orders) k JOIN docs d ON k.uid = d.uid""")
def j3_lookup_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document of every order's customer; misses omitted, duplicates kept."""
    return C.lookup_docs(fx.table(spark, sf_dir, "orders"), "o_custkey", fx.docs(spark, sf_dir))


def parsed_apkver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.accepted(P.parse_versions(fx.version_lines(spark, sf_dir), "apkver", keep=["event_id"])).drop("line")


@register("j6_exists_split", sql=f"""
WITH {DOCS}, {PARSED_APKVER}
SELECT event_id, uid, uid IN (SELECT uid FROM docs) AS matched FROM parsed_apkver""")
def j6_exists_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version line marked by whether its uid has a document."""
    ups = parsed_apkver(spark, sf_dir).select("event_id", "uid")
    hit, miss = C.exists_split(ups, fx.docs(spark, sf_dir), "uid")
    return hit.withColumn("matched", F.lit(True)).unionByName(miss.withColumn("matched", F.lit(False)))


@register("j4_send_time_value", sql=f"""
WITH {MSG_KEY_LINES}, {REPORT_CELLS}, {OFFLINE_CELLS},
lines AS (SELECT {_jt('line')} AS msgid FROM msg_key_lines),
sent AS (SELECT rowkey AS msgid, max(ts) // 1000 AS ts FROM report_cells WHERE family = 'A' AND qualifier = 'app1' GROUP BY rowkey),
vals AS (SELECT rowkey, sum(CAST(value AS INTEGER)) AS total FROM (
           SELECT *, row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC) AS rn
           FROM offline_cells WHERE family = 'A' AND qualifier = 'clicks') t WHERE rn <= 10000 GROUP BY rowkey)
SELECT l.msgid, s.ts, CAST(coalesce(v.total, 0) AS BIGINT) AS value
FROM lines l JOIN sent s ON l.msgid = s.msgid LEFT JOIN vals v ON v.rowkey = s.msgid || 'app1' || CAST(s.ts AS VARCHAR)
WHERE s.ts > 0""")
def j4_send_time_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key-file line, the newest send time and the newest-10,000 version sum."""
    return C.send_time_value(
        fx.msg_key_lines(spark, sf_dir), "line", fx.report_cells(spark, sf_dir), fx.offline_cells(spark, sf_dir), "app1", "clicks"
    )


@register("a4_latest_ts", sql=f"""
WITH {REPORT_CELLS}
SELECT rowkey, qualifier, max(ts) // 1000 AS ts_s FROM report_cells WHERE family = 'A' AND qualifier = 'app1' GROUP BY rowkey, qualifier""")
def a4_latest_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: newest report time per message, in seconds."""
    return C.latest_ts(fx.report_cells(spark, sf_dir), "A", "app1")


@register("f6_send_time_positive", sql=f"""
WITH {REPORT_CELLS}
SELECT rowkey, max(ts) // 1000 AS ts_s FROM report_cells GROUP BY rowkey HAVING max(ts) // 1000 > 0""")
def f6_send_time_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """newest send times kept only when positive."""
    return C.latest_ts(fx.report_cells(spark, sf_dir)).filter(F.col("ts_s") > 0).select("rowkey", "ts_s")


@register("a5_sum_versions", sql=f"""
WITH {OFFLINE_CELLS}
SELECT rowkey, family, qualifier, CAST(sum(CAST(value AS INTEGER)) AS BIGINT) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC) AS rn FROM offline_cells) t
WHERE rn <= 10000 GROUP BY rowkey, family, qualifier""")
def a5_sum_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: per offline cell, the sum of the newest 10,000 int versions."""
    return C.sum_versions(fx.offline_cells(spark, sf_dir))


@register("a5_heavy_cells", sql="""
SELECT l_returnflag AS rowkey, 'A' AS family, 'qty' AS qualifier, CAST(sum(qty) AS BIGINT) AS total FROM (
  SELECT l_returnflag, CAST(l_quantity AS INTEGER) AS qty, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey * 8 + l_linenumber DESC) AS rn FROM lineitem) t
WHERE rn <= 10000 GROUP BY l_returnflag""")
def a5_heavy_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 on three cells with a version per lineitem (over 10,000 each from sf0.01 on), so
    that only the newest 10,000 count and the salted levels rank them."""
    items = fx.table(spark, sf_dir, "lineitem")
    cells = items.select(
        F.col("l_returnflag").alias("rowkey"), F.lit("A").alias("family"), F.lit("qty").alias("qualifier"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ts"), F.col("l_quantity").cast("int").cast("string").alias("value"),
    )
    return C.sum_versions(cells)


@register("w4_newest_versions", sql=f"""
WITH {REPORT_CELLS}
SELECT rowkey, family, qualifier, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC) AS rn FROM report_cells) t WHERE rn <= 1""")
def w4_newest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of every report cell."""
    return C.newest_versions(fx.report_cells(spark, sf_dir), 1)


@register("u2_compact_cells", sql=f"""
WITH {USER_CELLS}
SELECT rowkey, family, qualifier, ts, arg_max(value, w) AS value FROM (
  SELECT *, 0 AS w FROM user_cells
  UNION ALL SELECT rowkey, family, qualifier, ts, 'w' || value, 1 FROM user_cells WHERE qualifier = 'apkver') t
GROUP BY rowkey, family, qualifier, ts""")
def u2_compact_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write of the same full cell key replaces the first."""
    c = fx.user_cells(spark, sf_dir)
    rewrite = c.filter(F.col("qualifier") == "apkver").withColumn("value", F.concat(F.lit("w"), "value"))
    return C.compact_cells(c.withColumn("w", F.lit(0)).unionByName(rewrite.withColumn("w", F.lit(1))), write_order="w")


@register("k6_to_cells", sql=f"WITH {STATS_CELLS} SELECT * FROM stats_cells")
def k6_to_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: events projected to md5-keyed cells with per-row times."""
    ev = fx.table(spark, sf_dir, "events")
    return C.to_cells(ev, F.col("user_id"), "A", F.col("event_type"), F.col("value"), ms_of_ntz("ts"), key_fn=X.md5_key)
