"""Checked queries: run-length grouping, last-write-wins, upserts, paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.operators import ordered as O
from pushlake.operators import parse as P
from pushlake.operators import rollup as R
from pushlake.operators.cells import CELL_COLUMNS
from pushlake.operators.merge import merge_docs
from pushlake.plans import fixtures as fx
from pushlake.plans.fixture_sql import DOCS, JOBS, PAIR_LINES, STAR, USER_CELLS
from pushlake.plans.q_cells import parsed_apkver
from pushlake.plans.q_parse import PAIRS_SQL, PARSED_APKVER, PARSED_SDKVER
from pushlake.plans.registry import register
from pushlake.sources import readers as S
from pushlake.session import scratch_path
from pushlake.sources.sinks import index_docs, sorted_cells, to_index_docs

NUMBERED_SQL = f"""
{PAIR_LINES}, {PAIRS_SQL},
numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) - row_number() OVER (PARTITION BY imei ORDER BY event_id) AS grp FROM pairs)"""

RUNS_SQL = f"""{NUMBERED_SQL},
runs AS (SELECT imei, min(event_id) AS run_start, string_agg(pkg, '|' ORDER BY event_id) AS pkg, count(*) AS n FROM numbered GROUP BY imei, grp)"""


def pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = P.accepted(P.parse_pairs(fx.pair_lines(spark, sf_dir), keep=["event_id"]))
    runs = O.group_runs(pairs, "imei", "pkg", ["event_id"])
    return runs.select("imei", F.col("run_start.event_id").alias("run_start"), "pkg", "n")


@register("w1_group_runs", sql=f"WITH {RUNS_SQL} SELECT * FROM runs")
def w1_group_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 over pair lines in event order (range-partition segments of the order key)."""
    return pair_runs(spark, sf_dir)


@register("w1_group_runs_text", sql=f"WITH {RUNS_SQL} SELECT imei, pkg, n FROM runs")
def w1_group_runs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P9 + W1: the pair lines written as text files, read back line by line;
    the order is (file, block, position) and each input split is a segment."""
    path = scratch_path(spark, "pair_lines")
    fx.pair_lines(spark, sf_dir).repartitionByRange(4, "event_id").sortWithinPartitions("event_id").select("line").write.text(path)
    lines = S.read_lines(spark, path)
    pairs = P.accepted(P.parse_pairs(lines, keep=["_file", "_block", "_pos"]))
    runs = O.group_runs(pairs, "imei", "pkg", ["_file", "_block", "_pos"], segment=["_file", "_block"])
    return runs.select("imei", "pkg", "n")


LAST_RUN_SQL = "last AS (SELECT imei, arg_max(pkg, run_start) AS pkg FROM runs GROUP BY imei)"


@register("w2_last_run", sql=f"WITH {RUNS_SQL}, {LAST_RUN_SQL} SELECT * FROM last")
def w2_last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run of each imei wins."""
    return O.last_run(pair_runs(spark, sf_dir), "imei", "pkg")


# The index job's document time (its ``itime`` argument).
INDEX_ITIME = 1704038400


@register("k7_index_docs", sql=f"WITH {RUNS_SQL}, {LAST_RUN_SQL} SELECT imei AS id, pkg, CAST({INDEX_ITIME} AS BIGINT) AS itime FROM last")
def k7_index_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: index documents of the last runs."""
    return index_docs(O.last_run(pair_runs(spark, sf_dir), "imei", "pkg"), "imei", "pkg", INDEX_ITIME)


def _refusing_index(docs: list[dict]) -> list[tuple[str, str]]:
    """A stand-in for an index that refuses documents by their id."""
    return [(d["id"], "mapping") for d in docs if len(d["id"]) % 2 == 0]


@register("k7_failures", sql=f"""
WITH {RUNS_SQL}, {LAST_RUN_SQL} SELECT imei AS id, 'mapping' AS reason FROM last WHERE length(imei) % 2 = 0""")
def k7_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the documents sent in bulk to a sender that refuses some; the table of failures."""
    path = scratch_path(spark, "k7_failures")
    to_index_docs(O.last_run(pair_runs(spark, sf_dir), "imei", "pkg"), "imei", "pkg", INDEX_ITIME, _refusing_index, failures=path)
    return spark.read.parquet(path)


@register("w3_last_write_wins", sql=f"""
WITH {PARSED_APKVER}
SELECT uid, appkey, apkver FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY event_id DESC) AS rn FROM parsed_apkver) t WHERE rn = 1""")
def w3_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last version line per uid wins."""
    return O.last_write_wins(parsed_apkver(spark, sf_dir), "uid", "event_id", ["appkey", "apkver"])


def _merge_sql(parsed: str, f1: str, f2: str) -> str:
    cols = {"appkey", "apkver", "sdkver", "channel"}
    other = sorted(cols - {f1, f2})
    return f"""
WITH {DOCS}, {parsed},
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY event_id DESC) AS rn FROM parsed_{f2}) t WHERE rn = 1)
SELECT coalesce(d.uid, u.uid) AS uid,
       CASE WHEN u.uid IS NOT NULL THEN u.{f1} ELSE d.{f1} END AS {f1},
       CASE WHEN u.uid IS NOT NULL THEN u.{f2} ELSE d.{f2} END AS {f2},
       d.{other[0]} AS {other[0]}, d.{other[1]} AS {other[1]}
FROM docs d FULL OUTER JOIN u ON d.uid = u.uid"""


@register("u1_merge_docs", sql=_merge_sql(PARSED_APKVER, "appkey", "apkver"))
def u1_merge_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apkver lines merged into documents (null overwrites; unmatched inserted)."""
    return merge_docs(fx.docs(spark, sf_dir), parsed_apkver(spark, sf_dir), "uid", ["appkey", "apkver"], "event_id")


@register("u1_merge_docs_sdkver", sql=_merge_sql(PARSED_SDKVER, "channel", "sdkver"))
def u1_merge_docs_sdkver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sdkver lines merged into documents."""
    ups = P.accepted(P.parse_versions(fx.version_lines(spark, sf_dir), "sdkver", keep=["event_id"])).drop("line")
    return merge_docs(fx.docs(spark, sf_dir), ups, "uid", ["channel", "sdkver"], "event_id")


@register("w5_sorted_cells", sql=f"WITH {USER_CELLS} SELECT * FROM user_cells")
def w5_sorted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 / K8 order: range-partitioned by rowkey, sorted inside each part."""
    return sorted_cells(fx.user_cells(spark, sf_dir), 4).select(*CELL_COLUMNS)


@register("w6_page", sql=f"""
WITH {STAR}
SELECT r_name, o_orderstatus, CAST(sum(price) AS DOUBLE) AS price FROM star GROUP BY r_name, o_orderstatus
ORDER BY r_name, o_orderstatus LIMIT 10 OFFSET 3""")
def w6_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered groups, offset 3, limit 10."""
    g = fx.star(spark, sf_dir).groupBy("r_name", "o_orderstatus").agg(F.sum("price").cast("double").alias("price"))
    return R.page(g, ["r_name", "o_orderstatus"], limit=10, offset=3)


@register("w6_deep_page", sql="""
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber
LIMIT 500 OFFSET (SELECT CAST(count(*) * 3 // 4 AS BIGINT) FROM lineitem)""")
def w6_deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page deep in the lineitems by ship date; only its range partitions are read."""
    items = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return R.page(items, ["l_shipdate", "l_orderkey", "l_linenumber"], limit=500, offset=items.count() * 3 // 4)


@register("w6_tail", sql="""
SELECT event_id, user_id FROM events ORDER BY event_id DESC OFFSET (SELECT CAST(count(*) // 2 AS BIGINT) FROM events)""")
def w6_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An offset without a limit: the older half of the events, newest first."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id")
    return R.page(ev, [F.desc("event_id")], offset=ev.count() // 2)


@register("w7_first_n_per_group", sql=f"""
WITH {JOBS}
SELECT cube, name, job_status, duration FROM (SELECT *, row_number() OVER (PARTITION BY cube ORDER BY name) AS rn FROM jobs) t WHERE rn <= 1000""")
def w7_first_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 1,000 jobs of each cube by name."""
    return R.first_n_per_group(fx.jobs(spark, sf_dir), ["cube"], "name", 1000)


@register("w7_second_page", sql=f"""
WITH {JOBS}
SELECT cube, name, job_status, duration FROM (SELECT *, row_number() OVER (PARTITION BY cube ORDER BY name) AS rn FROM jobs) t WHERE rn > 20 AND rn <= 40""")
def w7_second_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of 20 jobs of each cube by name."""
    return R.group_page(fx.jobs(spark, sf_dir), ["cube"], "name", 20, 2)


@register("k5_replace_into", sql=f"""
WITH {DOCS}, {PARSED_APKVER},
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY event_id DESC) AS rn FROM parsed_apkver) t WHERE rn = 1)
SELECT uid, appkey, apkver, sdkver, channel FROM docs WHERE uid NOT IN (SELECT uid FROM u)
UNION ALL SELECT uid, appkey, apkver, NULL AS sdkver, NULL AS channel FROM u""")
def k5_replace_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 replace-into semantics on DataFrames: rows replace same-key table rows whole
    (the JDBC writer then overwrites the table; no database is started here)."""
    from pushlake.operators.merge import replace_into

    latest = O.last_write_wins(parsed_apkver(spark, sf_dir), "uid", "event_id", ["appkey", "apkver"])
    return replace_into(fx.docs(spark, sf_dir), latest, ["uid"]).select("uid", "appkey", "apkver", "sdkver", "channel")


@register("w1_group_runs_pieces", sql=f"""
WITH {NUMBERED_SQL},
starts AS (SELECT imei, grp, min(event_id) AS run_start FROM numbered GROUP BY imei, grp)
SELECT n.imei, s.run_start, n.pkg FROM numbered n JOIN starts s ON n.imei = s.imei AND n.grp = s.grp""")
def w1_group_runs_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 returning each run as bounded pieces (one per segment it touches); the
    pieces' values, split again, are exactly the run's lines."""
    pairs = P.accepted(P.parse_pairs(fx.pair_lines(spark, sf_dir), keep=["event_id"]))
    runs = O.group_runs(pairs, "imei", "pkg", ["event_id"], pieces=True)
    items = runs.select("imei", F.col("run_start.event_id").alias("run_start"), F.explode(F.split("pkg", "[|]")).alias("pkg"))
    return items
