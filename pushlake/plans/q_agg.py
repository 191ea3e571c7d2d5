"""Checked queries: aggregations (A1, A2, A6-A10) and cube operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pushlake.operators import cube as CB
from pushlake.operators import parse as P
from pushlake.operators import rollup as R
from pushlake.plans import fixtures as fx
from pushlake.plans.fixture_sql import APPLIST_ROWS, HTTP_LINES, HTTP_RECORDS, STAR
from pushlake.plans.registry import register
from pushlake.session import scratch_path

APPLIST_SQL = f"""
WITH {APPLIST_ROWS},
r AS (SELECT * FROM applist_rows WHERE imei IS NOT NULL AND pkg IS NOT NULL AND name IS NOT NULL AND itime IS NOT NULL AND length(imei) > 0)
SELECT imei, CAST(max(CASE WHEN length(CAST(itime AS VARCHAR)) = 10 AND itime > 0 THEN itime END) * 1000 AS BIGINT) AS itime_ms,
       '[' || string_agg('{{"name":' || to_json(name) || ',"pkg":' || to_json(pkg) || '}}', ',' ORDER BY name, pkg) || ']' AS applist
FROM r GROUP BY imei"""


@register("a1_applist_by_imei", sql=APPLIST_SQL)
def a1_applist_by_imei(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2: app rows (null fields dropped, as the ORC reader does) grouped per imei into a sorted JSON list and a group time."""
    return R.applist_by_imei(fx.applist_rows(spark, sf_dir).dropna())


@register("a1_applist_by_imei_salted", sql=APPLIST_SQL)
def a1_applist_by_imei_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with the salted two-stage aggregation for hot imeis."""
    return R.applist_by_imei(fx.applist_rows(spark, sf_dir).dropna(), salt_buckets=4)


@register("a2_applist_time", sql=f"""
WITH {APPLIST_ROWS}
SELECT imei, CAST(max(CASE WHEN length(CAST(itime AS VARCHAR)) = 10 AND itime > 0 THEN itime END) * 1000 AS BIGINT) AS itime_ms
FROM applist_rows WHERE name IS NOT NULL AND length(imei) > 0 GROUP BY imei""")
def a2_applist_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the group time per imei: the largest positive 10-digit itime in ms, else null."""
    rows = fx.applist_rows(spark, sf_dir).dropna().filter(F.length("imei") > 0)
    return rows.groupBy("imei").agg(R.applist_time("itime").alias("itime_ms"))


@register("a6_row_count", sql=f"WITH {STAR} SELECT count(*) AS n FROM star")
def a6_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of the flat star table."""
    return R.row_count(fx.star(spark, sf_dir))


@register("a7_top_groups", sql=f"""
WITH {STAR}
SELECT r_name, o_year, CAST(sum(price) AS DOUBLE) AS sum_price FROM star GROUP BY r_name, o_year
ORDER BY sum(price) DESC, r_name, o_year LIMIT 10""")
def a7_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price sum by region and order year, the ten largest groups."""
    top = R.top_groups(fx.star(spark, sf_dir), ["r_name", "o_year"], "price", 10,
                       order=[F.col("sum_price").desc(), F.col("r_name"), F.col("o_year")])
    return top.withColumn("sum_price", F.col("sum_price").cast("double"))


@register("a8_count_rows", sql="SELECT count(*) AS n FROM events")
def a8_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global row count (0 on empty input, unlike sum(1))."""
    return R.row_count(fx.table(spark, sf_dir, "events"))


@register("a9_global_agg", sql="""
SELECT count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(event_id) AS first_id, max(event_id) AS last_id FROM events""")
def a9_global_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One global row of count, decimal sum and id range, with no grouping."""
    ev = fx.table(spark, sf_dir, "events")
    return R.global_agg(
        ev, F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
    )


@register("a10_observe_counts", sql=f"""
WITH {HTTP_LINES}, {HTTP_RECORDS}
SELECT appkey, msgid, itime, msg_type, receiver_type, errno, platform, imon, iday, ihour FROM http_records""")
def a10_observe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the parsed records with total / accepted / rejected counters attached as
    the ``Observation`` "http_api"; the action that runs this DataFrame fills them,
    with no extra pass over the lines."""
    parsed = P.parse_http_api(fx.http_lines(spark, sf_dir))
    obs = Observation("http_api")
    seen = R.observe_counts(parsed, obs)
    return P.accepted(seen).drop("line")


# ---- cube --------------------------------------------------------------------------------------

DIMS = ["r_name", "c_mktsegment", "o_orderstatus", "o_orderpriority"]
CUBE_DIMS_SQL = ", ".join(DIMS)


def measures():
    return {"price": F.sum("price")}


def _cube_out(df: DataFrame, dims=DIMS) -> DataFrame:
    return df.select(*dims, "gid", "n", F.col("price").cast("double").alias("price"))


@register("c1_flat_table", sql=f"WITH {STAR} SELECT r_name, c_mktsegment, o_orderstatus, o_orderpriority, c_nationkey, o_year, CAST(price AS DOUBLE) AS price FROM star")
def c1_flat_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star flat table (fact joined with four dimensions, projected)."""
    return fx.star(spark, sf_dir).withColumn("price", F.col("price").cast("double"))


@register("c2_redistribute", sql=f"WITH {STAR} SELECT r_name, c_mktsegment, o_orderstatus, o_orderpriority, CAST(price AS DOUBLE) AS price FROM star")
def c2_redistribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table spread round-robin over 8 partitions; same rows."""
    return CB.redistribute(fx.star(spark, sf_dir), 8).select(*DIMS, F.col("price").cast("double").alias("price"))


@register("c3_dim_values", sql=f"""
WITH {STAR}
SELECT DISTINCT 'r_name' AS dim, r_name AS value FROM star UNION SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM star
UNION SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM star UNION SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM star""")
def c3_dim_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct values of the four cube dimensions."""
    return CB.dim_values(fx.star(spark, sf_dir), DIMS)


@register("c4_encode_dim", sql=f"""
WITH {STAR}
SELECT c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS c_mktsegment_code FROM (SELECT DISTINCT c_mktsegment FROM star) t""")
def c4_encode_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: dense dictionary codes of the market segment."""
    return CB.encode_dim(fx.star(spark, sf_dir), "c_mktsegment", n_ranges=4).select("c_mktsegment", "c_mktsegment_code").distinct()


@register("c4_encode_rows", sql="""
SELECT event_id, user_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_code FROM events WHERE user_id IS NOT NULL
UNION ALL SELECT event_id, user_id, NULL FROM events WHERE user_id IS NULL""")
def c4_encode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: every event with the dense code of its user (a high-cardinality dimension)."""
    return CB.encode_dim(fx.table(spark, sf_dir, "events"), "user_id", out="user_code").select("event_id", "user_id", "user_code")


def _dims_text_sql(dims) -> str:
    n = len(dims)
    parts = ", ".join(f"CASE WHEN gid & {1 << (n - 1 - i)} = 0 THEN '{d}' END" for i, d in enumerate(dims))
    return f"concat_ws(',', {parts})"


@register("c5_cuboid_stats", sql=f"""
WITH {STAR},
g AS (SELECT GROUPING({CUBE_DIMS_SQL}) AS gid FROM star GROUP BY CUBE ({CUBE_DIMS_SQL}))
SELECT CAST(gid AS BIGINT) AS gid, {_dims_text_sql(DIMS)} AS dims, count(*) AS rows FROM g GROUP BY gid""")
def c5_cuboid_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per cuboid of the four-dimension cube."""
    return CB.cuboid_stats(fx.star(spark, sf_dir), DIMS)


@register("c6_base_cuboid", sql=f"""
WITH {STAR} SELECT {CUBE_DIMS_SQL}, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price FROM star GROUP BY {CUBE_DIMS_SQL}""")
def c6_base_cuboid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 + C8: the base cuboid with row count and exact price sum."""
    b = CB.base_cuboid(fx.star(spark, sf_dir), DIMS, measures())
    return b.select(*DIMS, "n", F.col("price").cast("double").alias("price"))


CUBE_SQL = f"""
WITH {STAR}
SELECT {CUBE_DIMS_SQL}, CAST(GROUPING({CUBE_DIMS_SQL}) AS BIGINT) AS gid, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price
FROM star GROUP BY CUBE ({CUBE_DIMS_SQL})"""


@register("c7_build_cube", sql=CUBE_SQL)
def c7_build_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 + C8: all 16 cuboids rolled up from the base cuboid."""
    return _cube_out(CB.build_cube(fx.star(spark, sf_dir), DIMS, measures()))


@register("c7_build_cube_by_layer", sql=CUBE_SQL)
def c7_build_cube_by_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 layer by layer (the path used for wide cubes), each layer checkpointed."""
    return _cube_out(CB.build_cube(fx.star(spark, sf_dir), DIMS, measures(), by_layer=True))


@register("c8_layer_sums", sql=f"""
WITH {STAR},
c AS (SELECT GROUPING({CUBE_DIMS_SQL}) AS gid, count(*) AS n, sum(price) AS price FROM star GROUP BY CUBE ({CUBE_DIMS_SQL}))
SELECT CAST(gid AS BIGINT) AS gid, CAST(sum(n) AS BIGINT) AS n, CAST(sum(price) AS DOUBLE) AS price FROM c GROUP BY gid""")
def c8_layer_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cuboid adds up to the base total (exact decimal sums)."""
    cube = CB.build_cube(fx.star(spark, sf_dir), DIMS, measures())
    return cube.groupBy("gid").agg(F.sum("n").alias("n"), F.sum("price").cast("double").alias("price"))


@register("c9_with_derived", sql=f"""
WITH {STAR}
SELECT o_orderstatus, n_name, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price
FROM star JOIN nation ON c_nationkey = n_nationkey GROUP BY o_orderstatus, n_name""")
def c9_with_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names derived after the roll-up and re-aggregated by status."""
    dims = ["c_nationkey", "o_orderstatus", "o_orderpriority"]
    cube = CB.build_cube(fx.star(spark, sf_dir), dims, measures())
    out = CB.with_derived(cube, dims, fx.table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", "n_name", ["o_orderstatus"], ["price"])
    return out.select("o_orderstatus", "n_name", "n", F.col("price").cast("double").alias("price"))


CARDINALITY_COLUMNS = [*DIMS, "c_nationkey", "o_year"]


@register("c10_cardinalities", sql=f"WITH {STAR} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, true AS within_bound FROM star" for c in CARDINALITY_COLUMNS))
def c10_cardinalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct counts per column beside the exact ones, and whether they
    are within the estimator's bound."""
    star = fx.star(spark, sf_dir)
    exact = star.agg(*[F.countDistinct(c).alias(c) for c in CARDINALITY_COLUMNS])
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in CARDINALITY_COLUMNS])).alias("_c")).select("_c.*")
    both = CB.cardinalities(star, CARDINALITY_COLUMNS).join(exact, "column")
    return both.select("column", "exact", CB.within_bound("approx", "exact").alias("within_bound"))


@register("c11_query_cube", sql=f"""
WITH {STAR}
SELECT r_name, o_orderstatus, CAST(sum(price) AS DOUBLE) AS price FROM star WHERE o_orderstatus = 'F' GROUP BY r_name, o_orderstatus""")
def c11_query_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11 + F10: price by region and status answered from its cuboid, status filtered."""
    cube = CB.build_cube(fx.star(spark, sf_dir), DIMS, measures())
    out = CB.query_cube(cube, DIMS, ["r_name", "o_orderstatus"], "price", where=F.col("o_orderstatus") == "F")
    return out.withColumn("price", F.col("price").cast("double"))


@register("c11_filter_outside", sql=f"""
WITH {STAR}
SELECT r_name, CAST(sum(price) AS DOUBLE) AS price, count(*) AS n FROM star
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND c_mktsegment <> 'BUILDING' GROUP BY r_name""")
def c11_filter_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: price by region under a filter on two dimensions that are not grouped: rolled
    up from the smallest cuboid that has all three."""
    cube = CB.build_cube(fx.star(spark, sf_dir), DIMS, measures())
    where = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("c_mktsegment") != "BUILDING")
    out = CB.query_cube(cube, DIMS, ["r_name"], ["price", "n"], where=where)
    return out.withColumn("price", F.col("price").cast("double"))


@register("c11_partial_cube", sql=f"""
WITH {STAR}
SELECT 'rolled up' AS source, r_name AS value, CAST(sum(price) AS DOUBLE) AS price FROM star GROUP BY r_name
UNION ALL SELECT 'filtered', o_orderstatus, CAST(sum(price) AS DOUBLE) FROM star WHERE r_name <> 'ASIA' GROUP BY o_orderstatus
UNION ALL SELECT 'base', c_mktsegment, CAST(sum(price) AS DOUBLE) FROM star WHERE o_orderpriority = '5-LOW' GROUP BY c_mktsegment""")
def c11_partial_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11 on a cube of two stored cuboids: one query rolled up, one filtered outside its
    group-by, and one that no stored cuboid covers, answered from the base table."""
    star = fx.star(spark, sf_dir)
    cube = CB.build_cube(star, DIMS, measures(), cuboids=[["r_name", "o_orderstatus"], ["o_orderstatus", "o_orderpriority"]])
    rows = CB.cuboid_rows(cube)
    asked = [
        ("rolled up", "r_name", None),
        ("filtered", "o_orderstatus", F.col("r_name") != "ASIA"),
        ("base", "c_mktsegment", F.col("o_orderpriority") == "5-LOW"),
    ]
    out = None
    for source, dim, where in asked:
        found = CB.query_cube(cube, DIMS, [dim], "price", where=where, base=star, fallback=True, rows=rows)
        found = found.select(F.lit(source).alias("source"), F.col(dim).alias("value"), F.col("price").cast("double").alias("price"))
        out = found if out is None else out.unionByName(found)
    return out


@register("f10_dim_filter", sql=f"""
WITH {STAR}
SELECT o_orderstatus, count(*) AS n FROM star WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderstatus""")
def f10_dim_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """equality filter on a dimension before an aggregate."""
    s = fx.star(spark, sf_dir).filter(F.col("c_mktsegment") == "BUILDING")
    return s.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


SEG_DIMS = ["r_name", "o_orderstatus"]


@register("c12_segments", sql=f"""
WITH {STAR},
c AS (SELECT o_year, r_name, o_orderstatus, CAST(GROUPING(r_name, o_orderstatus) AS BIGINT) AS gid, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price
      FROM star GROUP BY o_year, CUBE (r_name, o_orderstatus))
SELECT CAST(o_year AS VARCHAR) || '0101000000_' || CAST(o_year + 1 AS VARCHAR) || '0101000000' AS segment, r_name, o_orderstatus, gid, n, price
FROM c WHERE o_year < (SELECT max(o_year) FROM star)""")
def c12_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cube segment per order year, all built from one scan of the facts and
    written at once; then the last segment is dropped (a middle one may not be)."""
    star = fx.star(spark, sf_dir)
    path = scratch_path(spark, "cube_segments")
    # the range of years comes from the orders alone: two values
    lo, hi = fx.table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    years = [] if lo is None else [(f"{y}0101000000", f"{y + 1}0101000000") for y in range(lo, hi + 1)]
    time_key = F.concat(F.col("o_year").cast("string"), F.lit("0101000000"))
    CB.add_segments(star, path, time_key, years, SEG_DIMS, measures(), lambda cube: _cube_out(cube, ["segment", *SEG_DIMS]))
    stored = CB.list_segments(spark, path)
    CB.drop_segment(spark, path, *stored[-1].split("_"))
    return spark.read.parquet(path).select("segment", *SEG_DIMS, "gid", "n", "price")


@register("c12_merged_segments", sql=f"""
WITH {STAR},
c AS (SELECT o_year // 2 AS pair, r_name, o_orderstatus, CAST(GROUPING(r_name, o_orderstatus) AS BIGINT) AS gid, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price
      FROM star GROUP BY o_year // 2, CUBE (r_name, o_orderstatus))
SELECT CAST(2 * pair AS VARCHAR) || '0101000000_' || CAST(2 * pair + 2 AS VARCHAR) || '0101000000' AS segment, r_name, o_orderstatus, gid, n, price FROM c""")
def c12_merged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly segments merged by pairs of years; merged rows add up the old ones."""
    star = fx.star(spark, sf_dir)
    path = scratch_path(spark, "cube_segments")
    lo, hi = fx.table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    key = lambda y: f"{y}0101000000"
    time_key = F.concat(F.col("o_year").cast("string"), F.lit("0101000000"))
    years = [(key(y), key(y + 1)) for y in range(lo, hi + 1)]
    CB.add_segments(star, path, time_key, years, SEG_DIMS, measures())
    stored = {n[:4] for n in CB.list_segments(spark, path)}
    for y in range(lo - lo % 2, hi + 1, 2):
        if str(y) in stored and str(y + 1) in stored:
            CB.merge_segments(spark, path, key(y), key(y + 2), SEG_DIMS, ["price"])
    rows = spark.read.parquet(path)
    # a year without its partner stays a segment of its own; its pair is named by the range
    pair = F.floor(F.substring("segment", 1, 4).cast("int") / 2) * 2
    name = F.concat(pair.cast("string"), F.lit("0101000000_"), (pair + 2).cast("string"), F.lit("0101000000"))
    return rows.select(name.alias("segment"), *SEG_DIMS, "gid", "n", F.col("price").cast("double").alias("price"))


@register("c10_cube_distinct_nations", sql=f"""
WITH {STAR}
SELECT {CUBE_DIMS_SQL}, CAST(GROUPING({CUBE_DIMS_SQL}) AS BIGINT) AS gid, count(*) AS n, count(DISTINCT c_nationkey) AS nations
FROM star GROUP BY CUBE ({CUBE_DIMS_SQL})""")
def c10_cube_distinct_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 + C10: a cube with a mergeable distinct-count measure: HLL sketches of the
    nation key built in the base cuboid and unioned up every cuboid; read with
    ``hll_sketch_estimate`` (exact while a sketch holds few values, as here)."""
    cube = CB.build_cube(fx.star(spark, sf_dir), DIMS, {}, distinct={"nations": "c_nationkey"})
    return cube.select(*DIMS, "gid", "n", F.hll_sketch_estimate("nations").alias("nations"))


@register("a1_applist_parts", sql=f"""
WITH {APPLIST_ROWS},
r AS (SELECT * FROM applist_rows WHERE imei IS NOT NULL AND pkg IS NOT NULL AND name IS NOT NULL AND itime IS NOT NULL AND length(imei) > 0),
t AS (SELECT imei, CAST(max(CASE WHEN length(CAST(itime AS VARCHAR)) = 10 AND itime > 0 THEN itime END) * 1000 AS BIGINT) AS itime_ms FROM r GROUP BY imei)
SELECT r.imei, t.itime_ms, r.name, r.pkg FROM r JOIN t ON r.imei = t.imei""")
def a1_applist_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with bounded parts (at most about 16 apps per value): exploding the parts
    gives back every app row of every imei, with the imei's group time."""
    parts = R.applist_by_imei(fx.applist_rows(spark, sf_dir).dropna(), max_items=16)
    items = parts.select("imei", "itime_ms", F.explode(F.from_json("applist", "array<struct<name:string,pkg:string>>")).alias("a"))
    return items.select("imei", "itime_ms", "a.name", "a.pkg")
