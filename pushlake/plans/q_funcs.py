"""Checked queries: scalar string functions (X1-X17) and coordinate conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.functions import geo as G
from pushlake.functions import text as X
from pushlake.plans import fixtures as fx
from pushlake.plans.fixture_sql import APPLIST_ROWS, HTTP_LINES, JOBS, POINTS, TIME_KEYS, USER_CELLS
from pushlake.plans.registry import register

JT = "regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def _jt(c: str) -> str:
    return JT.format(c=c)


def _ev(spark, sf_dir):
    return fx.table(spark, sf_dir, "events")


@register("x1_java_trim", sql=f"WITH {HTTP_LINES} SELECT event_id, {_jt('line')} AS trimmed FROM http_lines")
def x1_java_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Java trim of every HTTP line."""
    return fx.http_lines(spark, sf_dir).select("event_id", X.java_trim("line").alias("trimmed"))


@register("x2_java_split", sql=f"""
WITH {HTTP_LINES}, s AS (SELECT event_id, string_split(regexp_replace(line, '(\t)+$', ''), chr(9)) AS arr FROM http_lines)
SELECT event_id, CAST(len(arr) AS INTEGER) AS n, arr[1] AS first, arr[-1] AS last FROM s""")
def x2_java_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Java split of every HTTP line."""
    s = fx.http_lines(spark, sf_dir).select("event_id", X.java_split("line", "\t").alias("arr"))
    return s.select("event_id", F.size("arr").alias("n"), F.get("arr", 0).alias("first"), F.element_at("arr", -1).alias("last"))


@register("x3_reverse_key", sql="SELECT c_custkey, reverse(CAST(c_custkey AS VARCHAR)) AS rowkey FROM customer")
def x3_reverse_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reversed customer keys."""
    return fx.table(spark, sf_dir, "customer").select("c_custkey", X.reverse_key(F.col("c_custkey").cast("string")).alias("rowkey"))


@register("x4_md5_key", sql="SELECT event_id, md5(CAST(user_id AS VARCHAR)) AS rowkey FROM events")
def x4_md5_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5 keys of user ids."""
    return _ev(spark, sf_dir).select("event_id", X.md5_key("user_id").alias("rowkey"))


@register("x5_concat_key", sql="""
SELECT event_id, CAST(user_id AS VARCHAR) || 'app1' || CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS rowkey FROM events""")
def x5_concat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User + app + seconds composite keys."""
    from pushlake.functions.timekeys import secs_of_ntz

    return _ev(spark, sf_dir).select("event_id", X.concat_key("user_id", F.lit("app1"), secs_of_ntz("ts")).alias("rowkey"))


@register("x6_split_time_key", sql=f"""
WITH {TIME_KEYS}
SELECT o_orderkey, substr(key, 1, 4) AS year, substr(key, 5, 2) AS month,
       CASE WHEN length(key) >= 8 THEN substr(key, 7, 2) END AS day, substr(key, 1, 8) AS day_key
FROM time_keys""")
def x6_split_time_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, month, day of time keys."""
    tk = fx.time_key_rows(spark, sf_dir)
    return tk.select("o_orderkey", X.split_time_key("key").alias("p"), X.day_of_hour("key").alias("day_key")).select(
        "o_orderkey", "p.year", "p.month", "p.day", "day_key"
    )


@register("x7_qualifier_of", sql=f"""
WITH {USER_CELLS}
SELECT rowkey, ts, string_split(family || ':' || qualifier, ':')[2] AS qualifier FROM user_cells""")
def x7_qualifier_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualifier of family:qualifier names."""
    c = fx.user_cells(spark, sf_dir)
    return c.select("rowkey", "ts", X.qualifier_of(F.concat("family", F.lit(":"), "qualifier")).alias("qualifier"))


@register("x8_form_encode", sql="""
SELECT event_id, 'type=' || replace(url_encode(event_type), '%20', '+') || '&user=' || CAST(user_id AS VARCHAR)
       || '&v=' || replace(url_encode(CAST(value AS VARCHAR)), '%20', '+') || '&' AS form
FROM events""")
def x8_form_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form encoding of an event map."""
    m = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"),
        F.lit("type"), F.col("event_type"),
        F.lit("v"), F.col("value").cast("string"),
    )
    return _ev(spark, sf_dir).select("event_id", X.form_encode(m).alias("form"))


_X9_SRC = "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'x' || CAST(user_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END"


def _x9_src():
    e, u = F.col("event_id"), F.col("user_id").cast("string")
    return F.when(e % 11 == 0, F.lit(None).cast("string")).when(e % 7 == 0, F.concat(F.lit("x"), u)).otherwise(u)


@register("x9_int_or", sql=f"SELECT event_id, coalesce(TRY_CAST({_X9_SRC} AS INTEGER), 7) AS v FROM events")
def x9_int_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Int property values with a default."""
    return _ev(spark, sf_dir).select("event_id", X.int_or(_x9_src(), 7).alias("v"))


@register("x10_bool_or", sql="""
SELECT event_id, coalesce(lower(s) = 'true', true) AS v FROM (
  SELECT event_id, CASE event_type WHEN 'click' THEN 'TRUE' WHEN 'view' THEN 'true' WHEN 'error' THEN NULL ELSE event_type END AS s
  FROM events) t""")
def x10_bool_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean property values with a default."""
    t = F.col("event_type")
    s = F.when(t == "click", "TRUE").when(t == "view", "true").when(t == "error", F.lit(None)).otherwise(t)
    return _ev(spark, sf_dir).select("event_id", X.bool_or(s, True).alias("v"))


_X11_SRC = ("CAST(user_id AS VARCHAR) || ',' || CAST(event_id AS VARCHAR) || CASE WHEN event_id % 9 = 0 THEN ',z' ELSE '' END"
            " || CASE WHEN event_id % 5 = 0 THEN ',' ELSE '' END")


@register("x11_int_array_or", sql=f"""
SELECT event_id, CASE WHEN list_bool_or(list_transform(parts, lambda x: TRY_CAST(x AS INTEGER) IS NULL)) THEN '7'
                      ELSE array_to_string(list_transform(parts, lambda x: CAST(TRY_CAST(x AS INTEGER) AS VARCHAR)), ',') END AS v
FROM (SELECT event_id, string_split(regexp_replace({_X11_SRC}, '(,)+$', ''), ',') AS parts FROM events) t""")
def x11_int_array_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11: CSV int arrays; one bad element gives the default."""
    e = F.col("event_id")
    s = F.concat(
        F.col("user_id").cast("string"), F.lit(","), e.cast("string"),
        F.when(e % 9 == 0, F.lit(",z")).otherwise(F.lit("")),
        F.when(e % 5 == 0, F.lit(",")).otherwise(F.lit("")),
    )
    return _ev(spark, sf_dir).select("event_id", F.array_join(X.int_array_or(s, [7]), ",").alias("v"))


_X12_SRC = "event_type || ',' || upper(event_type) || ',true,TRUE,' || CAST(user_id AS VARCHAR)"


@register("x12_csv_arrays", sql=f"""
SELECT event_id,
  array_to_string(list_transform(parts, lambda x: CASE WHEN lower(x) = 'true' THEN 'true' ELSE 'false' END), ',') AS bools,
  array_to_string(parts, '|') AS strings
FROM (SELECT event_id, string_split(regexp_replace({_X12_SRC}, '(,)+$', ''), ',') AS parts FROM events) t""")
def x12_csv_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV boolean and string arrays."""
    s = F.concat(F.col("event_type"), F.lit(","), F.upper("event_type"), F.lit(",true,TRUE,"), F.col("user_id").cast("string"))
    return _ev(spark, sf_dir).select(
        "event_id",
        F.array_join(F.transform(X.bool_array(s), lambda b: b.cast("string")), ",").alias("bools"),
        F.array_join(X.string_array(s), "|").alias("strings"),
    )


_X13_SRC = ("event_type || ':' || CAST(user_id AS VARCHAR) || ',x,k:' || CAST(event_id % 5 AS VARCHAR) || ':z,'"
            " || event_type || ':' || CAST(event_id AS VARCHAR) || ',a:'")


@register("x13_kv_map", sql=f"""
WITH src AS (SELECT event_id, string_split(regexp_replace({_X13_SRC}, '(,)+$', ''), ',') AS parts FROM events),
p AS (SELECT event_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM src),
kv AS (SELECT event_id, i, string_split(regexp_replace(part, '(:)+$', ''), ':') AS a FROM p),
ok AS (SELECT event_id, i, a[1] AS k, a[2] AS v FROM kv WHERE len(a) > 1),
last AS (SELECT event_id, k, v FROM (SELECT *, row_number() OVER (PARTITION BY event_id, k ORDER BY i DESC) AS rn FROM ok) t WHERE rn = 1)
SELECT event_id, string_agg(k || '=' || v, ';' ORDER BY k) AS m FROM last GROUP BY event_id""")
def x13_kv_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K:v maps with the last duplicate winning."""
    e, t = F.col("event_id"), F.col("event_type")
    s = F.concat(
        t, F.lit(":"), F.col("user_id").cast("string"), F.lit(",x,k:"), (e % 5).cast("string"), F.lit(":z,"),
        t, F.lit(":"), e.cast("string"), F.lit(",a:"),
    )
    m = X.kv_map(s)
    return _ev(spark, sf_dir).select(
        "event_id", F.array_join(F.transform(F.map_entries(m), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ";").alias("m")
    )


@register("x14_truncate", sql="SELECT event_id, substr(props || event_type, 1, 12) AS short FROM events")
def x14_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cut to 12 characters."""
    return _ev(spark, sf_dir).select("event_id", X.truncate(F.concat("props", "event_type"), 12).alias("short"))


@register("x15_name_tokens", sql=f"""
WITH {JOBS}
SELECT name, string_split(name, ' ')[1] || '_' || string_split(name, ' ')[3] AS seg FROM jobs""")
def x15_name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job name tokens 0 and 2 joined."""
    return fx.jobs(spark, sf_dir).select("name", X.name_tokens_0_2("name").alias("seg"))


@register("x16_json_text", sql="SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def x16_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON member as text."""
    return _ev(spark, sf_dir).select("event_id", X.json_text("props", "k").alias("k"))


@register("x17_to_json_list", sql=f"""
WITH {APPLIST_ROWS}
SELECT imei, itime, '[{{' || CASE WHEN name IS NULL THEN '' ELSE '"name":' || to_json(name) || ',' END || '"pkg":' || to_json(pkg) || '}}]' AS js
FROM applist_rows""")
def x17_to_json_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-element app lists as JSON (null fields omitted)."""
    a = fx.applist_rows(spark, sf_dir)
    return a.select("imei", "itime", X.to_json_list(F.array(F.struct("name", "pkg"))).alias("js"))


# ---- G1-G7 -----------------------------------------------------------------------------------

# The conversion written again in SQL for the oracle (constants as in geo.py).
_PI = "3.1415926535897932384626"
_XPI = "(3.14159265358979324 * 3000.0 / 180.0)"
_A = "6378245.0"
_EE = "0.00669342162296594323"


def _tlat(x: str, y: str) -> str:
    x, y = f"({x})", f"({y})"
    return (f"(-100.0 + 2.0 * {x} + 3.0 * {y} + 0.2 * {y} * {y} + 0.1 * {x} * {y} + 0.2 * sqrt(abs({x}))"
            f" + (20.0 * sin(6.0 * {x} * {_PI}) + 20.0 * sin(2.0 * {x} * {_PI})) * 2.0 / 3.0"
            f" + (20.0 * sin({y} * {_PI}) + 40.0 * sin({y} / 3.0 * {_PI})) * 2.0 / 3.0"
            f" + (160.0 * sin({y} / 12.0 * {_PI}) + 320 * sin({y} * {_PI} / 30.0)) * 2.0 / 3.0)")


def _tlng(x: str, y: str) -> str:
    x, y = f"({x})", f"({y})"
    return (f"(300.0 + {x} + 2.0 * {y} + 0.1 * {x} * {x} + 0.1 * {x} * {y} + 0.1 * sqrt(abs({x}))"
            f" + (20.0 * sin(6.0 * {x} * {_PI}) + 20.0 * sin(2.0 * {x} * {_PI})) * 2.0 / 3.0"
            f" + (20.0 * sin({x} * {_PI}) + 40.0 * sin({x} / 3.0 * {_PI})) * 2.0 / 3.0"
            f" + (150.0 * sin({x} / 12.0 * {_PI}) + 300.0 * sin({x} / 30.0 * {_PI})) * 2.0 / 3.0)")


def _out(lng: str, lat: str) -> str:
    return f"({lng} < 72.004 OR {lng} > 137.8347 OR {lat} < 0.8293 OR {lat} > 55.8271)"


def _shift_sql(src: str) -> str:
    """Subquery adding dlng, dlat of (lng, lat) of ``src``."""
    return f"""(SELECT *, ({_tlat('lng - 105.0', 'lat - 35.0')} * 180.0) / (({_A} * (1 - {_EE})) / (magic * sqrt(magic)) * {_PI}) AS dlat,
                      ({_tlng('lng - 105.0', 'lat - 35.0')} * 180.0) / ({_A} / sqrt(magic) * cos(lat / 180.0 * {_PI}) * {_PI}) AS dlng
               FROM (SELECT *, 1 - {_EE} * sin(lat / 180.0 * {_PI}) * sin(lat / 180.0 * {_PI}) AS magic FROM {src}) m)"""


def _wgs_to_gcj(src: str) -> str:
    return f"""(SELECT id, CASE WHEN {_out('lng', 'lat')} THEN lng ELSE lng + dlng END AS lng,
                      CASE WHEN {_out('lng', 'lat')} THEN lat ELSE lat + dlat END AS lat FROM {_shift_sql(src)} s)"""


def _gcj_to_wgs(src: str) -> str:
    return f"""(SELECT id, CASE WHEN {_out('lng', 'lat')} THEN lng ELSE lng * 2 - (lng + dlng) END AS lng,
                      CASE WHEN {_out('lng', 'lat')} THEN lat ELSE lat * 2 - (lat + dlat) END AS lat FROM {_shift_sql(src)} s)"""


def _gcj_to_bd(src: str) -> str:
    return f"""(SELECT id, z * cos(theta) + 0.0065 AS lng, z * sin(theta) + 0.006 AS lat FROM (
               SELECT id, sqrt(lng * lng + lat * lat) + 0.00002 * sin(lat * {_XPI}) AS z,
                      atan2(lat, lng) + 0.000003 * cos(lng * {_XPI}) AS theta FROM {src}) q)"""


def _bd_to_gcj(src: str) -> str:
    return f"""(SELECT id, z * cos(theta) AS lng, z * sin(theta) AS lat FROM (
               SELECT id, sqrt(x * x + y * y) - 0.00002 * sin(y * {_XPI}) AS z, atan2(y, x) - 0.000003 * cos(x * {_XPI}) AS theta
               FROM (SELECT id, lng - 0.0065 AS x, lat - 0.006 AS y FROM {src}) r) q)"""


def _geo_sql(expr: str) -> str:
    return f"WITH {POINTS} SELECT id, round(lng, 6) AS lng, round(lat, 6) AS lat FROM {expr} g"


def _geo_query(name: str, fn, sql: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = fx.points(spark, sf_dir)
        r = p.select("id", fn(F.col("lng"), F.col("lat")).alias("p"))
        return r.select("id", F.round("p.lng", 6).alias("lng"), F.round("p.lat", 6).alias("lat"))

    register(name, sql=sql)(build)


_geo_query("g1_bd09_to_gcj02", G.bd09_to_gcj02, _geo_sql(_bd_to_gcj("points")))
_geo_query("g2_gcj02_to_bd09", G.gcj02_to_bd09, _geo_sql(_gcj_to_bd("points")))
_geo_query("g3_wgs84_to_gcj02", G.wgs84_to_gcj02, _geo_sql(_wgs_to_gcj("points")))
_geo_query("g4_gcj02_to_wgs84", G.gcj02_to_wgs84, _geo_sql(_gcj_to_wgs("points")))
_geo_query("g5_bd09_to_wgs84", G.bd09_to_wgs84, _geo_sql(_gcj_to_wgs(_bd_to_gcj("points"))))
_geo_query("g5_wgs84_to_bd09", G.wgs84_to_bd09, _geo_sql(_gcj_to_bd(_wgs_to_gcj("points"))))


@register("g6_offset_series", sql=f"""
WITH {POINTS}
SELECT id, round({_tlat('lng - 105.0', 'lat - 35.0')}, 6) AS dlat, round({_tlng('lng - 105.0', 'lat - 35.0')}, 6) AS dlng FROM points""")
def g6_offset_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latitude and longitude offset series."""
    p = fx.points(spark, sf_dir)
    x, y = F.col("lng") - 105.0, F.col("lat") - 35.0
    return p.select("id", F.round(G.transform_lat(x, y), 6).alias("dlat"), F.round(G.transform_lng(x, y), 6).alias("dlng"))


@register("g7_out_of_china", sql=f"WITH {POINTS} SELECT id, {_out('lng', 'lat')} AS outside FROM points")
def g7_out_of_china(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points outside the box."""
    return fx.points(spark, sf_dir).select("id", G.out_of_china("lng", "lat").alias("outside"))
