"""Checked queries: parsing, time keys and hour/day stats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.operators import parse as P
from pushlake.operators import rollup as R
from pushlake.plans import fixtures as fx
from pushlake.plans.fixture_sql import HTTP_LINES, HTTP_RECORDS, jsplit, jtrim
from pushlake.plans.registry import register


def http_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.accepted(P.parse_http_api(fx.http_lines(spark, sf_dir), keep=["event_id"]))


@register("p1_parse_http_api", sql=f"""
WITH {HTTP_LINES}, {HTTP_RECORDS}
SELECT event_id, appkey, msgid, itime, msg_type, receiver_type, errno, platform, imon, iday, ihour
FROM http_records""")
def p1_parse_http_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + T1: accepted HTTP-API records with their time keys."""
    return http_records(spark, sf_dir).drop("line")


@register("p11_rejects_http_api", sql=f"""
WITH {HTTP_LINES},
s AS (SELECT line, {jsplit(jtrim('line'), chr(9))} AS arr FROM http_lines)
SELECT line, CASE WHEN len(arr) < 7 THEN 'fields'
                  WHEN TRY_CAST(arr[2] AS BIGINT) IS NULL THEN 'msgid'
                  WHEN TRY_CAST(arr[3] AS BIGINT) IS NULL THEN 'itime' END AS reason
FROM s
WHERE len(arr) < 7 OR TRY_CAST(arr[2] AS BIGINT) IS NULL OR TRY_CAST(arr[3] AS BIGINT) IS NULL""")
def p11_rejects_http_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected HTTP lines with the first rule they broke."""
    return P.rejects(P.parse_http_api(fx.http_lines(spark, sf_dir)))


def hour_stats_of(records: DataFrame) -> DataFrame:
    return R.hour_day_counts(records, "iday", "ihour", "n_msgs", {"n_appkeys": "appkey", "n_msgids": "msgid"})


HOUR_STATS_SQL = f"""
WITH {HTTP_LINES}, {HTTP_RECORDS}
SELECT iday, ihour, CASE WHEN GROUPING(ihour) = 1 THEN 'day' ELSE 'hour' END AS grain,
       COUNT(*) AS n_msgs, COUNT(DISTINCT appkey) AS n_appkeys, COUNT(DISTINCT msgid) AS n_msgids
FROM http_records
GROUP BY GROUPING SETS ((iday, ihour), (iday))"""


@register("a11_grouping_sets", sql=HOUR_STATS_SQL)
def a11_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 for any aggregates: GROUPING SETS over hour and day."""
    aggs = [F.count(F.lit(1)).alias("n_msgs"), F.countDistinct("appkey").alias("n_appkeys"), F.countDistinct("msgid").alias("n_msgids")]
    return R.hour_day_stats(http_records(spark, sf_dir), "iday", "ihour", aggs)


@register("a11_hour_day_stats", sql=HOUR_STATS_SQL)
def a11_hour_day_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: parse HTTP-API lines, then hour and day stats in one pass."""
    return hour_stats_of(http_records(spark, sf_dir))


# ---- P2 / P3 / F1-F3 / P12 / E2 -------------------------------------------------------------

from pushlake.functions import text as X  # noqa: E402
from pushlake.functions import timekeys as TK  # noqa: E402
from pushlake.plans.fixture_sql import (  # noqa: E402
    APPLIST_ROWS, PAIR_LINES, PROFILE_APP_LIST, PROFILE_APP_TAGS, PROFILE_DEVICE_INFO,
    PUSH_EVENTS, PUSH_OBJECTS, PUSH_ROWS, TIME_KEYS, VERSION_LINES,
)

JT = "regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def _jt(c: str) -> str:
    return JT.format(c=c)


@register("p2_explode_rows", sql=f"""
WITH {PUSH_EVENTS}, {PUSH_OBJECTS}
SELECT json_extract_string(obj, '$.msg_id') AS msg_id, json_extract_string(obj, '$.step') AS step FROM push_objects""")
def p2_explode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message payloads flattened to event objects."""
    objs = P.explode_rows(fx.push_messages(spark, sf_dir), "value", "obj")
    return objs.select(X.json_text("obj", "msg_id").alias("msg_id"), X.json_text("obj", "step").alias("step"))


SINGLE_OBJECTS = "push_objects AS (SELECT obj FROM push_events)"


@register("p3_project_push", sql=f"""
WITH {PUSH_EVENTS}, {SINGLE_OBJECTS}, {PUSH_ROWS}
SELECT appkey, platform, msg_id, uid, itime FROM push_rows""")
def p3_project_push(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + F1-F3: push events projected; sentinel, foreign steps and bad longs dropped."""
    return P.accepted(P.project_push(fx.push_events(spark, sf_dir))).drop("obj")


@register("p12_python_parser", sql=f"""
WITH {PUSH_EVENTS}, {PUSH_OBJECTS}, {PUSH_ROWS}
SELECT appkey, platform, msg_id, uid, itime FROM push_rows""")
def p12_python_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user parser as a Python table function, 0..n rows per message."""
    return P.accepted(_parsed_by_hook(fx.push_messages(spark, sf_dir)))


def _parsed_by_hook(messages: DataFrame) -> DataFrame:
    from pushlake.functions.parser_hooks import ENVELOPE_SCHEMA, EnvelopeParser

    return P.with_table_function(messages, EnvelopeParser, ENVELOPE_SCHEMA, "value")


@register("p12_rejects", sql="""
WITH m AS (
  SELECT event_id, event_id % 5 AS k FROM events)
SELECT CASE k WHEN 0 THEN 'msg_id' WHEN 1 THEN 'rows' WHEN 2 THEN 'json' WHEN 3 THEN 'sentinel' ELSE 'accepted' END AS outcome, count(*) AS n,
       CAST(sum(event_id) AS BIGINT) AS ids
FROM m GROUP BY k""")
def p12_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 + P11: rejects of the table function beside the message they came from, one of
    five kinds by event: an id beyond 64 bits, ``rows`` of another type, no JSON, the
    sentinel id, and a good message."""
    ev = fx.table(spark, sf_dir, "events")
    good = '{"msg_id":%s,"step":"seg-to-apns","itime":5,"uid":3}'
    bodies = [good % (1 << 70), '{"rows":7}', "no json", good % 1, good % 9]
    body = F.element_at(F.array(*[F.lit(b) for b in bodies]), (F.col("event_id") % 5 + 1).cast("int"))
    from pushlake.functions.parser_hooks import ENVELOPE_SCHEMA, EnvelopeParser

    parsed = P.with_table_function(ev.select("event_id", body.alias("value")), EnvelopeParser, ENVELOPE_SCHEMA, "value", keep=["event_id"])
    return parsed.groupBy(F.coalesce(P.REJECT, F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("long").alias("ids"))


@register("e2_transform_hook", sql="""
SELECT event_id, length(props) AS props_len, upper(event_type) AS kind FROM events""")
def e2_transform_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User hooks are plain DataFrame transforms."""
    def hook(df: DataFrame) -> DataFrame:
        return df.select("event_id", F.length("props").cast("bigint").alias("props_len"), F.upper("event_type").alias("kind"))

    return P.with_parser(fx.table(spark, sf_dir, "events"), hook)


def _push_fields(spark, sf_dir):
    ev = fx.push_events(spark, sf_dir)
    return ev.select(
        "event_id",
        X.json_text("obj", "msg_id").try_cast("bigint").alias("msg_id"),
        X.json_text("obj", "step").alias("step"),
        X.json_text("obj", "itime").try_cast("bigint").alias("itime"),
        X.json_text("obj", "uid").try_cast("bigint").alias("uid"),
    )


@register("f1_not_sentinel", sql=f"""
WITH {PUSH_EVENTS}
SELECT event_id FROM push_events WHERE TRY_CAST(json_extract_string(obj, '$.msg_id') AS BIGINT) <> 1""")
def f1_not_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """message 1 removed."""
    return _push_fields(spark, sf_dir).filter(P.is_not_sentinel("msg_id")).select("event_id")


@register("f2_step_is_target", sql=f"""
WITH {PUSH_EVENTS}
SELECT event_id, json_extract_string(obj, '$.step') AS step FROM push_events
WHERE {_jt("json_extract_string(obj, '$.step')")} IN ('seg-to-pushtask','seg-to-apns','seg-to-mpns','seg-to-mipns','seg-to-hpns','seg-to-mzpns')""")
def f2_step_is_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events of the six push channels."""
    return _push_fields(spark, sf_dir).filter(P.step_is_target("step")).select("event_id", "step")


@register("f3_longs_present", sql=f"""
WITH {PUSH_EVENTS}
SELECT event_id FROM push_events
WHERE TRY_CAST(json_extract_string(obj, '$.msg_id') AS BIGINT) IS NOT NULL
  AND TRY_CAST(json_extract_string(obj, '$.itime') AS BIGINT) IS NOT NULL
  AND TRY_CAST(json_extract_string(obj, '$.uid') AS BIGINT) IS NOT NULL""")
def f3_longs_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events whose required longs parse."""
    return _push_fields(spark, sf_dir).filter(P.longs_present("msg_id", "itime", "uid")).select("event_id")


@register("f4_imei_present", sql=f"""
WITH {APPLIST_ROWS}
SELECT imei, pkg, itime FROM applist_rows WHERE length(imei) > 0""")
def f4_imei_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app rows with a non-empty imei."""
    return fx.applist_rows(spark, sf_dir).filter(P.imei_present("imei", trim=False)).select("imei", "pkg", "itime")


@register("f5_json_keys_present", sql=f"""
WITH {PROFILE_APP_LIST}
SELECT line FROM profile_lines WHERE list_contains(json_keys(line), 'imei') AND list_contains(json_keys(line), 'app_list')""")
def f5_json_keys_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """profile lines that carry both keys."""
    return fx.profile_lines(spark, sf_dir, "app_list").filter(P.json_keys_present("line", "imei", "app_list"))


# ---- P4-P6 profile cells ---------------------------------------------------------------------

PROFILE_DAY = "20240101"
# epoch ms of 2024-01-01 00:00 in Asia/Shanghai, the job's cell time
PROFILE_TS_SQL = "epoch_ms(TIMESTAMP '2023-12-31 16:00:00')"


def _json_value_sql(doc: str, key: str) -> str:
    return (f"CASE WHEN json_type({doc}, '$.{key}') = 'VARCHAR' THEN json_extract_string({doc}, '$.{key}') "
            f"WHEN json_type({doc}, '$.{key}') = 'NULL' THEN NULL ELSE json_extract({doc}, '$.{key}')::VARCHAR END")


def _profile_query(kind: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = fx.profile_lines(spark, sf_dir, kind)
        cells = P.profile_cells(lines, kind, TK.day_to_ms(F.lit(PROFILE_DAY)))
        return P.accepted(cells).drop("line")

    return build


_QUAL = {"app_tags": "apptag", "app_list": "applist", "device_info": "devinfo"}

register("p4_profile_app_tags", sql=f"""
WITH {PROFILE_APP_TAGS},
s AS (SELECT string_split(regexp_replace(line, '(\t)+$', ''), chr(9)) AS arr FROM profile_lines),
d AS (SELECT {_jt('arr[1]')} AS imei, {_jt('arr[2]')} AS doc FROM s WHERE len(arr) = 2)
SELECT imei AS rowkey, 'C' AS family, 'apptag' AS qualifier, {PROFILE_TS_SQL} AS ts, {_jt(_json_value_sql('doc', 'app_tags'))} AS value
FROM d WHERE length(imei) > 0 AND json_valid(doc) AND list_contains(json_keys(doc), 'app_tags')
  AND {_json_value_sql('doc', 'app_tags')} IS NOT NULL""")(_profile_query("app_tags"))

for _kind, _fix in (("app_list", PROFILE_APP_LIST), ("device_info", PROFILE_DEVICE_INFO)):
    register(f"p{5 if _kind == 'app_list' else 6}_profile_{_kind}", sql=f"""
WITH {_fix}
SELECT {_jt("json_extract_string(line, '$.imei')")} AS rowkey, 'C' AS family, '{_QUAL[_kind]}' AS qualifier, {PROFILE_TS_SQL} AS ts,
       {_jt(_json_value_sql('line', _kind))} AS value
FROM profile_lines
WHERE list_contains(json_keys(line), 'imei') AND list_contains(json_keys(line), '{_kind}')
  AND json_extract_string(line, '$.imei') IS NOT NULL
  AND length({_jt("json_extract_string(line, '$.imei')")}) > 0
  AND {_json_value_sql('line', _kind)} IS NOT NULL""")(_profile_query(_kind))


# ---- P7 / P8 / P9 ----------------------------------------------------------------------------

VSPLIT = f"s AS (SELECT event_id, string_split(regexp_replace({_jt('line')}, '(\t)+$', ''), chr(9)) AS arr FROM version_lines)"


@register("p7_parse_versions_apkver", sql=f"""
WITH {VERSION_LINES}, {VSPLIT}
SELECT event_id, {_jt('arr[1]')} AS uid,
  CASE WHEN len(arr) = 2 THEN CASE WHEN contains({_jt('arr[2]')}, '.') THEN NULL ELSE {_jt('arr[2]')} END ELSE {_jt('arr[2]')} END AS appkey,
  CASE WHEN len(arr) = 2 THEN CASE WHEN contains({_jt('arr[2]')}, '.') THEN {_jt('arr[2]')} END ELSE {_jt('arr[3]')} END AS apkver
FROM s WHERE len(arr) > 1""")
def p7_parse_versions_apkver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version lines under the apkver flag."""
    return P.accepted(P.parse_versions(fx.version_lines(spark, sf_dir), "apkver", keep=["event_id"])).drop("line")


@register("p8_parse_versions_sdkver", sql=f"""
WITH {VERSION_LINES}, {VSPLIT}
SELECT event_id, {_jt('arr[1]')} AS uid,
  CASE WHEN len(arr) = 2 THEN CASE WHEN regexp_matches({_jt('arr[2]')}, '^[0-9]+.[0-9]+.[0-9]+$') THEN NULL ELSE {_jt('arr[2]')} END ELSE {_jt('arr[2]')} END AS channel,
  CASE WHEN len(arr) = 2 THEN CASE WHEN regexp_matches({_jt('arr[2]')}, '^[0-9]+.[0-9]+.[0-9]+$') THEN {_jt('arr[2]')} END ELSE {_jt('arr[3]')} END AS sdkver
FROM s WHERE len(arr) > 1""")
def p8_parse_versions_sdkver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version lines under the sdkver flag."""
    return P.accepted(P.parse_versions(fx.version_lines(spark, sf_dir), "sdkver", keep=["event_id"])).drop("line")


PAIRS_SQL = f"""
ps AS (SELECT event_id, string_split(regexp_replace({_jt('line')}, '( )+$', ''), ' ') AS arr FROM pair_lines),
pairs AS (SELECT event_id, {_jt('arr[1]')} AS imei, {_jt('arr[2]')} AS pkg FROM ps WHERE len(arr) = 2)"""


@register("p9_parse_pairs", sql=f"""
WITH {PAIR_LINES}, {PAIRS_SQL}
SELECT event_id, imei, pkg FROM pairs""")
def p9_parse_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """imei/pkg pair lines."""
    return P.accepted(P.parse_pairs(fx.pair_lines(spark, sf_dir), keep=["event_id"])).drop("line")


# ---- T1-T6 ----------------------------------------------------------------------------------

def _sh_hour(ms: str) -> str:
    return f"strftime(TIMESTAMP '1970-01-01' + to_milliseconds({ms}) + INTERVAL 8 HOUR, '%Y%m%d%H')"


@register("t1_time_keys", sql=f"""
SELECT event_id, CAST(substr(h, 1, 6) AS INTEGER) AS imon, CAST(substr(h, 1, 8) AS INTEGER) AS iday, CAST(h AS INTEGER) AS ihour
FROM (SELECT event_id, {_sh_hour('CASE WHEN event_id % 2 = 0 THEN (epoch_us(ts) // 1000000) * 1000 ELSE epoch_us(ts) // 1000 END')} AS h FROM events) t""")
def t1_time_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month, day and hour keys of epoch texts of both widths."""
    ev = fx.table(spark, sf_dir, "events")
    txt = F.when(F.col("event_id") % 2 == 0, TK.secs_of_ntz("ts")).otherwise(TK.ms_of_ntz("ts")).cast("string")
    k = TK.time_keys(txt)
    return ev.select("event_id", k["imon"].alias("imon"), k["iday"].alias("iday"), k["ihour"].alias("ihour"))


GRAIN_SQL = "CASE length(key) WHEN 6 THEN 'month' WHEN 8 THEN 'day' WHEN 10 THEN 'hour' END"


@register("t2_grain_of", sql=f"""
WITH {TIME_KEYS}
SELECT o_orderkey, key, {GRAIN_SQL} AS grain FROM time_keys""")
def t2_grain_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grain of each time key by its length."""
    tk = fx.time_key_rows(spark, sf_dir)
    return tk.select("o_orderkey", "key", TK.grain_of("key").alias("grain"))


@register("t3_key_is_valid", sql=f"""
WITH {TIME_KEYS}
SELECT o_orderkey, key, coalesce(CASE {GRAIN_SQL}
    WHEN 'month' THEN try_strptime(key || '01', '%Y%m%d') IS NOT NULL
    WHEN 'day' THEN try_strptime(key, '%Y%m%d') IS NOT NULL
    WHEN 'hour' THEN try_strptime(key, '%Y%m%d%H') IS NOT NULL END, false) AS valid
FROM time_keys""")
def t3_key_is_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict calendar check of each key for the grain of its length."""
    tk = fx.time_key_rows(spark, sf_dir)
    return tk.select("o_orderkey", "key", TK.key_is_valid("key", TK.grain_of("key")).alias("valid"))


@register("t4_day_to_ms", sql=f"""
WITH {TIME_KEYS}
SELECT o_orderkey, key, CASE WHEN length(key) = 8 THEN coalesce(epoch_ms(try_strptime(key, '%Y%m%d')) - 28800000, 0) ELSE 0 END AS ms
FROM time_keys""")
def t4_day_to_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: epoch ms of local midnight of day keys; 0 for keys of any other form."""
    tk = fx.time_key_rows(spark, sf_dir)
    return tk.select("o_orderkey", "key", TK.day_to_ms("key").alias("ms"))


@register("t5_nominal_parts", sql="""
SELECT event_id, strftime(ts, '%Y%m%d%H') AS yyyymmddhh, strftime(ts, '%Y') AS yyyy, strftime(ts, '%m') AS mm,
       strftime(ts, '%d') AS dd, strftime(ts, '%H') AS hh, 'hour_' || strftime(ts, '%H') AS hour_hh
FROM events""")
def t5_nominal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: text parts of a nominal time."""
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", TK.nominal_parts("ts").alias("p")).select("event_id", "p.*")


@register("t6_add_interval", sql="""
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 50000.0) AS INTEGER), '%Y-%m-%d') AS due,
       strftime(CAST(o_orderdate AS DATE) + INTERVAL (CAST(floor(o_totalprice / 100000.0) AS INTEGER)) MONTH, '%Y-%m-%d') AS due_month
FROM orders""")
def t6_add_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates plus floor(n) days and months."""
    o = fx.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey",
        TK.add_interval(d, F.col("o_totalprice") / 50000.0, "day").cast("string").alias("due"),
        TK.add_interval(d, F.col("o_totalprice") / 100000.0, "month").cast("string").alias("due_month"),
    )


def _version_cte(flag: str) -> str:
    """SQL CTE ``parsed_<flag>`` of P7 / P8 over version_lines (for other oracles)."""
    if flag == "apkver":
        test, a, b = f"contains({_jt('arr[2]')}, '.')", "appkey", "apkver"
    else:
        test, a, b = f"regexp_matches({_jt('arr[2]')}, '^[0-9]+.[0-9]+.[0-9]+$')", "channel", "sdkver"
    return f"""{VERSION_LINES}, {VSPLIT},
parsed_{flag} AS (
  SELECT event_id, {_jt('arr[1]')} AS uid,
    CASE WHEN len(arr) = 2 THEN CASE WHEN {test} THEN NULL ELSE {_jt('arr[2]')} END ELSE {_jt('arr[2]')} END AS {a},
    CASE WHEN len(arr) = 2 THEN CASE WHEN {test} THEN {_jt('arr[2]')} END ELSE {_jt('arr[3]')} END AS {b}
  FROM s WHERE len(arr) > 1)"""


PARSED_APKVER = _version_cte("apkver")
PARSED_SDKVER = _version_cte("sdkver")


@register("f8_strict_time_key", sql=f"""
WITH {TIME_KEYS}
SELECT o_orderkey, key FROM time_keys
WHERE CASE {GRAIN_SQL}
    WHEN 'month' THEN try_strptime(key || '01', '%Y%m%d') IS NOT NULL
    WHEN 'day' THEN try_strptime(key, '%Y%m%d') IS NOT NULL
    WHEN 'hour' THEN try_strptime(key, '%Y%m%d%H') IS NOT NULL END""")
def f8_strict_time_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: keep only keys that are real calendar times for the grain of their length."""
    tk = fx.time_key_rows(spark, sf_dir)
    return tk.filter(TK.key_is_valid("key", TK.grain_of("key")))


@register("a11_hour_day_stats_sketched", sql=f"""
SELECT iday, ihour, grain, n_msgs, true AS appkeys_within_bound, true AS msgids_within_bound FROM ({HOUR_STATS_SQL}) s""")
def a11_hour_day_stats_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 with mergeable HLL sketches: hour rows from one pass, day rows rolled up
    from them; every estimate is held against the exact count."""
    from pushlake.operators.cube import within_bound

    records = http_records(spark, sf_dir)
    sketched = R.hour_day_stats_sketched(records, "iday", "ihour", {"n_appkeys": "appkey", "n_msgids": "msgid"}, count="n_msgs")
    exact = hour_stats_of(records).select("iday", F.col("ihour").alias("h"), F.col("grain").alias("g"), F.col("n_appkeys").alias("apps"), F.col("n_msgids").alias("ids"), F.col("iday").alias("d")).drop("iday")
    both = sketched.join(exact, (F.col("iday") == F.col("d")) & F.col("ihour").eqNullSafe(F.col("h")) & (F.col("grain") == F.col("g")))
    flags = [within_bound(a, b, R.SKETCH_RSD).alias(n) for a, b, n in (("n_appkeys", "apps", "appkeys_within_bound"), ("n_msgids", "ids", "msgids_within_bound"))]
    return both.select("iday", "ihour", "grain", "n_msgs", *flags)


@register("a11_event_stats", sql="""
WITH e AS (SELECT user_id, value, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H') AS h FROM events)
SELECT CAST(substr(h, 1, 8) AS INTEGER) AS iday, CASE WHEN GROUPING(h) = 1 THEN NULL ELSE CAST(h AS INTEGER) END AS ihour,
       CASE WHEN GROUPING(h) = 1 THEN 'day' ELSE 'hour' END AS grain,
       count(*) AS n, count(DISTINCT user_id) AS users, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM e GROUP BY GROUPING SETS ((substr(h, 1, 8), h), (substr(h, 1, 8)))""")
def a11_event_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 with the decided metrics (D9): per hour and per day of the event time in
    the job's zone, the event count, distinct users and the value sum."""
    ev = fx.table(spark, sf_dir, "events")
    h = TK.hour_key(TK.ms_of_ntz("ts"))
    keyed = ev.select("user_id", "value", F.substring(h, 1, 8).try_cast("int").alias("iday"), h.try_cast("int").alias("ihour"))
    stats = R.hour_day_stats(keyed, "iday", "ihour", [
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    ])
    return stats
