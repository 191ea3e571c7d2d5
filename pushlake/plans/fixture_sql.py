"""The fixture derivations of ``fixtures.py`` in DuckDB SQL, as CTE bodies.

Only the oracle uses these. They reshape the driver's tables exactly as the
Spark fixtures do; the operator logic in each oracle query is written
independently in SQL.
"""

from __future__ import annotations

# epoch seconds / ms of a TIMESTAMP read as UTC wall clock
MS = "(epoch_us({c}) // 1000)"
SECS = "(epoch_us({c}) // 1000000)"

# Java String.trim() and its split (trailing empty fields dropped)
JTRIM = "regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def jtrim(c: str) -> str:
    return JTRIM.format(c=c)


def jsplit(c: str, sep: str) -> str:
    """Java split on a literal one-char separator: trailing empty fields dropped."""
    return f"string_split(regexp_replace({c}, '({sep})+$', ''), '{sep}')"


# yyyyMMddHH in Asia/Shanghai (fixed UTC+8 since 1991) of epoch ms
def shanghai_hour(ms: str) -> str:
    return f"strftime(TIMESTAMP '1970-01-01' + to_milliseconds({ms}) + INTERVAL 8 HOUR, '%Y%m%d%H')"


HTTP_LINES = f"""
http_lines AS (
  SELECT event_id,
         CASE WHEN event_id % 3 = 0 THEN ' ' || l2 || chr(9) ELSE l2 END AS line
  FROM (
    SELECT event_id,
      CASE WHEN event_id % 13 = 0 THEN concat_ws(chr(9), f0, f1, f2, f3, f4, f5)
           WHEN event_id % 11 = 0 THEN concat_ws(chr(9), f0, f1, f2, f3, f4, f5, f6, 'extra', 'more')
           ELSE concat_ws(chr(9), f0, f1, f2, f3, f4, f5, f6) END AS l2
    FROM (
      SELECT event_id,
        'app' || CAST(user_id % 7 AS VARCHAR) AS f0,
        CASE WHEN event_id % 97 = 0 THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS f1,
        CAST(CASE WHEN event_id % 2 = 0 THEN {SECS.format(c='ts')} ELSE {MS.format(c='ts')} END AS VARCHAR) AS f2,
        event_type AS f3,
        'r' || CAST(event_id % 3 AS VARCHAR) AS f4,
        '0' AS f5,
        CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'i' END AS f6
      FROM events) t0) t1)"""

# P1 in SQL over http_lines: typed records of the accepted lines
HTTP_RECORDS = f"""
http_split AS (
  SELECT event_id, line, {jsplit(jtrim('line'), chr(9))} AS arr FROM http_lines),
http_typed AS (
  SELECT event_id, line, len(arr) AS n,
         {jtrim('arr[1]')} AS appkey,
         TRY_CAST(arr[2] AS BIGINT) AS msgid,
         TRY_CAST(arr[3] AS BIGINT) AS itime,
         arr[4] AS msg_type, arr[5] AS receiver_type, arr[6] AS errno, arr[7] AS platform,
         CASE WHEN length(arr[3]) = 10 THEN TRY_CAST(arr[3] AS BIGINT) * 1000 ELSE TRY_CAST(arr[3] AS BIGINT) END AS ms
  FROM http_split),
http_records AS (
  SELECT event_id, appkey, msgid, itime, msg_type, receiver_type, errno, platform,
         CAST(substr(h, 1, 6) AS INTEGER) AS imon,
         CAST(substr(h, 1, 8) AS INTEGER) AS iday,
         CAST(h AS INTEGER) AS ihour
  FROM (SELECT *, {shanghai_hour('ms')} AS h FROM http_typed) t
  WHERE n >= 7 AND msgid IS NOT NULL AND itime IS NOT NULL)"""


STEP_CASE = """CASE event_type WHEN 'error' THEN 'seg-to-apns' WHEN 'click' THEN ' seg-to-mipns '
  WHEN 'signup' THEN 'seg-to-pushtask' WHEN 'purchase' THEN 'seg-to-hpns' WHEN 'view' THEN 'seg-other'
  ELSE 'seg-unknown' END"""

PUSH_EVENTS = f"""
push_events AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS day,
    '{{"msg_id":' || CAST(event_id AS VARCHAR)
    || ',"step":"' || {STEP_CASE} || '"'
    || CASE WHEN user_id % 10 = 0 THEN '' WHEN event_id % 17 = 0 THEN ',"appkey":null'
            ELSE ',"appkey":"app' || CAST(user_id % 7 AS VARCHAR) || '"' END
    || CASE WHEN user_id % 11 = 0 THEN '' WHEN event_id % 19 = 0 THEN ',"platform":null'
            ELSE ',"platform":"' || CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'i' END || '"' END
    || ',"itime":' || CAST({MS.format(c='ts')} AS VARCHAR)
    || ',"uid":' || CASE WHEN event_id % 5 = 0 THEN '"' || CAST(user_id AS VARCHAR) || '"' ELSE CAST(user_id AS VARCHAR) END
    || ',"extra":' || props || '}}' AS obj
  FROM events)"""

# the element objects that the messages carry (singles and envelope members)
PUSH_OBJECTS = """
push_objects AS (
  SELECT obj FROM push_events
  UNION ALL
  SELECT '5' AS obj FROM (SELECT DISTINCT user_id, day FROM push_events WHERE user_id % 3 <> 0 AND user_id % 4 = 0) t)"""

# P3 + F1-F3 in SQL over push_objects
PUSH_ROWS = """
push_parsed AS (
  SELECT obj, json_keys(obj) AS keys,
         TRY_CAST(json_extract_string(obj, '$.msg_id') AS BIGINT) AS msg_id,
         json_extract_string(obj, '$.step') AS step,
         json_extract_string(obj, '$.appkey') AS appkey_raw,
         json_extract_string(obj, '$.platform') AS platform_raw,
         TRY_CAST(json_extract_string(obj, '$.itime') AS BIGINT) AS itime,
         TRY_CAST(json_extract_string(obj, '$.uid') AS BIGINT) AS uid
  FROM push_objects WHERE json_valid(obj) AND json_type(obj) = 'OBJECT'),
push_rows AS (
  SELECT CASE WHEN list_contains(keys, 'appkey') THEN regexp_replace(appkey_raw, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') ELSE 'null' END AS appkey,
         coalesce(platform_raw, 'null') AS platform, msg_id, uid, itime
  FROM push_parsed
  WHERE msg_id IS NOT NULL AND msg_id <> 1
    AND regexp_replace(step, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') IN ('seg-to-pushtask','seg-to-apns','seg-to-mpns','seg-to-mipns','seg-to-hpns','seg-to-mzpns')
    AND NOT (list_contains(keys, 'appkey') AND appkey_raw IS NULL)
    AND itime IS NOT NULL AND uid IS NOT NULL)"""

APPLIST_ROWS = f"""
applist_rows AS (
  SELECT CASE WHEN o_custkey % 50 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS imei,
         'com.' || p_brand AS pkg,
         CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE p_name END AS name,
         {SECS.format(c='l_shipdate')} AS itime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

PAIR_LINES = """
pair_lines AS (
  SELECT event_id, CASE WHEN event_id % 50 = 0 THEN event_type || ' p' || CAST(user_id AS VARCHAR) || ' x'
                        ELSE event_type || ' p' || CAST(user_id AS VARCHAR) END AS line
  FROM events)"""

VERSION_LINES = """
version_lines AS (
  SELECT event_id, CASE
    WHEN event_id % 4 = 0 THEN CAST(user_id AS VARCHAR)
    WHEN event_id % 4 = 1 THEN CAST(user_id AS VARCHAR) || chr(9) || 'c_' || event_type
    WHEN event_id % 4 = 2 THEN CAST(user_id AS VARCHAR) || chr(9) ||
         CASE WHEN event_id % 8 = 6 THEN CAST(event_id * 7 AS VARCHAR)
              ELSE CAST(event_id % 10 AS VARCHAR) || '.' || CAST(user_id % 10 AS VARCHAR) || '.' || CAST(event_id % 7 AS VARCHAR) END
    ELSE CAST(user_id AS VARCHAR) || chr(9) || 'k' || CAST(user_id % 5 AS VARCHAR) || chr(9)
         || CAST(event_id % 3 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) || '.0' END AS line
  FROM events)"""

DOCS = """
docs AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, c_mktsegment AS appkey, CAST(NULL AS VARCHAR) AS apkver,
         '1.0.0' AS sdkver, 'c' || CAST(c_nationkey AS VARCHAR) AS channel
  FROM customer)"""

USER_CELLS = """
user_cells AS (
  SELECT reverse(CAST(c_custkey AS VARCHAR)) AS rowkey, 'u' AS family, q AS qualifier, t AS ts, v AS value FROM (
    SELECT c_custkey, 'appkey' AS q, c_custkey * 1000 + 10 AS t, c_mktsegment AS v FROM customer
    UNION ALL SELECT c_custkey, 'appkey', c_custkey * 1000, 'old' FROM customer
    UNION ALL SELECT c_custkey, 'apkver', c_custkey * 1000, 'v' || CAST(c_nationkey % 3 AS VARCHAR) FROM customer
    UNION ALL SELECT c_custkey, 'sdkver', c_custkey * 1000, '2.' || CAST(c_nationkey AS VARCHAR) || '.0' FROM customer
    UNION ALL SELECT c_custkey, 'channel', c_custkey * 1000, 'c' || CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_custkey % 5 <> 0
  ) t)"""

STATS_CELLS = f"""
stats_cells AS (
  SELECT md5(CAST(user_id AS VARCHAR)) AS rowkey, 'A' AS family, event_type AS qualifier,
         {MS.format(c='ts')} AS ts, CAST(value AS VARCHAR) AS value
  FROM events)"""

REPORT_CELLS = f"""
report_cells AS (
  SELECT CAST(user_id AS VARCHAR) AS rowkey, 'A' AS family, 'app1' AS qualifier, {MS.format(c='ts')} AS ts, '1' AS value
  FROM events)"""

OFFLINE_CELLS = f"""
offline_cells AS (
  SELECT CAST(user_id AS VARCHAR) || 'app1' || CAST({SECS.format(c='ts')} - CASE WHEN user_id % 2 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS rowkey,
         'A' AS family, 'clicks' AS qualifier, {MS.format(c='ts')} - j AS ts,
         CAST(CAST(floor(value) AS BIGINT) + j AS VARCHAR) AS value
  FROM (SELECT *, unnest(range(0, event_id % 4 + 1)) AS j FROM events) t)"""

MSG_KEY_LINES = """
msg_key_lines AS (
  SELECT CASE WHEN event_id % 4 = 0 THEN ' ' || CAST(user_id AS VARCHAR) || chr(9) ELSE CAST(user_id AS VARCHAR) END AS line
  FROM events)"""

STAR = """
star AS (
  SELECT r_name, c_mktsegment, o_orderstatus, o_orderpriority, c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS o_year,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

JOBS = """
jobs AS (
  SELECT 'Cube_' || CAST(user_id % 20 AS VARCHAR) AS cube,
         'Cube_' || CAST(user_id % 20 AS VARCHAR) || ' - seg' || CAST(event_id AS VARCHAR) AS name,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'click' THEN 'RUNNING' ELSE 'FINISHED' END AS job_status,
         CAST(floor(value * 20) AS BIGINT) AS duration
  FROM events)"""

POINTS = """
points AS (
  SELECT c_custkey AS id, 70.0::DOUBLE + CAST(c_custkey % 7000 AS DOUBLE) / 100.0::DOUBLE AS lng,
         CAST(c_custkey % 6000 AS DOUBLE) / 100.0::DOUBLE AS lat
  FROM customer)"""

TIME_KEYS = """
time_keys AS (
  SELECT o_orderkey, CASE
    WHEN o_orderkey % 100 = 0 THEN '99'
    WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y%m')
    WHEN o_orderkey % 3 = 1 THEN ymd
    ELSE ymd || lpad(CAST(o_orderkey % 26 AS VARCHAR), 2, '0') END AS key
  FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y%m') || '30' ELSE strftime(o_orderdate, '%Y%m%d') END AS ymd FROM orders) t)"""

PROFILE_APP_TAGS = """
profile_lines AS (
  SELECT CASE WHEN event_id % 50 = 0 THEN l || chr(9) || 'x' ELSE l END AS line FROM (
    SELECT event_id, CAST(user_id AS VARCHAR) || chr(9) || '{"' || CASE WHEN event_type = 'view' THEN 'tags' ELSE 'app_tags' END || '": ' || props || '}' AS l
    FROM events) t)"""

PROFILE_APP_LIST = """
profile_lines AS (
  SELECT '{"imei": ' || CASE WHEN event_type = 'error' THEN '" "' ELSE '"' || CAST(user_id AS VARCHAR) || '"' END
         || ', "app_list": ["p' || CAST(event_id % 13 AS VARCHAR) || '", "' || event_type || '"]}' AS line
  FROM events)"""

PROFILE_DEVICE_INFO = """
profile_lines AS (
  SELECT '{"imei": ' || CASE WHEN c_custkey % 40 = 0 THEN '""' ELSE '"' || CAST(c_custkey AS VARCHAR) || '"' END
         || ', "device_info": ' || CASE WHEN c_custkey % 33 = 0 THEN 'null'
              ELSE '{"nation": ' || CAST(c_nationkey AS VARCHAR) || ', "seg": "' || c_mktsegment || '"}' END || '}' AS line
  FROM customer)"""
