"""Inputs in the reference's layouts, derived from the driver's tables.

Each function reads the given tables and only reshapes rows into the layout a
job expects (text lines, JSON events, versioned cells, ...). None of them does
any of a job's work; the jobs in ``pushlake.operators`` must be right on any
input of these layouts. The same derivations are written in SQL in
``pushlake.plans.fixture_sql`` so the DuckDB oracle sees the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.functions.timekeys import ms_of_ntz, ntz_key, secs_of_ntz

TAB = "\t"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# ---- text lines ---------------------------------------------------------------------------

def http_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP-API log lines (event_id, line) from ``events``: both epoch widths, a few
    malformed msgids, extra fields, short lines and Java-trimmable blanks."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    fields = [
        F.concat(F.lit("app"), _s(F.col("user_id") % 7)),
        F.when(eid % 97 == 0, F.lit("x")).otherwise(_s(eid)),
        _s(F.when(eid % 2 == 0, secs_of_ntz("ts")).otherwise(ms_of_ntz("ts"))),
        F.col("event_type"),
        F.concat(F.lit("r"), _s(eid % 3)),
        F.lit("0"),
        F.when(F.col("user_id") % 2 == 0, F.lit("a")).otherwise(F.lit("i")),
    ]
    line = (
        F.when(eid % 13 == 0, F.concat_ws(TAB, *fields[:6]))
        .when(eid % 11 == 0, F.concat_ws(TAB, *fields, F.lit("extra"), F.lit("more")))
        .otherwise(F.concat_ws(TAB, *fields))
    )
    line = F.when(eid % 3 == 0, F.concat(F.lit(" "), line, F.lit(TAB))).otherwise(line)
    return ev.select("event_id", line.alias("line"))


def _q(c: Column) -> Column:
    """JSON string literal of a text column (no escaping needed for these values)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


# Fixed mapping used to shape push events: event_type -> step text.
STEP_OF_TYPE = {
    "error": "seg-to-apns",
    "click": " seg-to-mipns ",
    "signup": "seg-to-pushtask",
    "purchase": "seg-to-hpns",
    "view": "seg-other",
}


def _step(c: Column) -> Column:
    out = None
    for k, v in STEP_OF_TYPE.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(F.lit("seg-unknown"))


def push_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Push events as JSON text (event_id, user_id, day, obj): sentinel msg 1, steps
    in and out of the channel set, appkey / platform absent or null, uid as text."""
    ev = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    appkey = (
        F.when(uid % 10 == 0, F.lit(""))
        .when(eid % 17 == 0, F.lit(',"appkey":null'))
        .otherwise(F.concat(F.lit(',"appkey":"app'), _s(uid % 7), F.lit('"')))
    )
    platform = (
        F.when(uid % 11 == 0, F.lit(""))
        .when(eid % 19 == 0, F.lit(',"platform":null'))
        .otherwise(F.concat(F.lit(',"platform":"'), F.when(uid % 2 == 0, F.lit("a")).otherwise(F.lit("i")), F.lit('"')))
    )
    uid_txt = F.when(eid % 5 == 0, _q(_s(uid))).otherwise(_s(uid))
    obj = F.concat(
        F.lit('{"msg_id":'), _s(eid),
        F.lit(',"step":"'), _step(F.col("event_type")), F.lit('"'),
        appkey, platform,
        F.lit(',"itime":'), _s(ms_of_ntz("ts")),
        F.lit(',"uid":'), uid_txt,
        F.lit(',"extra":'), F.col("props"),
        F.lit("}"),
    )
    return ev.select("event_id", "user_id", F.to_date("ts").alias("day"), obj.alias("obj"))


def push_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message payloads (``value``): events of users with user_id % 3 = 0 alone, the
    others batched per (user, day) in an envelope ``{"rows": [...]}``; envelopes of
    users with user_id % 4 = 0 also carry a non-object element."""
    ev = push_events(spark, sf_dir)
    single = ev.filter(F.col("user_id") % 3 == 0).select(F.col("obj").alias("value"))
    grouped = ev.filter(F.col("user_id") % 3 != 0).groupBy("user_id", "day").agg(
        F.array_join(F.collect_list("obj"), ",").alias("objs")
    )
    env = grouped.select(
        F.concat(
            F.lit('{"rows":['), F.col("objs"),
            F.when(F.col("user_id") % 4 == 0, F.lit(",5")).otherwise(F.lit("")),
            F.lit("]}"),
        ).alias("value")
    )
    return single.unionByName(env)


def applist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App-list rows (imei, pkg, name, itime) from lineitem + orders + part:
    imei = customer key (blank for o_custkey % 50 = 0), itime = ship date seconds,
    name null for l_orderkey % 101 = 0."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.when(F.col("o_custkey") % 50 == 0, F.lit("")).otherwise(_s(F.col("o_custkey"))).alias("imei"),
        F.concat(F.lit("com."), F.col("p_brand")).alias("pkg"),
        F.when(F.col("l_orderkey") % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("name"),
        secs_of_ntz("l_shipdate").alias("itime"),
    )


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``imei pkg`` lines (event_id, line) in event_id order: imei = event_type,
    pkg = p<user_id>; every 50th line has a third field."""
    ev = table(spark, sf_dir, "events")
    line = F.concat(F.col("event_type"), F.lit(" p"), _s(F.col("user_id")))
    line = F.when(F.col("event_id") % 50 == 0, F.concat(line, F.lit(" x"))).otherwise(line)
    return ev.select("event_id", line.alias("line"))


def version_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uid [TAB a] [TAB b]`` lines (event_id, line) with one, two (dotted, numeric,
    plain) or three fields by event_id % 4."""
    ev = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), _s(F.col("user_id"))
    two_dotted = F.concat_ws(".", _s(eid % 10), _s(F.col("user_id") % 10), _s(eid % 7))
    second = F.when(eid % 8 == 6, _s(eid * 7)).otherwise(two_dotted)
    line = (
        F.when(eid % 4 == 0, uid)
        .when(eid % 4 == 1, F.concat_ws(TAB, uid, F.concat(F.lit("c_"), F.col("event_type"))))
        .when(eid % 4 == 2, F.concat_ws(TAB, uid, second))
        .otherwise(F.concat_ws(TAB, uid, F.concat(F.lit("k"), _s(F.col("user_id") % 5)), F.concat_ws(".", _s(eid % 3), _s(eid % 10), F.lit("0"))))
    )
    return ev.select("event_id", line.alias("line"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (uid, appkey, apkver, sdkver, channel), one per customer
    (uid = c_custkey)."""
    d = table(spark, sf_dir, "customer")
    return d.select(
        _s(F.col("c_custkey")).alias("uid"),
        F.col("c_mktsegment").alias("appkey"),
        F.lit(None).cast("string").alias("apkver"),
        F.lit("1.0.0").alias("sdkver"),
        F.concat(F.lit("c"), _s(F.col("c_nationkey"))).alias("channel"),
    )


def user_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User cells under the reversed customer key:
    appkey (plus an older version), apkver, sdkver, channel (absent when
    c_custkey % 5 = 0)."""
    c = table(spark, sf_dir, "customer")
    k = F.reverse(_s(F.col("c_custkey")))
    ts = F.col("c_custkey") * 1000
    items = F.array(
        F.struct(F.lit("appkey").alias("q"), (ts + 10).alias("t"), F.col("c_mktsegment").alias("v")),
        F.struct(F.lit("appkey").alias("q"), ts.alias("t"), F.lit("old").alias("v")),
        F.struct(F.lit("apkver").alias("q"), ts.alias("t"), F.concat(F.lit("v"), _s(F.col("c_nationkey") % 3)).alias("v")),
        F.struct(F.lit("sdkver").alias("q"), ts.alias("t"), F.concat(F.lit("2."), _s(F.col("c_nationkey")), F.lit(".0")).alias("v")),
        F.struct(F.lit("channel").alias("q"), ts.alias("t"), F.concat(F.lit("c"), _s(F.col("c_nationkey"))).alias("v")),
    )
    x = c.select(k.alias("rowkey"), F.col("c_custkey"), F.explode(items).alias("i"))
    x = x.filter(~((F.col("i.q") == "channel") & (F.col("c_custkey") % 5 == 0)))
    return x.select("rowkey", F.lit("u").alias("family"), F.col("i.q").alias("qualifier"), F.col("i.t").cast("bigint").alias("ts"), F.col("i.v").alias("value"))


def stats_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App-stats cells: rowkey = md5(user_id), family A, qualifier = event_type,
    ts = event ms, value = event value as text."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.md5(_s(F.col("user_id"))).alias("rowkey"),
        F.lit("A").alias("family"),
        F.col("event_type").alias("qualifier"),
        ms_of_ntz("ts").alias("ts"),
        _s(F.col("value")).alias("value"),
    )


def report_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report cells: each event is a version of (user_id, A:app1) at its ms."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        _s(F.col("user_id")).alias("rowkey"), F.lit("A").alias("family"), F.lit("app1").alias("qualifier"),
        ms_of_ntz("ts").alias("ts"), F.lit("1").alias("value"),
    )


def offline_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline cells: each event gives 1 + event_id % 4 int versions of
    (user_id + app1 + event seconds, A:clicks); for odd users the key is one second
    off, so their lookups miss."""
    ev = table(spark, sf_dir, "events")
    secs = secs_of_ntz("ts") - F.when(F.col("user_id") % 2 == 1, F.lit(1)).otherwise(F.lit(0))
    x = ev.select(
        F.concat(_s(F.col("user_id")), F.lit("app1"), _s(secs)).alias("rowkey"),
        ms_of_ntz("ts").alias("ms"),
        F.floor(F.col("value")).cast("bigint").alias("v"),
        F.explode(F.sequence(F.lit(0), F.col("event_id") % 4)).alias("j"),
    )
    return x.select(
        "rowkey", F.lit("A").alias("family"), F.lit("clicks").alias("qualifier"),
        (F.col("ms") - F.col("j")).alias("ts"), _s(F.col("v") + F.col("j")).alias("value"),
    )


def msg_key_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-file lines: the user id of every event (duplicates kept), padded with
    blanks on every 4th line."""
    ev = table(spark, sf_dir, "events")
    k = _s(F.col("user_id"))
    return ev.select(F.when(F.col("event_id") % 4 == 0, F.concat(F.lit(" "), k, F.lit("\t"))).otherwise(k).alias("line"))


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat star rows: lineitem + orders + customer + nation + region, with dims
    r_name, c_mktsegment, o_orderstatus, o_orderpriority, c_nationkey, order year and
    the measure price = l_extendedprice as decimal(18,2)."""
    from pushlake.operators.cube import flat_table

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return flat_table(
        li,
        [(o, "l_orderkey", "o_orderkey"), (c, "o_custkey", "c_custkey"), (n, "c_nationkey", "n_nationkey"), (r, "n_regionkey", "r_regionkey")],
        [
            "r_name", "c_mktsegment", "o_orderstatus", "o_orderpriority", "c_nationkey",
            F.year("o_orderdate").alias("o_year"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        ],
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cube job records (cube, name, job_status, duration s) from events."""
    ev = table(spark, sf_dir, "events")
    cube = F.concat(F.lit("Cube_"), _s(F.col("user_id") % 20))
    return ev.select(
        cube.alias("cube"),
        F.concat(cube, F.lit(" - seg"), _s(F.col("event_id"))).alias("name"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).when(F.col("event_type") == "click", F.lit("RUNNING")).otherwise(F.lit("FINISHED")).alias("job_status"),
        F.floor(F.col("value") * 20).cast("bigint").alias("duration"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates (id, lng, lat) from customer keys, inside and outside the box."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        (F.lit(70.0) + (F.col("c_custkey") % 7000) / 100.0).alias("lng"),
        ((F.col("c_custkey") % 6000) / 100.0).alias("lat"),
    )


def time_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time keys (o_orderkey, key) of order dates: month, day or hour keys by
    o_orderkey % 3, day 30 forced on every 7th, ``99`` on every 100th."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ym = ntz_key("o_orderdate", "month")
    ymd = F.when(k % 7 == 0, F.concat(ym, F.lit("30"))).otherwise(ntz_key("o_orderdate", "day"))
    hh = F.lpad(_s(k % 26), 2, "0")
    key = F.when(k % 100 == 0, F.lit("99")).when(k % 3 == 0, ym).when(k % 3 == 1, ymd).otherwise(F.concat(ymd, hh))
    return o.select(k.alias("o_orderkey"), key.alias("key"))


def profile_lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Profile lines of one kind. app_tags: ``user_id TAB {"app_tags": props}``
    from events (key named tags for view events, a third field every 50th line);
    app_list: JSON lines from events; device_info: JSON lines from customer (blank
    imei every 40th, null value every 33rd)."""
    if kind == "app_tags":
        ev = table(spark, sf_dir, "events")
        key = F.when(F.col("event_type") == "view", F.lit("tags")).otherwise(F.lit("app_tags"))
        doc = F.concat(F.lit('{"'), key, F.lit('": '), F.col("props"), F.lit("}"))
        line = F.concat(_s(F.col("user_id")), F.lit(TAB), doc)
        line = F.when(F.col("event_id") % 50 == 0, F.concat(line, F.lit(TAB), F.lit("x"))).otherwise(line)
        return ev.select(line.alias("line"))
    if kind == "app_list":
        ev = table(spark, sf_dir, "events")
        imei = F.when(F.col("event_type") == "error", F.lit('" "')).otherwise(_q(_s(F.col("user_id"))))
        lst = F.concat(F.lit('["p'), _s(F.col("event_id") % 13), F.lit('", "'), F.col("event_type"), F.lit('"]'))
        line = F.concat(F.lit('{"imei": '), imei, F.lit(', "app_list": '), lst, F.lit("}"))
        return ev.select(line.alias("line"))
    if kind == "device_info":
        c = table(spark, sf_dir, "customer")
        k = F.col("c_custkey")
        imei = F.when(k % 40 == 0, F.lit('""')).otherwise(_q(_s(k)))
        info = F.when(k % 33 == 0, F.lit("null")).otherwise(
            F.concat(F.lit('{"nation": '), _s(F.col("c_nationkey")), F.lit(', "seg": "'), F.col("c_mktsegment"), F.lit('"}'))
        )
        return c.select(F.concat(F.lit('{"imei": '), imei, F.lit(', "device_info": '), info, F.lit("}")).alias("line"))
    raise ValueError(kind)
