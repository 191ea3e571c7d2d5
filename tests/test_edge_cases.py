"""Literal edge cases (FIXTURES.md part C): expected values follow the reference's
"""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pushlake.functions import geo as G
from pushlake.functions import text as X
from pushlake.functions import timekeys as TK
from pushlake.operators import alerts as AL
from pushlake.operators import cells as C
from pushlake.operators import cube as CB
from pushlake.operators import ordered as O
from pushlake.operators import parse as P
from pushlake.operators import rollup as R
from pushlake.operators.merge import merge_docs

TAB = "\t"


def lines(spark, *ls):
    return spark.createDataFrame([(i, s) for i, s in enumerate(ls)], "n long, line string")


# ---- P1 / T1 -----------------------------------------------------------------------------------

def test_p1_field_rules(spark):
    good = TAB.join(["k", "5", "1494496411", "t", "r", "0", "a"])
    seven_last_empty = TAB.join(["k", "5", "1494496411", "t", "r", "0", ""])
    nine = TAB.join(["k", "6", "1494496411800", "t", "r", "0", "a", "x", "y"])
    padded = TAB.join(["k", " 5", "1494496411", "t", "r", "0", "a"])
    bad_id = TAB.join(["k", "x", "1494496411", "t", "r", "0", "a"])
    parsed = P.parse_http_api(lines(spark, good, seven_last_empty, nine, padded, bad_id), keep=["n"])
    out = {r.n: r for r in parsed.collect()}
    assert out[0].reject_reason is None and (out[0].imon, out[0].iday, out[0].ihour) == (201705, 20170511, 2017051117)
    assert out[1].reject_reason == "fields"  # trim + split leave six fields
    assert out[2].reject_reason is None and out[2].ihour == 2017051117  # ms width, extras ignored
    assert out[3].reject_reason is None and out[3].msgid == 5  # D10: blanks accepted
    assert out[4].reject_reason == "msgid"


def test_p1_rejects_add_up(spark):
    ls = lines(spark, "a", TAB.join(["k", "1", "1494496411", "t", "r", "0", "a"]), "", "x\ty")
    parsed = P.parse_http_api(ls)
    assert P.accepted(parsed).count() + P.rejects(parsed).count() == 4


def test_t1_zone_is_explicit(spark):
    df = spark.createDataFrame([("1494496411",), ("1494496411800",)], "t string")
    keys = [tuple(r.k) for r in df.select(TK.time_keys("t").alias("k")).collect()]
    assert keys == [(201705, 20170511, 2017051117)] * 2


# ---- push events ---------------------------------------------------------------------------

def _ev(**kw):
    base = {"msg_id": 7, "step": "seg-to-apns", "appkey": "k", "platform": "a", "itime": 5, "uid": 9}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not Ellipsis})


def test_p3_defaults_and_nulls(spark):
    bodies = [
        _ev(msg_id=1),                       # F1 sentinel
        _ev(appkey=..., platform=...),       # both absent -> "null"
        _ev(appkey=None),                    # D2: null appkey drops the row
        _ev(platform=None),                  # D2: null platform -> "null"
        _ev(step=" seg-to-mipns "),          # trimmed step accepted
        _ev(step="seg-other"),               # F2
        _ev(uid="12"),                       # number as text accepted
        _ev(uid=...),                        # F3
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "obj string")
    parsed = {r.obj: r for r in P.project_push(df).collect()}
    reasons = [parsed[b].reject_reason for b in bodies]
    assert reasons == ["sentinel", None, "appkey_null", None, None, "step_not_target", None, "uid"]
    assert (parsed[bodies[1]].appkey, parsed[bodies[1]].platform) == ("null", "null")
    assert parsed[bodies[3]].platform == "null"
    assert parsed[bodies[6]].uid == 12


def test_p2_bad_element_keeps_siblings(spark):
    body = '{"rows":[' + _ev(msg_id=2) + ',' + _ev(step="bad") + ',5,' + _ev(msg_id=3) + ']}'
    df = spark.createDataFrame([(body,), (_ev(msg_id=4),), ('{"rows": null, "msg_id": 8}',)], "body string")
    objs = P.explode_rows(df)
    assert objs.count() == 6
    got = sorted(r.msg_id for r in P.accepted(P.project_push(objs)).collect())
    assert got == [2, 3, 4]


# ---- profile cells ------------------------------------------------------------------------

def test_p4_p5_rules(spark):
    tags = lines(spark, "i1\t{\"x\":1}", "i1\t{\"app_tags\":\"a\"}\tz", "i2\t{\"app_tags\":{\"b\": 1}}", " \t{\"app_tags\":\"a\"}")
    got = P.accepted(P.profile_cells(tags, "app_tags", F.lit(0))).collect()
    assert [(r.rowkey, r.value) for r in got] == [("i2", '{"b":1}')]
    lst = lines(spark, '{"imei": "  ", "app_list": [1]}', '{"imei": "i3", "app_list": null}', '{"imei": "i4", "app_list": [1, 2]}')
    got = P.accepted(P.profile_cells(lst, "app_list", F.lit(0))).collect()
    assert [(r.rowkey, r.qualifier, r.value) for r in got] == [("i4", "applist", "[1,2]")]
    assert P.profile_cells(lst, "unknown", F.lit(0)).count() == 0


# ---- version lines and merge -------------------------------------------------------------------

def test_p7_p8_branches(spark):
    ls = lines(spark, "u", "u\tk", "u\t1.2", "u\tk\t1.2")
    got = [(r.appkey, r.apkver) for r in P.accepted(P.parse_versions(ls, "apkver", keep=["n"])).orderBy("n").collect()]
    assert got == [("k", None), (None, "1.2"), ("k", "1.2")]
    ls = lines(spark, "u\t1.2.3", "u\t12345", "u\tweb")
    got = [(r.channel, r.sdkver) for r in P.accepted(P.parse_versions(ls, "sdkver", keep=["n"])).orderBy("n").collect()]
    assert got == [(None, "1.2.3"), (None, "12345"), ("web", None)]  # D3: unescaped dots


def test_u1_null_overwrites(spark):
    docs = spark.createDataFrame([("u", "a", "1.0", "s", "c"), ("v", "x", "9", "s", "c")], "uid string, appkey string, apkver string, sdkver string, channel string")
    ups = P.accepted(P.parse_versions(lines(spark, "u\tb", "w\tk\t2.0"), "apkver", keep=["n"]))
    out = {r.uid: r for r in merge_docs(docs, ups, "uid", ["appkey", "apkver"], "n").collect()}
    assert (out["u"].appkey, out["u"].apkver, out["u"].sdkver) == ("b", None, "s")
    assert (out["v"].appkey, out["v"].apkver) == ("x", "9")
    assert (out["w"].appkey, out["w"].apkver, out["w"].sdkver) == ("k", "2.0", None)
    again = merge_docs(merge_docs(docs, ups, "uid", ["appkey", "apkver"], "n"), ups, "uid", ["appkey", "apkver"], "n")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merge_docs(docs, ups, "uid", ["appkey", "apkver"], "n").collect()))


# ---- runs ----------------------------------------------------------------------------------

def _runs(spark, *ls, n_segments=2):
    pairs = P.accepted(P.parse_pairs(lines(spark, *ls), keep=["n"]))
    return O.group_runs(pairs, "imei", "pkg", ["n"], n_segments=n_segments)


def test_w1_w2_runs(spark):
    runs = _runs(spark, "a x", "a y", "b z", "a w")
    assert sorted((r.imei, r.pkg) for r in runs.collect()) == [("a", "w"), ("a", "x|y"), ("b", "z")]
    assert sorted(map(tuple, O.last_run(runs, "imei", "pkg").collect())) == [("a", "w"), ("b", "z")]


def test_w1_reject_does_not_break_run(spark):
    runs = _runs(spark, "a x", "bad", "a y")
    assert [(r.imei, r.pkg, r.n) for r in runs.collect()] == [("a", "x|y", 2)]


@pytest.mark.parametrize("n_segments", [1, 3, 7])
def test_w1_runs_across_segments(spark, n_segments):
    keys = ["a"] * 5 + ["b"] * 3 + ["a"] * 4 + ["c"] + ["a"] * 2
    ls = [f"{k} p{i}" for i, k in enumerate(keys)]
    runs = _runs(spark, *ls, n_segments=n_segments)
    got = sorted((r.imei, r.n, r.pkg.split("|")[0]) for r in runs.collect())
    assert got == [("a", 2, "p13"), ("a", 4, "p8"), ("a", 5, "p0"), ("b", 3, "p5"), ("c", 1, "p12")]


def test_dense_index(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    idx = O.dense_index(df, ["k"], 5).collect()
    assert sorted((r.k, r.idx) for r in idx) == [(i, i) for i in range(1000)]


# ---- aggregations ---------------------------------------------------------------------------

def test_a1_a2(spark):
    df = spark.createDataFrame(
        [("i", "p1", "n1", 999999999), ("i", "p2", "n0", 1494496411), ("j", "p", "n", 999999999), ("", "p", "n", 1494496411)],
        "imei string, pkg string, name string, itime long",
    )
    out = {r.imei: r for r in R.applist_by_imei(df).collect()}
    assert set(out) == {"i", "j"}
    assert out["i"].itime_ms == 1494496411000 and out["j"].itime_ms is None
    assert json.loads(out["i"].applist) == [{"name": "n0", "pkg": "p2"}, {"name": "n1", "pkg": "p1"}]


def test_a8_a9_empty(spark):
    empty = spark.createDataFrame([], "v double")
    assert R.row_count(empty).first().n == 0
    row = R.global_agg(empty, F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect()
    assert len(row) == 1 and row[0].n == 0 and row[0].s is None


def test_w6_page_limits(spark):
    df = spark.range(10)
    assert R.page(df, ["id"], 0, 0).count() == 10
    assert [r.id for r in R.page(df, ["id"], 3, 2).collect()] == [2, 3, 4]


# ---- cells ---------------------------------------------------------------------------------

CELLS = "rowkey string, family string, qualifier string, ts long, value string"


def test_j2_zero_fill_and_latest_version(spark):
    cells = spark.createDataFrame(
        [(X_md5("k1"), "A", "q", 1, "1.5"), (X_md5("k1"), "A", "q", 2, "2.5"), (X_md5("k1"), "A", "other", 3, "7")], CELLS
    )
    keys = spark.createDataFrame([("k1",), ("k2",), ("k1",)], "k string")
    got = dict(map(tuple, C.lookup_sum(keys, "k", cells, "A", "q").collect()))
    assert got == {"k1": 2.5, "k2": 0.0}
    got = dict(map(tuple, C.lookup_sum(keys, "k", cells, "A", None).collect()))
    assert got == {"k1": 9.5, "k2": 0.0}


def X_md5(s):
    import hashlib

    return hashlib.md5(s.encode()).hexdigest()


def test_j4_miss_and_zero(spark):
    report = spark.createDataFrame([("m1", "A", "ak", 5000, "1"), ("m2", "A", "ak", 7000, "1")], CELLS)
    offline = spark.createDataFrame([("m1ak5", "A", "c", 1, "3"), ("m1ak5", "A", "c", 2, "4")], CELLS)
    keys = spark.createDataFrame([(" m1",), ("m2",), ("m3",)], "line string")
    got = sorted(map(tuple, C.send_time_value(keys, "line", report, offline, "ak", "c").collect()))
    assert got == [("m1", 5, 7), ("m2", 7, 0)]


def test_a5_top_n(spark):
    cells = spark.createDataFrame([("r", "A", "c", t, str(t)) for t in range(1, 11)], CELLS)
    assert C.sum_versions(cells, 3).first().total == 10 + 9 + 8


# ---- scalar functions ---------------------------------------------------------------------

def test_x_config_values(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "s string")
    assert [r.v for r in df.select(X.int_or("s", 7).alias("v")).collect()] == [12, 7, 7]
    df = spark.createDataFrame([("1,x",), ("1,2,",)], "s string")
    assert [r.v for r in df.select(X.int_array_or("s", [7]).alias("v")).collect()] == [[7], [1, 2]]
    df = spark.createDataFrame([("b:1,c,a:2:3,b:9",)], "s string")
    assert df.select(X.kv_map("s").alias("m")).first().m == {"a": "2", "b": "9"}


def test_x1_x2_java_semantics(spark):
    df = spark.createDataFrame([("\t a b \r\n",)], "s string")
    r = df.select(X.java_trim("s").alias("t"), X.java_split(F.lit("a\t\tb\t\t"), "\t").alias("p")).first()
    assert r.t == "a b" and r.p == ["a", "", "b"]


# ---- time keys ----------------------------------------------------------------------------

def test_t2_t3_t4_t6(spark):
    df = spark.createDataFrame([("201705",), ("20170511",), ("2017051117",), ("2017051",), ("20170230",)], "k string")
    got = df.select("k", TK.grain_of("k").alias("g"), TK.key_is_valid("k", TK.grain_of("k")).alias("ok")).collect()
    assert [(r.g, r.ok) for r in got] == [("month", True), ("day", True), ("hour", True), (None, False), ("day", False)]
    ms = spark.createDataFrame([("20170511",), ("20171301",)], "d string").select(TK.day_to_ms("d").alias("ms")).collect()
    assert [r.ms for r in ms] == [1494432000000, 0]
    d = spark.sql("select date'2001-09-28' d").select(TK.add_interval("d", F.lit(1.5), "day").alias("x")).first().x
    assert str(d) == "2001-09-29"
    with pytest.raises(Exception):
        spark.createDataFrame([("2017051",)], "k string").select(TK.grain_of("k", strict=True)).collect()


# ---- geo ----------------------------------------------------------------------------------

def test_g7_edges_and_g3_identity(spark):
    df = spark.createDataFrame([(72.004, 0.8293), (137.8347, 55.8271), (0.0, 0.0)], "lng double, lat double")
    out = df.select(G.out_of_china("lng", "lat").alias("o"), G.wgs84_to_gcj02("lng", "lat").alias("p")).collect()
    assert [r.o for r in out] == [False, False, True]
    assert (out[2].p.lng, out[2].p.lat) == (0.0, 0.0)


def test_geo_round_trips(spark):
    df = spark.createDataFrame([(116.404 + i / 10, 39.915 + i / 20) for i in range(10)], "lng double, lat double")
    bd = df.select(G.gcj02_to_bd09("lng", "lat").alias("b"), "lng", "lat")
    back = bd.select(G.bd09_to_gcj02("b.lng", "b.lat").alias("g"), "lng", "lat").collect()
    assert all(abs(r.g.lng - r.lng) < 1e-5 and abs(r.g.lat - r.lat) < 1e-5 for r in back)
    gcj = df.select(G.wgs84_to_gcj02("lng", "lat").alias("g"), "lng", "lat")
    back = gcj.select(G.gcj02_to_wgs84("g.lng", "g.lat").alias("w"), "lng", "lat").collect()
    assert all(abs(r.w.lng - r.lng) < 1e-4 and abs(r.w.lat - r.lat) < 1e-4 for r in back)


# ---- alerts -------------------------------------------------------------------------------

def test_o1_threshold_and_limit(spark):
    jobs = spark.createDataFrame(
        [("c", "c - s1 x", "RUNNING", 3659), ("c", "c - s2 x", "RUNNING", 3660), ("c", "c - s3 x", "FINISHED", 9999)],
        "cube string, name string, job_status string, duration long",
    )
    assert [r.message for r in AL.job_alerts(jobs).collect()] == [" ['c_s2 cost 61 min']"]
    many = spark.createDataFrame([("c", "e" * 50 + str(i), "ERROR", 0) for i in range(20)], "cube string, name string, job_status string, duration long")
    msg = AL.job_alerts(many).first().message
    assert len(msg) == 300 and msg.startswith("Error-Cube:['")
    none = spark.createDataFrame([("c", "c - s x", "FINISHED", 1)], "cube string, name string, job_status string, duration long")
    assert AL.job_alerts(none).count() == 0


def test_time_functions_ignore_session_zone(spark):
    """Keys and epoch values do not move with the session zone, also inside a DST gap."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:15.123' t")
        r = df.select(TK.ms_of_ntz("t").alias("ms"), TK.nominal_parts("t").alias("p"), TK.ntz_key("t", "hour").alias("h")).first()
        assert r.ms == 1710037815123 and r.p.yyyymmddhh == "2024031002" and r.h == "2024031002"
        keys = spark.createDataFrame([("1494496411",)], "t string").select(TK.time_keys("t").alias("k")).first().k
        assert tuple(keys) == (201705, 20170511, 2017051117)
        ms = spark.createDataFrame([("20170511",)], "d string").select(TK.day_to_ms("d").alias("ms")).first().ms
        assert ms == 1494432000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_c5_cuboid_stats_exact_and_sketched(spark):
    from pushlake.operators import cube as CB

    rows = [(f"a{i % 7}", f"b{i % 5}", f"c{i % 3}") for i in range(500)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    exact = {r.gid: r.rows for r in CB.cuboid_stats(df, ["a", "b", "c"], exact=True).collect()}
    approx = {r.gid: r.rows_estimate for r in CB.cuboid_stats(df, ["a", "b", "c"], exact=False).collect()}
    assert exact[0] == 105 and exact[7] == 1 and set(exact) == set(approx)
    assert all(abs(approx[g] - exact[g]) <= max(2, 0.1 * exact[g]) for g in exact)


def test_c11_query_cube_fallback(spark):
    from pushlake.operators import cube as CB

    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "p", 4)], "a string, b string, v int")
    cube = CB.build_cube(df, ["a"], {"v": F.sum("v")})
    assert sorted(map(tuple, CB.query_cube(cube, ["a"], ["a"], "v").collect())) == [("x", 3), ("y", 4)]
    with pytest.raises(ValueError):
        CB.query_cube(cube, ["a"], ["b"], "v")
    got = CB.query_cube(cube, ["a"], ["b"], "v", base=df, fallback=True)
    assert sorted(map(tuple, got.collect())) == [("p", 5), ("q", 2)]


def test_w1_text_runs_across_many_splits(spark, tmp_path):
    """Runs read from text files cut into many small splits (segments = splits)."""
    from pushlake.sources.readers import read_lines

    keys = (["a"] * 40 + ["b"] * 7 + ["a"] * 25 + ["c"] * 60 + ["a"] * 3) * 3
    path = str(tmp_path / "pairs")
    spark.createDataFrame([(i, f"{k} p{i}") for i, k in enumerate(keys)], "n long, line string") \
        .repartitionByRange(3, "n").sortWithinPartitions("n").select("line").write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        lines = read_lines(spark, path)
        assert lines.select("_file", "_block").distinct().count() > 10
        pairs = P.accepted(P.parse_pairs(lines, keep=["_file", "_block", "_pos"]))
        runs = O.group_runs(pairs, "imei", "pkg", ["_file", "_block", "_pos"], segment=["_file", "_block"])
        got = sorted((r.imei, r.n, r.pkg.split("|")[0]) for r in runs.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expect, i = [], 0
    while i < len(keys):
        j = i
        while j < len(keys) and keys[j] == keys[i]:
            j += 1
        expect.append((keys[i], j - i, f"p{i}"))
        i = j
    assert got == sorted(expect)


@pytest.mark.parametrize("files_per_trigger", [1, 3])
def test_r2_stream_equals_batch(spark, tmp_path, files_per_trigger):
    """Draining a file stream gives the batch transform's rows, whatever the
    batch size; a restart from the checkpoint adds nothing."""
    from pushlake.streaming import consume as ST

    bodies = [_ev(msg_id=i, uid=i % 7) for i in range(2, 60)] + ['{"rows":[' + _ev(msg_id=100) + "," + _ev(msg_id=1) + "]}", "junk"]
    src = str(tmp_path / "src")
    spark.createDataFrame([(b,) for b in bodies], "value string").repartition(5).write.parquet(src)
    batch = sorted(map(tuple, ST.push_records(spark.read.parquet(src)).collect()))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = lambda: spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_trigger).parquet(src)
    ST.drain(stream(), ST.push_records, ST.committed_writer(out, ck), ck).awaitTermination()
    ST.drain(stream(), ST.push_records, ST.committed_writer(out, ck), ck).awaitTermination()
    got = sorted(map(tuple, ST.read_committed(spark, out).select(*P.PUSH_COLUMNS).collect()))
    assert got == batch and len(got) == 59


def test_r1_new_checkpoint_adds_and_replays_do_not(spark, tmp_path):
    """A second checkpoint adds to the output folder; a batch that is written
    twice counts once; one without its log row is not read; refusing is an option."""
    from pushlake.streaming import consume as ST

    out = str(tmp_path / "out")
    for wave in ("a", "b"):
        src, ck = str(tmp_path / f"src-{wave}"), str(tmp_path / f"ck-{wave}")
        spark.createDataFrame([(f"{wave}{i}",) for i in range(4)], "value string").repartition(2).write.parquet(src)
        write = ST.committed_writer(out, ck)

        def twice(batch, batch_id):
            write(batch, batch_id)
            write(batch, batch_id)

        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(src)
        ST.drain(stream, lambda s: s, twice, ck).awaitTermination()
    values = lambda: sorted(r.value for r in ST.read_committed(spark, out, "value string").collect())
    want = [f"{w}{i}" for w in "ab" for i in range(4)]
    assert values() == want
    spark.createDataFrame([("cut off",)], "value string").write.parquet(f"{out}/query_id=x/batch_id=0")
    assert values() == want
    with pytest.raises(RuntimeError):
        ST.committed_writer(out, str(tmp_path / "ck-b"), on_new_query="refuse")(spark.createDataFrame([("no",)], "value string"), 9)
    assert ST.compact(spark, out) >= 4 and values() == want and ST.compact(spark, out) == 0
    # a replay of a compacted batch stays covered
    ST.committed_writer(out, str(tmp_path / "ck-b"))(spark.createDataFrame([("b0",)], "value string"), 0)
    assert values() == want


def test_read_committed_without_rows(spark, tmp_path):
    from pushlake.streaming import consume as ST

    assert ST.read_committed(spark, str(tmp_path / "none"), "value string").count() == 0
    with pytest.raises(ValueError):
        ST.read_committed(spark, str(tmp_path / "none"))


def test_r5_hour_over_several_batches(spark, tmp_path):
    """An hour split over files and micro-batches has one row, of all its records; a
    second start on the same checkpoint adds only new files' records, and a batch's
    increments are those of its own lines."""
    from pushlake.operators.rollup import hour_day_stats
    from pushlake.plans import fixtures as fx
    from pushlake.streaming import consume as ST
    from tests.conftest import SF_SMALL

    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    lines = fx.http_lines(spark, SF_SMALL).select(F.col("line").alias("value"))
    distinct = {"apps": "appkey", "ids": "msgid"}
    for wave in (0, 1):  # the second wave repeats some lines of the first
        part = lines if wave == 0 else lines.filter(F.xxhash64("value") % 3 == 0)
        part.repartition(2).write.mode("append").text(src)
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(src).select(F.col("value").alias("line"))
        ST.drain_hours(stream, out, ck, "n", distinct).awaitTermination()
    recs = P.accepted(P.parse_http_api(spark.read.text(src).select(F.col("value").alias("line")), tz="Asia/Shanghai"))
    aggs = [F.count(F.lit(1)).alias("n"), F.countDistinct("appkey").alias("apps"), F.countDistinct("msgid").alias("ids")]
    cols = ["grain", "iday", "ihour", "n", "apps", "ids"]
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    want = rows(hour_day_stats(recs, "iday", "ihour", aggs))
    assert rows(ST.hour_counts(spark, out, "n", distinct)) == want
    # the repeated lines brought no new values
    late = [r.batch_id for r in ST.commits(spark, out).collect() if r.batch_id >= 2]
    fresh = ST.read_committed(spark, out, ST.INCREMENT_SCHEMA).filter(F.col("batch_id").isin(late) & (F.col("metric") != "n"))
    assert len(late) == 2 and fresh.count() == 0
    ST.compact(spark, out, ST.add_increments)
    assert rows(ST.hour_counts(spark, out, "n", distinct)) == want



@pytest.mark.parametrize("salted", [False, True])
def test_top_n_versions_salted_and_plain(spark, salted):
    rows = [("hot", "A", "c", t, str(t % 97)) for t in range(3000)] + [("cold", "A", "c", t, "1") for t in range(5)]
    cells = spark.createDataFrame(rows, CELLS).repartition(7)
    got = {r.rowkey: r.total for r in C.sum_versions(cells, 100, salted=salted).collect()}
    assert got == {"hot": sum(t % 97 for t in range(2900, 3000)), "cold": 5}
    top = C.newest_versions(cells, 3, salted=salted)
    assert sorted((r.rowkey, r.ts) for r in top.collect()) == [("cold", 2), ("cold", 3), ("cold", 4), ("hot", 2997), ("hot", 2998), ("hot", 2999)]


@pytest.mark.parametrize("by_layer", [False, True])
def test_cube_distinct_sketches_roll_up(spark, by_layer):
    from pushlake.operators import cube as CB

    rows = [(f"a{i % 3}", f"b{i % 4}", i % 50, 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "a string, b string, u int, v double")
    cube = CB.build_cube(df, ["a", "b"], {"v": F.sum("v")}, by_layer=by_layer, distinct={"users": "u"})
    est = {r.gid: r.e for r in cube.filter(F.col("gid") == 3).select("gid", F.hll_sketch_estimate("users").alias("e")).collect()}
    assert est == {3: 50}
    per_a = {r.a: r.e for r in cube.filter(F.col("gid") == 1).select("a", F.hll_sketch_estimate("users").alias("e")).collect()}
    exact = {f"a{k}": len({i % 50 for i in range(600) if i % 3 == k}) for k in range(3)}
    assert per_a == exact


def test_x8_form_encode(spark):
    df = spark.sql("select map('b', 'x y&z', 'a', cast(null as string), 'c', '1') m")
    r = df.select(X.form_encode("m").alias("f")).first().f
    assert r == "a=null&b=x+y%26z&c=1&"
    assert df.select(X.form_decode(F.lit("x+y%26z")).alias("d")).first().d == "x y&z"


def test_x12_x13_absent_text(spark):
    df = spark.createDataFrame([(None,), ("a,TRUE,",)], "s string")
    got = df.select(X.bool_array("s", [True]).alias("b"), X.string_array("s", ["d"]).alias("a"), X.kv_map("s").alias("m")).collect()
    assert (got[0].b, got[0].a, got[0].m) == ([True], ["d"], {})
    assert (got[1].b, got[1].a, got[1].m) == ([False, True], ["a", "TRUE"], {})


def test_range_segments_without_exchange_reuse(spark):
    """Runs and dense indexes stay right when the session disables exchange reuse."""
    old = spark.conf.get("spark.sql.exchange.reuse")
    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        keys = ["a"] * 30 + ["b"] * 11 + ["a"] * 20
        pairs = spark.createDataFrame([(i, k, f"p{i}") for i, k in enumerate(keys)], "n long, imei string, pkg string")
        runs = O.group_runs(pairs, "imei", "pkg", ["n"], n_segments=6)
        assert sorted((r.imei, r.n) for r in runs.collect()) == [("a", 20), ("a", 30), ("b", 11)]
        df = spark.range(0, 5000).select((F.col("id") * 13 % 5000).alias("k"))
        assert all(r.k == r.idx for r in O.dense_index(df, ["k"], 7).collect())
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_w7_first_n_salted_ascending(spark):
    rows = [("hot", f"j{i:05d}") for i in range(2500)] + [("cold", f"j{i:05d}") for i in range(3)]
    df = spark.createDataFrame(rows, "cube string, name string").repartition(5)
    got = R.first_n_per_group(df, ["cube"], "name", 1000)
    names = sorted((r.cube, r.name) for r in got.collect())
    assert names == sorted([("cold", f"j{i:05d}") for i in range(3)] + [("hot", f"j{i:05d}") for i in range(1000)])


def test_a1_parts_for_huge_lists(spark):
    rows = [("big", f"p{i:04d}", f"n{i:04d}", 1494496411) for i in range(2000)] + [("small", "p", "n", 5)]
    df = spark.createDataFrame(rows, "imei string, pkg string, name string, itime long")
    out = R.applist_by_imei(df, max_items=300).collect()
    big = [r for r in out if r.imei == "big"]
    assert len(big) == big[0].parts == 7 and all(r.itime_ms == 1494496411000 for r in big)
    items = [a for r in big for a in json.loads(r.applist)]
    assert sorted(a["pkg"] for a in items) == [f"p{i:04d}" for i in range(2000)]
    assert max(len(json.loads(r.applist)) for r in big) < 600
    small = [r for r in out if r.imei == "small"]
    assert len(small) == 1 and small[0].part == 0 and small[0].itime_ms is None
    assert json.loads(small[0].applist) == [{"name": "n", "pkg": "p"}]


def test_w1_pieces_rebuild_runs(spark):
    keys = ["a"] * 40 + ["b"] * 3 + ["a"] * 9
    pairs = spark.createDataFrame([(i, k, f"p{i}") for i, k in enumerate(keys)], "n long, imei string, pkg string")
    pieces = O.group_runs(pairs, "imei", "pkg", ["n"], n_segments=5, pieces=True).collect()
    whole = {}
    for r in sorted(pieces, key=lambda r: (r.imei, r.run_start.n, r.piece_start.n)):
        whole.setdefault((r.imei, r.run_start.n), []).append(r.pkg)
    assert {k: "|".join(v) for k, v in whole.items()} == {
        ("a", 0): "|".join(f"p{i}" for i in range(40)), ("b", 40): "p40|p41|p42", ("a", 43): "|".join(f"p{i}" for i in range(43, 52))}
    assert len(pieces) > 3


def test_hour_day_stats_sketched_matches_exact(spark):
    rows = [(20170511, 2017051100 + h, f"k{i % 7}", i) for h in range(24) for i in range(h * 40, h * 40 + 40 + h)]
    df = spark.createDataFrame(rows, "iday int, ihour int, appkey string, msgid long")
    exact = {(r.grain, r.ihour): (r.n, r.a, r.m) for r in R.hour_day_stats(
        df, "iday", "ihour", [F.count(F.lit(1)).alias("n"), F.countDistinct("appkey").alias("a"), F.countDistinct("msgid").alias("m")]).collect()}
    est = {(r.grain, r.ihour): (r.n, r.a, r.m) for r in R.hour_day_stats_sketched(df, "iday", "ihour", {"a": "appkey", "m": "msgid"}).collect()}
    assert set(est) == set(exact)
    for k, (n, a, m) in exact.items():
        assert est[k][0] == n and est[k][1] == a and abs(est[k][2] - m) <= 0.05 * m


def test_hour_day_stats_extra_keys(spark):
    df = spark.createDataFrame([("k1", 20170511, 2017051101), ("k1", 20170511, 2017051102), ("k2", 20170511, 2017051101)],
                               "appkey string, iday int, ihour int")
    out = R.hour_day_stats(df, "iday", "ihour", [F.count(F.lit(1)).alias("n")], extra_keys=["appkey"])
    got = sorted((r.appkey, r.grain, r.ihour, r.n) for r in out.collect())
    assert got == [("k1", "day", None, 2), ("k1", "hour", 2017051101, 1), ("k1", "hour", 2017051102, 1),
                   ("k2", "day", None, 1), ("k2", "hour", 2017051101, 1)]


def test_dense_index_of_wide_rows(spark):
    """Positions of rows with columns beyond the order key, above the sampling size."""
    df = spark.range(400_000).select(F.xxhash64("id").alias("k"), F.col("id").alias("wide")).repartition(7)
    idx = O.dense_index(df, ["k"], 16)
    ranked = idx.select("idx", F.lead("idx").over(Window.orderBy("k")).alias("next"))
    assert ranked.filter("next is not null and next <> idx + 1").count() == 0
    assert idx.agg(F.min("idx"), F.max("idx"), F.countDistinct("idx"), F.countDistinct("wide")).first()[:] == (0, 399_999, 400_000, 400_000)


def test_alerts_beyond_a_page_and_without_text(spark):
    schema = "cube string, name string, job_status string, duration long"
    last = [("c", f"c - s{i:05d} x", "FINISHED", 1) for i in range(1000)] + [("c", "c - z x", "ERROR", 1)]
    assert AL.job_alerts(spark.createDataFrame(last, schema)).first().message == "Error-Cube:['c - z x']  "
    short = spark.createDataFrame([("a", f"n{i}", "RUNNING", 9999) for i in range(200)] + [("b", "b - s x", "RUNNING", 7200)], schema)
    assert AL.job_alerts(short).first().message == " ['b_s cost 120 min']"
    assert AL.alert_rejects(short).count() == 200


def test_cuboid_stats_of_seven_dimensions_are_exact(spark):
    df = spark.range(3000).select(*[(F.col("id") % (2 + i)).alias(f"d{i}") for i in range(7)])
    dims = df.columns
    got = {r.dims: r.rows for r in CB.cuboid_stats(df, dims).collect()}
    assert len(got) == 128
    assert got["d0,d1,d2,d3,d4,d5,d6"] == df.distinct().count() and got["d5,d6"] == df.select("d5", "d6").distinct().count()


def test_replace_into_keeps_the_last_row_of_a_key(spark):
    table = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, t int")
    rows = spark.createDataFrame([(1, "z", 1), (1, "c", 2), (3, "d", 1)], "k int, v string, t int")
    from pushlake.operators import merge

    assert sorted(map(tuple, merge.replace_into(table, rows, ["k"], order=["t"]).collect())) == [(1, "c", 2), (2, "b", 0), (3, "d", 1)]


def test_rows_that_are_no_array_fail_the_message(spark):
    bodies = ['{"rows": 5}', '{"rows": "x"}', '{"rows": {"a": 1}}', '{"rows": null, "a": 1}', '{"a": 1}', '{"rows": [{"a": 1}, {"a": 2}]}', '{"rows": []}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert P.explode_rows(df).count() == 4
    assert {r.body for r in P.bad_envelopes(df).collect()} == set(bodies[:3])


def test_o1_items_print_as_python_prints_them(spark):
    from pushlake.operators.alerts import _py_list

    items = ["plain", "it's", 'a "b"', 'it\'s "b"', "back\\slash", "line\nbreak\ttab", "", "é"]
    df = spark.createDataFrame([(items,)], "items array<string>")
    assert df.select(_py_list(F.col("items")).alias("t")).first().t == str(items)


def test_w1_segments_grow_with_the_input():
    from pushlake.operators import ordered as O

    assert O.segment_count(0, 8) == 8
    assert O.segment_count(100 << 40, 8) == (100 << 40) // O.SEGMENT_BYTES


def test_w1_w2_segments_inside_a_file_and_pieces(spark, tmp_path):
    """A gzip file is one split; its runs are found over segments of its lines, and the
    last run of a key comes as pieces."""
    import gzip
    import os

    from pushlake.operators import ordered as O
    from pushlake.sources.readers import read_lines

    keys = ["a"] * 7 + ["b"] * 3 + ["a"] * 25 + ["c"]
    os.makedirs(tmp_path / "in")
    with gzip.open(tmp_path / "in" / "part.gz", "wt") as f:
        f.writelines(f"{k} p{i}\n" for i, k in enumerate(keys))
    pairs = P.accepted(P.parse_pairs(read_lines(spark, str(tmp_path / "in")), keep=["_file", "_block", "_pos"]))
    assert pairs.select("_file", "_block").distinct().count() == 1
    pairs, segment = O.line_segments(pairs, size=5)
    order = ["_file", "_block", "_pos"]
    runs = O.group_runs(pairs, "imei", "pkg", order, segment=segment)
    assert {r.imei: r.pkg for r in O.last_run(runs, "imei", "pkg").collect()} == {
        "a": "|".join(f"p{i}" for i in range(10, 35)), "b": "p7|p8|p9", "c": "p35",
    }
    pieces = O.last_run_pieces(O.group_runs(pairs, "imei", "pkg", order, segment=segment, pieces=True), "imei", "pkg").collect()
    assert max(len(r.pkg.split("|")) for r in pieces) == 5
    last = sorted((r.part, r.pkg) for r in pieces if r.imei == "a")
    assert [p for p, _ in last] == list(range(5)) and "|".join(v for _, v in last) == "|".join(f"p{i}" for i in range(10, 35))


def test_heavy_cells_are_cut_before_they_are_ranked(spark):
    """Only rows near the newest n reach the salted ranking; outliers and null times cost a step, no rows."""
    times = [*range(5000), 1 << 62, -(1 << 62), None]
    rows = [(k, "A", "c", t, "1" if t is None else str(t % 97)) for k in ("hot", None) for t in times] + [("cold", "A", "c", 1, "7")]
    cells = spark.createDataFrame(rows, CELLS).repartition(7)
    heavy = cells.groupBy(*C.CELL_KEY).agg(F.count(F.lit(1)).alias("_c"), *C._extent(C._place(cells, "ts", False))).filter("_c > 300").drop("_c")
    left = C._near_top(cells, C.CELL_KEY, "ts", 300, False, heavy)
    assert 600 <= left.count() <= 620
    newest = sum(t % 97 for t in [1 << 62, *range(4701, 5000)])
    assert {r.rowkey: r.total for r in C.sum_versions(cells, 300, salted=True).collect()} == {"hot": newest, None: newest, "cold": 7}
    first = C.top_n_per_group(cells, C.CELL_KEY, "ts", 300, salted=True, ascending=True).filter("rowkey = 'hot'")
    assert sorted(r.ts for r in first.filter("ts is not null").collect()) == [-(1 << 62), *range(298)] and first.count() == 300
