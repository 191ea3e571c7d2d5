"""End-to-end jobs on small files."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from pushlake import jobs

TAB = "\t"


def write_lines(spark, path, lines):
    spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "n long, line string") \
        .repartitionByRange(2, "n").sortWithinPartitions("n").select("line").write.text(path)
    return path


def test_http_api_to_orc(spark, tmp_path):
    src = write_lines(spark, str(tmp_path / "in"), [
        TAB.join(["k", "5", "1494496411", "t", "r", "0", "a"]), "bad", TAB.join(["k", "6", "1494496411800", "t", "r", "0", "i"])])
    counts = jobs.http_api_to_orc(spark, src, str(tmp_path / "orc"), rejects=str(tmp_path / "rej"))
    assert counts == {"total": 3, "accepted": 2, "rejected": 1}
    rows = spark.read.orc(str(tmp_path / "orc")).orderBy("msgid").collect()
    assert [(r.msgid, r.ihour) for r in rows] == [(5, 2017051117), (6, 2017051117)]
    assert [r.value for r in spark.read.text(str(tmp_path / "rej")).collect()] == ["fields\tbad"]


def test_lines_to_parquet(spark, tmp_path):
    src = write_lines(spark, str(tmp_path / "in"), ["a\t1", "b\t2"])
    parser = lambda df: df.select(F.split("line", "\t")[0].alias("k"), F.split("line", "\t")[1].cast("short").alias("v"))
    jobs.lines_to_parquet(spark, src, str(tmp_path / "out"), parser)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.schema["v"].dataType.simpleString() == "int" and out.count() == 2


def test_applist_orc_to_cells(spark, tmp_path):
    orc = str(tmp_path / "orc")
    spark.createDataFrame([("i", "p1", "n1", 1494496411), ("i", "p0", "n0", 5), ("j", "p", "n", 5)],
                          "imei string, pkg string, name string, itime long").write.orc(orc)
    jobs.applist_orc_to_cells(spark, orc, str(tmp_path / "cells"), job_ts=42)
    got = {r.rowkey: r for r in spark.read.parquet(str(tmp_path / "cells")).collect()}
    assert (got["i"].family, got["i"].qualifier, got["i"].ts) == ("C", "app", 1494496411000)
    assert json.loads(got["i"].value) == [{"name": "n0", "pkg": "p0"}, {"name": "n1", "pkg": "p1"}]
    assert got["j"].ts == 42


def test_applist_orc_to_cells_in_parts(spark, tmp_path):
    """A long list is written as several cells that hold every app once."""
    orc = str(tmp_path / "orc")
    spark.createDataFrame([("i", f"p{k}", "n", 1494496411) for k in range(500)] + [("j", "p", "n", 5)],
                          "imei string, pkg string, name string, itime long").write.orc(orc)
    jobs.applist_orc_to_cells(spark, orc, str(tmp_path / "cells"), job_ts=42, max_items=100)
    got = spark.read.parquet(str(tmp_path / "cells")).collect()
    parts = [json.loads(r.value) for r in got if r.rowkey == "i"]
    assert sorted(r.qualifier for r in got) == ["app", *[f"app.{k}" for k in range(5)]]
    assert max(map(len, parts)) < 200 and sorted(a["pkg"] for p in parts for a in p) == sorted(f"p{k}" for k in range(500))


def test_profile_to_sorted_cells(spark, tmp_path):
    src = write_lines(spark, str(tmp_path / "in"), ['{"imei": "b", "device_info": {"x": 1}}', '{"imei": "a", "device_info": "m"}', "junk"])
    jobs.profile_to_sorted_cells(spark, src, str(tmp_path / "out"), "device_info", "20170511", 2)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("rowkey").collect()
    assert [(r.rowkey, r.qualifier, r.ts, r.value) for r in rows] == [("a", "devinfo", 1494432000000, "m"), ("b", "devinfo", 1494432000000, '{"x":1}')]


def test_pairs_to_index(spark, tmp_path):
    src = write_lines(spark, str(tmp_path / "in"), ["a x", "a y", "bad", "b z", "a w", "a v"])
    out = str(tmp_path / "docs")
    os.makedirs(out)

    def send(docs):
        import uuid

        with open(os.path.join(out, uuid.uuid4().hex), "w") as f:
            json.dump(docs, f)

    jobs.pairs_to_index(spark, src, send, 7)
    docs = sorted((d["id"], d["pkg"]) for f in os.listdir(out) for d in json.load(open(os.path.join(out, f))))
    assert docs == [("a", "w|v"), ("b", "z")]


def test_merge_versions(spark, tmp_path):
    docs = spark.createDataFrame([("u", "a", "1.0", "s", "c")], "uid string, appkey string, apkver string, sdkver string, channel string")
    src = write_lines(spark, str(tmp_path / "in"), ["u\tb", "v\tk\t2.0", "u\tk2\t3.0"])
    got = {r.uid: r for r in jobs.merge_versions(spark, docs, src, "apkver").collect()}
    assert (got["u"].appkey, got["u"].apkver, got["u"].sdkver) == ("k2", "3.0", "s")
    assert (got["v"].appkey, got["v"].apkver) == ("k", "2.0")


def test_lookups(spark, tmp_path):
    cells = "rowkey string, family string, qualifier string, ts long, value string"
    report = spark.createDataFrame([("m1", "A", "ak", 5000, "1")], cells)
    offline = spark.createDataFrame([("m1ak5", "A", "c", 1, "3")], cells)
    keys = write_lines(spark, str(tmp_path / "keys"), [" m1", "m2"])
    assert [tuple(r) for r in jobs.send_time_values(spark, keys, report, offline, "ak", "c").collect()] == [("m1", 5, 3)]
    users = spark.createDataFrame([("1u", "u", "appkey", 1, "k")], cells)
    uids = write_lines(spark, str(tmp_path / "uids"), ["u1", "u9"])
    assert [(r.uid, r.appkey) for r in jobs.user_dims(spark, uids, users).collect()] == [("u1", "k")]


def test_cube_job_alert(spark):
    jobs_df = spark.createDataFrame([("c", "c - s2 x", "RUNNING", 3660), ("c", "c - e x", "ERROR", 1)],
                                    "cube string, name string, job_status string, duration long")
    assert jobs.cube_job_alert(jobs_df) == "Error-Cube:['c - e x']   ['c_s2 cost 61 min']"
    assert jobs.cube_job_alert(jobs_df.filter("job_status = 'none'")) is None


def test_hourly_stats(spark, tmp_path):
    base = str(tmp_path / "in")
    line = TAB.join(["k", "5", "1494496411", "t", "r", "0", "a"])
    spark.createDataFrame([(line,), (line.replace("\t5\t", "\t6\t"),)], "line string").write.text(os.path.join(base, "2017/05/11/2017051109"))
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.hourly_stats(spark, base, dt.datetime(2017, 5, 11, 0), dt.datetime(2017, 5, 12, 0), out, absent="skip")
    got = sorted((r.grain, r.ihour, r.n_msgs, r.n_msgids) for r in spark.read.parquet(out).collect())
    assert got == [("day", None, 2, 2), ("hour", 2017051117, 2, 2)]


def test_push_events_stream(spark, tmp_path):
    src = str(tmp_path / "msgs")
    body = json.dumps({"msg_id": 9, "step": "seg-to-apns", "appkey": " k ", "itime": 5, "uid": 3})
    spark.createDataFrame([(body,), ("junk",), ('{"rows":[' + body.replace("9", "10") + "]}",)], "value string").write.parquet(src)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(src)
    q = jobs.push_events_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck"), 1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == ["k\u0001null\u000110\u00013\u00015", "k\u0001null\u00019\u00013\u00015"]


def test_cli_merge_versions(spark, tmp_path):
    docs = str(tmp_path / "docs")
    spark.createDataFrame([("u", "a", "1.0", "s", "c")], "uid string, appkey string, apkver string, sdkver string, channel string").write.parquet(docs)
    src = write_lines(spark, str(tmp_path / "in"), ["u\t9.9"])
    jobs.main(["merge-versions", docs, src, str(tmp_path / "out"), "--flag", "apkver"])
    r = spark.read.parquet(str(tmp_path / "out")).first()
    assert (r.uid, r.appkey, r.apkver, r.sdkver) == ("u", None, "9.9", "s")
