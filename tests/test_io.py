"""Sources, sinks and job templates (S, K, E, A10, C12 rules)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pushlake.operators import cube as CB
from pushlake.operators import parse as P
from pushlake.operators import rollup as R
from pushlake.sources import readers as S
from pushlake.sources import sinks as K


def test_k7_batches_bounded_and_complete(spark, tmp_path):
    out = str(tmp_path / "batches")
    os.makedirs(out)

    def send(docs):
        import uuid

        with open(os.path.join(out, uuid.uuid4().hex), "w") as f:
            json.dump([d["id"] for d in docs], f)
        return ["bad-id"] if any(d["id"] == "0" for d in docs) else None

    df = spark.range(7000).select(F.col("id").cast("string").alias("id"), F.lit("p").alias("pkg"), F.lit(1).alias("itime")).repartition(3)
    failures = str(tmp_path / "failures")
    assert K.write_in_batches(df, send, failures, batch=3000) == 1
    assert [tuple(r) for r in spark.read.parquet(failures).collect()] == [("bad-id", "failed")]
    batches = [json.load(open(os.path.join(out, f))) for f in os.listdir(out)]
    assert all(len(b) <= 3000 for b in batches)
    assert sorted(i for b in batches for i in b) == sorted(str(i) for i in range(7000))


def test_k2_typed_parquet_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "a")], "b byte, s short, t string")
    typed = K.typed_for_parquet(df)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["int", "int", "string"]
    K.to_parquet_typed(df, str(tmp_path / "ok"))
    assert spark.read.parquet(str(tmp_path / "ok")).first().s == 2
    with pytest.raises(TypeError):
        K.typed_for_parquet(spark.createDataFrame([(1.5,)], "d decimal(10,2)"))
    with pytest.raises(Exception):
        K.to_parquet_typed(spark.createDataFrame([(None,)], "t string"), str(tmp_path / "null"))


def test_s4_hour_paths_and_missing_hours(spark, tmp_path):
    base = str(tmp_path / "in")
    paths = S.hourly_paths(base, dt.datetime(2017, 5, 11, 22, 30), dt.datetime(2017, 5, 12, 1))
    assert [p[len(base) + 1:] for p in paths] == [
        "2017/05/11/2017051122", "2017/05/11/2017051123", "2017/05/12/2017051200"]
    spark.createDataFrame([("a",)], "line string").write.text(paths[1])
    with pytest.raises(FileNotFoundError, match="absent"):
        S.read_hours(spark, base, dt.datetime(2017, 5, 11, 22), dt.datetime(2017, 5, 12, 1))
    lines = S.read_hours(spark, base, dt.datetime(2017, 5, 11, 22), dt.datetime(2017, 5, 12, 1), absent="skip")
    assert [r.line for r in lines.collect()] == ["a"]
    with pytest.raises(FileNotFoundError):
        S.read_hours(spark, base, dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 2))


def test_a10_observed_counts(spark):
    lines = spark.createDataFrame([("k\t1\t1494496411\tt\tr\t0\ta",), ("bad",), ("k\tx\t1\tt\tr\t0\ta",)], "line string")
    obs = Observation("t")
    seen = R.observe_counts(P.parse_http_api(lines), obs)
    assert P.accepted(seen).count() == 1
    assert obs.get == {"total": 3, "accepted": 1, "rejected": 2}


def test_e1_template_and_null_sql(spark):
    calls = []
    out = S.run_stats(spark, mk_sql=lambda: "SELECT 1 AS x", prepare=lambda: calls.append("prep"), save=lambda d: calls.append(d.count()))
    assert out.first().x == 1 and calls == ["prep", 1]
    with pytest.raises(ValueError):
        S.run_stats(spark, mk_sql=lambda: None)


def test_c12_only_edge_segments_drop(spark, tmp_path):
    path = str(tmp_path / "cube")
    rows = spark.createDataFrame([("a", 1)], "d string, n long")
    for y in (2015, 2016, 2017):
        CB.add_segment(rows, path, f"{y}0101000000", f"{y + 1}0101000000")
    assert len(CB.list_segments(spark, path)) == 3
    with pytest.raises(ValueError):
        CB.drop_segment(spark, path, "20160101000000", "20170101000000")
    CB.drop_segment(spark, path, "20150101000000", "20160101000000")
    assert CB.list_segments(spark, path) == ["20160101000000_20170101000000", "20170101000000_20180101000000"]


def test_k9_rerun_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    K.to_day_partitions(spark.createDataFrame([(1, "201705", "10"), (2, "201705", "11")], "n long, month string, day string"), path)
    K.to_day_partitions(spark.createDataFrame([(5, "201705", "11")], "n long, month string, day string"), path)
    got = sorted(map(tuple, spark.read.schema("n long, month string, day string").parquet(path).collect()))
    assert got == [(1, "201705", "10"), (5, "201705", "11")]


def test_s3_s5_s9_readers(spark, tmp_path):
    orc = str(tmp_path / "orc")
    spark.createDataFrame([("i", "p", "n", 1), ("j", None, "n", 2)], "imei string, pkg string, name string, itime long").write.orc(orc)
    assert [r.imei for r in S.read_applist_orc(spark, orc).collect()] == ["i"]
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert tuple(S.scan_two_as_text(df).first()) == ("1", "null")
    keys = str(tmp_path / "keys")
    spark.createDataFrame([(" k1\t",), ("k1",), ("",)], "v string").write.text(keys)
    assert sorted(r.key for r in S.read_keys(spark, keys, trim=True).collect()) == ["", "k1", "k1"]


def test_k8_total_order_splits_hot_rowkey(spark, tmp_path):
    rows = [("hot", "A", f"q{i % 50}", i, "v") for i in range(4000)] + [(f"k{i:03d}", "A", "q", i, "v") for i in range(200)]
    cells = spark.createDataFrame(rows, "rowkey string, family string, qualifier string, ts long, value string")
    parts = K.sorted_cells(cells, 8).rdd.glom().map(lambda p: [(r.rowkey, r.family, r.qualifier, -r.ts) for r in p]).collect()
    flat = [r for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == 4200
    assert sum(1 for p in parts if any(r[0] == "hot" for r in p)) > 1


def test_topic_wrappers_need_the_connector(spark):
    if S.kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError):
        S.read_topic(spark, "localhost:1", "t", "g")
    with pytest.raises(RuntimeError):
        K.to_topic(spark.createDataFrame([("a",)], "line string"), "localhost:1", "t")


def test_k7_to_index_docs(spark, tmp_path):
    from pushlake.operators import ordered as O

    out = str(tmp_path / "docs")
    os.makedirs(out)

    def send(docs):
        import uuid

        with open(os.path.join(out, uuid.uuid4().hex), "w") as f:
            json.dump(docs, f)

    lines = spark.createDataFrame([(i, s) for i, s in enumerate(["a x", "a y", "b z", "a w"])], "n long, line string")
    runs = O.group_runs(P.accepted(P.parse_pairs(lines, keep=["n"])), "imei", "pkg", ["n"])
    K.to_index_docs(O.last_run(runs, "imei", "pkg"), "imei", "pkg", 7, send)
    docs = sorted((d["id"], d["pkg"], d["itime"]) for f in os.listdir(out) for d in json.load(open(os.path.join(out, f))))
    assert docs == [("a", "w", 7), ("b", "z", 7)]


def test_s8_cells_tsv_lines(spark, tmp_path):
    path = str(tmp_path / "tsv")
    spark.createDataFrame([(" r1\t5\t1.5\tA\tq\t",), ("r2\tx\t1\tA\tq",), ("r3\t1\t2",)], "v string").write.text(path)
    assert [tuple(r) for r in S.read_cells_tsv(spark, path).collect()] == [("r1", "A", "q", 5, "1.5")]
