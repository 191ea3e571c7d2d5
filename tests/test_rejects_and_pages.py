"""Rejects as data (P11, P12, K7), deep pages (W6) and hour counts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from pushlake.functions.parser_hooks import ENVELOPE_SCHEMA, EnvelopeParser
from pushlake.operators import parse as P
from pushlake.operators import rollup as R
from pushlake.sources import readers as S
from pushlake.sources import sinks as K


def test_p12_items_and_rejects(spark):
    """0..n rows per message; an id beyond 64 bits is a reject, not a failed job."""
    good = '{"msg_id":%s,"step":" seg-to-apns ","itime":"5","uid":3%s}'
    bodies = [
        good % (9, ""), good % (1 << 70, ""), good % (-(1 << 63) - 1, ""), good % (1, ""), good % ('"12"', ',"appkey":" k "'),
        '{"rows":[%s,%s,7]}' % (good % (10, ',"platform":null'), good % ("true", "")), '{"rows":{}}', '{"rows":[]}', "junk", None, "[]",
        good % (9, ',"appkey":null'), '{"msg_id":9,"itime":5,"uid":3}', '{"msg_id":9,"step":"x","itime":5,"uid":3}',
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "n int, body string").withColumn("appkey", F.lit("clash"))
    parsed = P.with_table_function(df, EnvelopeParser, ENVELOPE_SCHEMA, "body", keep=["n"]).cache()
    assert {(r.n, r.msg_id, r.appkey, r.platform, r.itime, r.uid) for r in P.accepted(parsed).collect()} == {
        (0, 9, "null", "null", 5, 3), (4, 12, "k", "null", 5, 3), (5, 10, "null", "null", 5, 3),
    }
    bad = sorted((r.n, r.reject_reason) for r in parsed.filter(F.col(P.REJECT).isNotNull()).collect())
    assert bad == [
        (1, "msg_id"), (2, "msg_id"), (3, "sentinel"), (5, "msg_id"), (5, "object"), (6, "rows"), (8, "json"), (9, "json"),
        (10, "object"), (11, "appkey_null"), (12, "step"), (13, "step_not_target"),
    ]


def test_p12_calls_travel_in_batches(spark):
    """The rows of many calls come in one Arrow batch, with the rows of a table function."""

    class Counter:
        def eval(self, n):
            return None if n is None else iter(range(n))  # rows without tuples, or none at all

    class Closing(Counter):
        def terminate(self):
            yield (-1,)

    df = spark.createDataFrame([(1, 2), (2, None), (3, 0), (3, 1), (None, 1)], "id int, n int").repartition(1)
    out = P.with_table_function(df, Counter, "m int", "n", keep=["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "UDTF" not in plan
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 0), (1, 1), (3, 0), (None, 0)]
    assert out.columns == ["id", "m"] and dict(out.dtypes)["m"] == "int"
    closed = P.with_table_function(df, Closing, "m int", "n")
    assert sorted(r.m for r in closed.collect()) == [-1, 0, 0, 0, 1]


def test_p12_parser_of_a_task_keeps_its_state(spark):
    class Numbered:
        def __init__(self):
            self.seen = 0

        def eval(self, n):
            self.seen += 1
            yield n, self.seen, None

    df = spark.range(25_000, numPartitions=1)
    out = P.with_table_function(df, Numbered, "n long, seen long, more string", "id").collect()
    assert [tuple(r) for r in out] == [(i, i + 1, None) for i in range(25_000)]


def test_split_evaluates_once(spark, tmp_path):
    """Accepted and rejected rows come from one evaluation and are all rows."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def reason(i):
        calls.add(1)
        return "odd" if i % 2 else None

    parsed = spark.range(1000).withColumn(P.REJECT, reason("id"))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    K.write_split(parsed, lambda rows: rows.write.parquet(good), lambda rows: rows.write.parquet(bad))
    assert calls.value == 1000
    assert spark.read.parquet(good).columns == ["id"] and spark.read.parquet(good).count() == 500
    assert {r[P.REJECT] for r in spark.read.parquet(bad).collect()} == {"odd"} and spark.read.parquet(bad).count() == 500


def test_split_keeps_the_rows_in_files(spark, tmp_path):
    """The two writes read what one evaluation wrote: no cached blocks, and no files are left."""
    seen = []

    def write(rows):
        seen.append(rows.inputFiles())
        rows.write.parquet(str(tmp_path / f"part{len(seen)}"))

    parsed = spark.range(10).select(F.col("id").cast("string").alias("v"), F.when(F.col("id") > 6, "late").alias(P.REJECT))
    K.write_split(parsed, write, write)
    assert len(seen) == 2 and all(files and all("/scratch/split-" in f for f in files) for files in seen)
    assert not any(os.path.exists(f.removeprefix("file://")) for files in seen for f in files)
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "part1")).collect()) == list("0123456")
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "part2")).collect()) == [(x, "late") for x in "789"]


def test_s3_s8_rejects(spark, tmp_path):
    orc, tsv = str(tmp_path / "orc"), str(tmp_path / "tsv")
    spark.createDataFrame([("i", "p", "n", 1), ("j", None, None, 2), (None, "p", "n", None)], S.APPLIST_SCHEMA).write.orc(orc)
    assert sorted(str(r[P.REJECT]) for r in S.checked_applist_orc(spark, orc).collect()) == ["None", "imei", "pkg"]
    lines = ["r1\t5\t1.5\tA\tq", "r2\tx\t1\tA\tq", "r3\t1\t2", "", f"r4\t{1 << 70}\t1\tA\tq"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(tsv)
    got = {r.line: r[P.REJECT] for r in S.checked_cells_tsv(spark, tsv).collect()}
    assert got == dict(zip(lines, [None, "ts", "fields", "fields", "ts"]))


def test_k7_failing_sender(spark, tmp_path):
    """A request that always raises makes its documents rows; one that recovers does not."""
    out = str(tmp_path / "failures")

    def send(docs):
        if any(d["id"] == "13" for d in docs):
            raise ConnectionError("index is down")
        return [(d["id"], "mapping") for d in docs if d["id"] == "2"]

    df = spark.range(40).coalesce(1).select(F.col("id").cast("string").alias("id"))
    assert K.write_in_batches(df, send, out, batch=10, attempts=2) == 11
    got = {r.id: r.reason for r in spark.read.parquet(out).collect()}
    assert got == {**{str(i): "ConnectionError: index is down" for i in range(10, 20)}, "2": "mapping"}
    assert K.write_in_batches(df.limit(0), send, out) == 0 and spark.read.parquet(out).count() == 0


def test_w6_page_parts():
    sizes = [(0, 10), (1, 0), (2, 5), (5, 20)]
    assert R.page_parts(sizes, 3, 8) == [(0, 9, 10), (2, 1, 1)]
    assert R.page_parts(sizes, 0, 12) == [(2, 3, 5), (5, 1, 20)]
    assert R.page_parts(sizes, 100, 34) == [(5, 20, 20)]
    assert R.page_parts(sizes, 5, 35) == [] and R.page_parts([], 5, 5) == []


@pytest.mark.parametrize("limit,offset", [(7, 1), (50, 333), (0, 990), (0, 2000), (1000, 0), (5, 999)])
def test_w6_any_page(spark, limit, offset):
    rows = [(i * 7919 % 1000, None if i % 10 == 0 else i % 3) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(5)
    got = [(r.id, r.v) for r in R.page(df, [F.desc("v"), "id"], limit, offset).collect()]
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == order[offset : offset + limit if limit else None]


def test_w7_pages_of_groups(spark):
    rows = [("hot", i) for i in range(95)] + [(None, i) for i in range(12)] + [("one", 0)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    for number in (1, 2, 10, 11):
        got = sorted((r.g or "", r.v) for r in R.group_page(df, ["g"], "v", 10, number).collect())
        want = [(g or "", v) for g, v in rows if 10 * (number - 1) <= v < 10 * number]
        assert got == sorted(want)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_a11_counts_equal_grouping_sets(spark, kind):
    rnd = random.Random(4)
    days = [20170510, 20170511, 20171231]
    rows = [(d := rnd.choice(days), d * 100 + rnd.choice([0, 0, 0, 7, 23]), rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1, 2, 3, 1 << 62])) for _ in range(500)]
    df = spark.createDataFrame(rows, "iday int, ihour int, app string, id long").withColumn("id", F.col("id").cast(kind))
    aggs = [F.count(F.lit(1)).alias("n"), F.countDistinct("app").alias("apps"), F.countDistinct("id").alias("ids")]
    cols = ["iday", "ihour", "grain", "n", "apps", "ids"]
    want = sorted(map(str, R.hour_day_stats(df, "iday", "ihour", aggs).select(*cols).collect()))
    got = R.hour_day_counts(df, "iday", "ihour", "n", {"apps": "app", "ids": "id"})
    assert sorted(map(str, got.select(*cols).collect())) == want and got.columns == cols
    assert R.hour_day_counts(df.limit(0), "iday", "ihour", "n", {"apps": "app"}).collect() == []


def test_a11_plan_has_no_expand(spark):
    df = spark.range(10).selectExpr("20170510 iday", "2017051000 + id ihour", "id", "cast(id as string) s")
    plan = R.hour_day_counts(df, "iday", "ihour", "n", {"a": "id", "b": "s"})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 3
