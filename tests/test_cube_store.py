"""Cube router, smallest parents and segment store."""

import itertools

import pytest
from pyspark.sql import functions as F

from pushlake.operators import cube as CB

DIMS = ["r", "s", "t"]


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(f"r{i % 2}" if i % 11 else None, f"s{i % 3}", i % 7, i, f"201{i % 5}0101000000") for i in range(200)]
    return spark.createDataFrame(rows, "r string, s string, t int, v int, time string")


def brute(facts, want, keep):
    out = {}
    for x in facts.collect():
        if keep(x):
            k = tuple(x[w] for w in want)
            out[k] = out.get(k, 0) + x.v
    return {(*k, v) for k, v in out.items()}


def filters():
    return [
        (None, lambda x: True),
        (F.col("s") == "s1", lambda x: x.s == "s1"),
        ((F.col("t") > 2) & (F.col("s") != "s0"), lambda x: x.t > 2 and x.s != "s0"),
        (F.col("r").isNull() | (F.col("t") == 1), lambda x: x.r is None or x.t == 1),
        (F.col("t") > 100, lambda x: False),
    ]


@pytest.mark.parametrize("by_layer", [False, True])
def test_c11_any_group_and_filter(facts, by_layer):
    """Every group-by under every filter, in or outside of it, equals the base table."""
    cube = CB.build_cube(facts, DIMS, {"v": F.sum("v")}, by_layer=by_layer).cache()
    rows = CB.cuboid_rows(cube)
    assert len(rows) == 8
    for k in range(len(DIMS) + 1):
        for want in itertools.combinations(DIMS, k):
            for where, keep in filters():
                got = CB.query_cube(cube, DIMS, want, "v", where=where, rows=rows)
                assert set(map(tuple, got.collect())) == brute(facts, want, keep), (want, where)


def test_c11_partial_cube_routes_or_refuses(facts):
    cube = CB.build_cube(facts, DIMS, {"v": F.sum("v")}, cuboids=[["r", "s"], ["s", "t"], ["r", "s", "t"]])
    rows = CB.cuboid_rows(cube)
    assert set(rows) == {0b001, 0b100, 0b000}
    assert CB.route(DIMS, ["s"], rows) == (0b001 if rows[0b001] <= rows[0b100] else 0b100)
    assert CB.route(DIMS, ["r", "t"], rows) == 0
    got = CB.query_cube(cube, DIMS, ["t"], "v", where=F.col("r") == "r1")
    assert set(map(tuple, got.collect())) == brute(facts, ["t"], lambda x: x.r == "r1")
    small = CB.build_cube(facts, DIMS, {"v": F.sum("v")}, cuboids=[["r", "s"]])
    for where in (F.col("t") == 1, F.col("time") == "x"):
        with pytest.raises(ValueError):
            CB.query_cube(small, DIMS, ["r"], "v", where=where)
    got = CB.query_cube(small, DIMS, ["r"], ["v", "n"], where=F.col("t") == 1, base=facts, fallback=True)
    assert {(x.r, x.v) for x in got.collect()} == brute(facts, ["r"], lambda x: x.t == 1)


def test_c7_smallest_parent():
    rows = {0b000: 100, 0b001: 60, 0b010: 20, 0b100: 20}
    assert CB.smallest_parent(DIMS, ["r"], rows) == 0b010  # (r, t) has 20 rows, (r, s) 60
    assert CB.smallest_parent(DIMS, ["t"], rows) == 0b010  # a tie: the lowest gid
    assert CB.smallest_parent(DIMS, ["s"], {0b001: 60, 0b100: 70}) == 0b001


def test_c12_overlaps_are_refused(spark, facts, tmp_path):
    path = str(tmp_path / "cube")
    rows = spark.createDataFrame([("a", 1)], "d string, n long")
    CB.add_segment(rows, path, "20150101000000", "20150201000000")
    for start, end in [("20150115000000", "20150301000000"), ("20141201000000", "20150102000000"), ("20150110000000", "20150111000000"), ("20150301000000", "20150301000000")]:
        with pytest.raises(ValueError):
            CB.add_segment(rows, path, start, end)
    CB.add_segment(rows, path, "20150101000000", "20150201000000")  # the same range is replaced
    CB.add_segment(rows, path, "20150201000000", "20150301000000")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        CB.check_segments([("1", "3"), ("2", "4")])


def test_c12_all_segments_from_one_pass(spark, facts, tmp_path):
    path = str(tmp_path / "cube")
    years = [(f"{y}0101000000", f"{y + 1}0101000000") for y in range(2010, 2017)]
    CB.add_segments(facts, path, F.col("time"), years, ["s"], {"v": F.sum("v")})
    assert [n[:4] for n in CB.list_segments(spark, path)] == ["2010", "2011", "2012", "2013", "2014"]
    got = {(r.segment[:4], r.s, r.gid): r.v for r in spark.read.parquet(path).collect()}
    want = {}
    for x in facts.collect():
        for key in [(x.time[:4], x.s, 0), (x.time[:4], None, 1)]:
            want[key] = want.get(key, 0) + x.v
    assert got == want
    # a rerun of one year replaces it; without rows it goes
    CB.add_segments(facts.filter("s = 's1'"), path, F.col("time"), years[:1], ["s"], {"v": F.sum("v")})
    assert {r.s for r in spark.read.parquet(path).filter("segment like '2010%' and gid = 0").collect()} == {"s1"}
    CB.add_segments(facts.limit(0), path, F.col("time"), years[1:2], ["s"], {"v": F.sum("v")})
    assert [n[:4] for n in CB.list_segments(spark, path)] == ["2010", "2012", "2013", "2014"]


def test_c12_merged_segments_add_up(spark, facts, tmp_path):
    path = str(tmp_path / "cube")
    years = [(f"{y}0101000000", f"{y + 1}0101000000") for y in range(2010, 2015)]
    CB.add_segments(facts, path, F.col("time"), years, ["s"], {"v": F.sum("v")})
    total = lambda: {(r.s, r.gid): r.v for r in spark.read.parquet(path).groupBy("s", "gid").agg(F.sum("v").alias("v")).collect()}
    before = total()
    CB.merge_segments(spark, path, "20110101000000", "20140101000000", ["s"], ["v"])
    assert [n[:4] for n in CB.list_segments(spark, path)] == ["2010", "2011", "2014"] and total() == before
    with pytest.raises(ValueError):
        CB.merge_segments(spark, path, "20100101000000", "20130101000000", ["s"], ["v"])
