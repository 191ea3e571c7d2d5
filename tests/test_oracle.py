"""Every registered query against its DuckDB oracle (sf0.001), and every query
without an oracle at least runs."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle import compare, connect

import __spark_entry__ as E

QUERIES = E.queries()
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"grain", "iday", "ihour", "n_msgs"} <= set(df.columns)


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name in SQLS:
        compare(df, con, SQLS[name])
    else:
        assert df.count() >= 0


@pytest.mark.parametrize("name", ["w1_group_runs", "a5_sum_versions", "c4_encode_dim", "w7_first_n_per_group"])
def test_query_without_adaptive_execution(spark, con, name):
    """Results do not depend on AQE (static plans, odd shuffle partition count)."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        compare(QUERIES[name](spark, SF_SMALL), con, SQLS[name])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
