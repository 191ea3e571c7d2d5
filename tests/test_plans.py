"""Plan-shape guards for the scale design (final adaptive plans at sf0.001)."""

import re

import pytest

import __spark_entry__ as E
from pushlake.plans.registry import entries
from tests.conftest import SF_SMALL

QUERIES = E.queries()


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


@pytest.mark.parametrize("name", ["p1_parse_http_api", "p3_project_push", "g5_wgs84_to_bd09", "x13_kv_map"])
def test_row_wise_operators_do_not_shuffle_or_call_python(spark, name):
    plan = final_plan(QUERIES[name](spark, SF_SMALL))
    assert shuffles(plan) == 0
    assert not re.search(r"EvalPython|MapInPandas", plan)


def test_parser_pins_the_split_once(spark):
    plan = final_plan(QUERIES["p1_parse_http_api"](spark, SF_SMALL))
    assert plan.count("Generate inline") == 2  # split array and hour key, each once
    assert "regexp_replace" not in plan  # Java trim/split without regular expressions


def test_runs_share_one_segment_shuffle(spark):
    plan = final_plan(QUERIES["w1_group_runs"](spark, SF_SMALL))
    # the range segments are written once: both readers scan the checkpoint
    assert "ExistingRDD" in plan
    assert "rangepartitioning" not in plan


def test_cube_expands_only_the_base_cuboid(spark):
    plan = final_plan(QUERIES["c7_build_cube"](spark, SF_SMALL))
    expand = plan.index("Expand")
    # below the Expand there is the base-cuboid aggregate and its shuffle, not the fact scan alone
    assert "HashAggregate" in plan[expand:] and "Exchange hashpartitioning" in plan[expand:]
    assert shuffles(plan) == 2


def test_version_sums_prune_the_salted_branch_when_no_cell_is_heavy(spark):
    plan = final_plan(QUERIES["a5_sum_versions"](spark, SF_SMALL))
    assert "Window" not in plan and shuffles(plan) == 1


def test_scans_read_only_needed_columns(spark):
    plan = final_plan(QUERIES["j2_lookup_sum"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(len(s.split(",")) <= 4 for s in schemas)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan


#: The user parser in Python, and the bulk sender (user code).
PYTHON_HOOKS = {"p12_python_parser", "p12_rejects"}


def test_no_python_outside_the_user_hooks(spark):
    """Only the example of a Python parser evaluates Python; every other query of the core stays on
    the JVM (plans planned, not executed)."""
    offenders = []
    for name in entries():
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        uses_python = bool(re.search(r"EvalPython|MapIn(Pandas|Arrow)|FlatMapGroupsInPandas|Python(UDF|UDTF)", plan))
        if uses_python != (name in PYTHON_HOOKS):
            offenders.append(name)
    assert offenders == []
