from __future__ import annotations

import pytest
from compare import database, differences

from __spark_entry__ import entry
from workload.catalog import queries
from workload.oracle import oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    if name not in oracle_sql():
        assert queries()[name](spark, SF).count() > 0
        return
    assert differences(spark, con, queries()[name], oracle_sql()[name], SF) == []


def test_entry(spark):
    assert entry(spark).count() == 25


# Queries whose plan may hold an Arrow node: the p-values, after aggregation.
PYTHON = {"levene_p_values", "levene_cut"}


@pytest.mark.parametrize(
    "name",
    ["describe_by_trial", "mode_by_trial", "trial_ram", "trial_driver_details", "warmup_trim",
     "levene_statistics", "exp_construct_duration", "levene_p_values"],
)
def test_plan_stays_distributed(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan
    assert ("ArrowEvalPython" in plan) == (name in PYTHON)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    # One row counts may use a single partition; windows and sorts may not.
    for line in plan.splitlines():
        if "Window [" in line:
            assert ", []," not in line


@pytest.mark.parametrize("name,tables", [("describe_by_trial", 1), ("describe_cut", 1), ("levene_cut", 1), ("describe_with_total", 1), ("trial_construct_duration", 2)])
def test_input_is_read_once(spark, name, tables):
    df = queries()[name](spark, SF)
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert executed.count("Scan parquet") == tables


def test_totals_are_counted_from_frequencies(spark):
    df = queries()["describe_with_total"](spark, SF)
    df.collect()
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["warmup_trim", "warmup_trim_long"])
def test_warmup_sends_n_starts_of_a_group(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
