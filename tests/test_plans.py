"""What the plans of the registered queries must not hold."""

import pytest

from prepkit.queries import REGISTRY
from tests.twin import DATA

FOLDER = f"{DATA}/sf0.001"
BARRED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n, e in REGISTRY.items() if e.sql is not None])
def test_no_pairing_of_all_rows_and_no_python_per_row(spark, name):
    plan = plan_of(REGISTRY[name].run(spark, FOLDER))
    assert not [b for b in BARRED if b in plan]


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(REGISTRY["equality_filter"].run(spark, FOLDER))
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in plan
    assert "c_name" not in plan_of(REGISTRY["standardise"].run(spark, FOLDER))


def test_applying_a_fit_moves_no_rows(spark):
    for name in ("mean_fill", "guarded_mean", "mode_fill", "minmax_apply", "standardise_centred", "bernoulli_impute", "scalar_broadcast"):
        assert "Exchange" not in plan_of(REGISTRY[name].run(spark, FOLDER))


def test_a_quota_shuffles_only_the_band(spark):
    lines = plan_of(REGISTRY["stratified_split"].run(spark, FOLDER)).splitlines()
    assert lines[1].startswith("+- Union")
    second = next(i for i, line in enumerate(lines) if line.startswith("   +- "))
    assert not any("hashpartitioning" in line for line in lines[:second])
    assert any("hashpartitioning" in line for line in lines[second:])
