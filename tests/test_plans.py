"""Plan-level guarantees behind the scale claims."""

import pytest

from __spark_entry__ import queries
from scorewatch.operators.keys import pick_first
from scorewatch.plans.ordered import carry_window


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pick_combines_map_side_before_the_shuffle(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i}", i % 7, i) for i in range(3000)]   # one key: a third of the rows
    df = spark.createDataFrame(rows, "k string, d int, seq int")
    plan = _plan(pick_first(df, ["k"], ["d", "seq"]))
    assert "partial_min_by" in plan
    assert plan.index("partial_min_by") > plan.index("Exchange")   # partial sits below (after, in text) the exchange


def test_ordered_work_joins_one_line_per_partition(spark):
    df = spark.createDataFrame([("a", 1, 1, 1.0)], "k string, day int, seq int, x double")
    out = carry_window(df, ["k"], ["day", "seq"], sums={"c": "x"})
    out.collect()
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_staged_tables_are_dropped_by_their_own_scope(spark):
    import os

    from scorewatch.plans.staging import Scope, drop_staged, stage
    path = lambda d: d.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    drop_staged(spark)
    run, outside = Scope(), stage(spark.range(3), "outside")
    with run.begin(spark):
        first = path(stage(spark.range(3), "first"))
    assert os.path.exists(first) and os.path.exists(path(outside))
    with run.begin(spark):
        second = path(stage(spark.range(3), "second"))
    assert not os.path.exists(first) and os.path.exists(second) and os.path.exists(path(outside))
    assert drop_staged(spark) == 1 and os.path.exists(second)
    with run.begin(spark):
        pass
    assert not os.path.exists(second)


def test_periods_of_any_number(spark):
    from scorewatch.operators.periods import assign_periods
    periods = [(f"p{i}", "2024-01-01", "2024-12-31") for i in range(1500)] + [("none", "2030-01-01", "2030-01-02")]
    df = spark.createDataFrame([("2024-05-05",)], "d string")
    assert assign_periods(df, "d", periods).count() == 1500


@pytest.mark.parametrize("name", ["r1_model_performance", "r3_repay_rank_order_new", "r17_resignation_resolution",
                                  "r18_balance_ledger", "r12_unit_funnel"])
def test_no_python_or_cartesian_operators(spark, name):
    df = queries()[name](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
