import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorewatch.plans.ordered import bucketed_exclusive_prefix, carry_window, order_columns, segmented_sums

SCHEMA = "k string, day int, part int, seq int, v string, x double"


def _events(n=3000, seed=3, dirty=True):
    """One key-day holds a third of the rows; keys, days, parts and values may be null."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        maybe = lambda v: None if dirty and rng.random() < 0.08 else v
        rows.append(("hot" if hot else maybe(f"k{rng.randint(0, 40)}"), 5 if hot else maybe(rng.randint(0, 30)), maybe(rng.randint(0, 9)), i,
                     rng.choice(["A", "B", None]), maybe(float(rng.randint(1, 9)))))
    return rows


def _plain(df, order):
    """The same columns by plain windows over the whole key, nulls last."""
    w = Window.partitionBy("k").orderBy(*order_columns(order))
    return df.select("seq", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                     F.lead("v").over(w).alias("nxt"), F.lag("x").over(w).alias("prv"))


ORDER = ["day", "part", ("seq", False)]


@pytest.mark.parametrize("partitions", [1, 7, 60])
@pytest.mark.parametrize("seed", [3, 4])
def test_carry_window_equals_the_plain_window(spark, partitions, seed):
    """The hot key fills many of the 60 partitions, so sums and values are handed through whole partitions."""
    df = spark.createDataFrame(_events(seed=seed), SCHEMA)
    got = carry_window(df, ["k"], ORDER, sums={"cum": "x"}, nexts={"nxt": "v"}, previous={"prv": "x"}, partitions=partitions)
    assert got.columns == [*df.columns, "cum", "nxt", "prv"]
    want = {r.seq: tuple(r) for r in _plain(df, ORDER).collect()}
    rows = got.select("seq", "cum", "nxt", "prv").collect()
    assert len(rows) == 3000 and {r.seq: tuple(r) for r in rows} == want


def test_carry_window_over_several_batches_and_keys(spark):
    """Arrow batches of seven rows: runs, sums and values go on from one batch to the next."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(_events(600, seed=9), SCHEMA)
        got = carry_window(df, ["k", "day"], ["part", "seq"], sums={"cum": "x", "n": "part"}, nexts={"nxt": "v", "later": "seq"}, previous={"prv": "x"}, partitions=3)
        w = Window.partitionBy("k", "day").orderBy(*order_columns(["part", "seq"]))
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        want = df.select("seq", F.sum("x").over(so_far).alias("cum"), F.sum(F.col("part").cast("double")).over(so_far).alias("n"),
                         F.lead("v").over(w).alias("nxt"), F.lead("seq").over(w).alias("later"), F.lag("x").over(w).alias("prv"))
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_carry_window_takes_empty_input_and_one_shuffle(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert carry_window(df, ["k"], ORDER, sums={"cum": "x"}, nexts={"nxt": "v"}).collect() == []
    full = carry_window(spark.createDataFrame(_events(200), SCHEMA), ["k"], ORDER, sums={"cum": "x"}, previous={"prv": "v"})
    plan = full._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_sums_are_not_taken_over_a_boundary():
    values, starts = np.array([1e16, 1.0, 1.0, 2.0, 3.0]), np.array([True, False, True, False, False])
    assert segmented_sums(values, starts).tolist() == [1e16, 1e16 + 1.0, 1.0, 3.0, 6.0]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]), st.sampled_from([1.0, 2.5, None])), min_size=1, max_size=25),
       st.integers(1, 6))
def test_carry_window_on_any_rows(spark, rows, partitions):
    df = spark.createDataFrame([(k, d, 0, i, k, x) for i, (k, d, x) in enumerate(rows)], SCHEMA)
    want = {r.seq: tuple(r) for r in _plain(df, ["day", "seq"]).collect()}
    got = carry_window(df, ["k"], ["day", "seq"], sums={"cum": "x"}, nexts={"nxt": "v"}, previous={"prv": "x"}, partitions=partitions)
    assert {r.seq: tuple(r) for r in got.select("seq", "cum", "nxt", "prv").collect()} == want


@pytest.mark.parametrize("rows_per_bucket", [100, 100_000])
def test_bucketed_prefix_matches_window(spark, rows_per_bucket):
    rng = random.Random(5)
    rows = [(None if i % 5 == 0 else "g1" if i % 3 else "g2", float(rng.randint(0, 500)), 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, s double, w double").groupBy("g", "s").agg(F.sum("w").alias("w"))
    got = bucketed_exclusive_prefix(df, ["g"], "s", ["w"], rows_per_bucket).select("g", "s", "w_before")
    win = Window.partitionBy("g").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("g", "s", F.coalesce(F.sum("w").over(win), F.lit(0.0)).alias("w_before"))
    key = lambda r: (r.g or "", r.s)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_prefix_takes_any_number_of_groups(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("g"), F.col("id").cast("double").alias("s"),
                                    F.lit(1.0).alias("w"))
    got = bucketed_exclusive_prefix(df, ["g"], "s", ["w"], rows_per_bucket=3000)
    assert got.count() == 20_000 and got.agg(F.sum("w_before")).first()[0] == 5000 * (0 + 1 + 2 + 3)
