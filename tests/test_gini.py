import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from scorewatch.operators.gini import gini_by_period
from scorewatch.operators.periods import assign_intervals, assign_periods, elementary_intervals

D = dt.date(2024, 1, 15)
W = {"Weighted": "weight"}
PERIODS = [("P", "2024-01-01", "2024-01-31"), ("Q", "2024-01-10", "2024-02-28"), ("Empty", "2030-01-01", "2030-01-31")]


def pairwise_auc(rows):
    num = den_p = den_n = 0.0
    pos = [(s, w) for s, t, w in rows if t == 1]
    neg = [(s, w) for s, t, w in rows if t == 0]
    for sp, wp in pos:
        for sn, wn in neg:
            num += wp * wn * (1.0 if sp > sn else 0.5 if sp == sn else 0.0)
    den_p = sum(w for _, w in pos)
    den_n = sum(w for _, w in neg)
    return num / (den_p * den_n)


def frame(spark, rows):
    data = [("s", f"c{i % 7}", D, s, t, w) for i, (s, t, w) in enumerate(rows)]
    return spark.createDataFrame(data, "series string, cid string, obs_date date, score double, target int, weight double")


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0.1, 0.2, 0.2, 0.5, 0.9]), st.integers(0, 1),
                          st.sampled_from([0.0, 0.5, 1.0, 2.0])), min_size=4, max_size=40))
def test_grouped_auc_equals_pairwise(spark, rows):
    if len({t for _, t, _ in rows}) < 2 or sum(w for _, t, w in rows if t == 1) == 0 \
            or sum(w for _, t, w in rows if t == 0) == 0:
        return
    out = {r.Period: r for r in gini_by_period(frame(spark, rows), ["s"], PERIODS, W, rows_per_bucket=2).collect()}
    want = 2 * pairwise_auc(rows) - 1
    assert abs(out["P"].Gini - want) <= 0.5e-4 + 1e-12


def test_rules_empty_one_class_null_score_direction(spark):
    rng = random.Random(7)
    rows = [(rng.random(), rng.randint(0, 1), 1.0) for _ in range(200)]
    g = {r.Period: r for r in gini_by_period(frame(spark, rows), ["s"], PERIODS, W).collect()}
    flipped = [(-s, t, w) for s, t, w in rows]
    f = {r.Period: r for r in gini_by_period(frame(spark, flipped), ["s"], PERIODS, W).collect()}
    assert abs(g["P"].Gini + f["P"].Gini) <= 1e-4            # AUC(-s) = 1 - AUC
    assert g["P"].Sample_Size == 7 and g["Q"].Sample_Size == 7  # distinct customers, overlapping periods
    assert g["Empty"].Sample_Size == 0 and g["Empty"].Gini is None and g["Empty"].Bad_Rate_Pct is None
    one = gini_by_period(frame(spark, [(0.3, 1, 1.0), (0.4, 1, 1.0)]), ["s"], PERIODS[:1], W).collect()
    assert one[0].Gini is None
    with_null = gini_by_period(frame(spark, [(0.3, 1, 1.0), (None, 0, 1.0), (0.1, 0, 1.0)]), ["s"], PERIODS[:1], W).collect()
    assert with_null[0].Gini is None and with_null[0].Sample_Size == 3


def test_bad_rate_counts_customer_once_as_good(spark):
    rows = [(0.1, 1, 1.0), (0.2, 0, 1.0)]
    data = [("s", "c1", D, s, t, w) for s, t, w in rows] + [("s", "c2", D, 0.5, 0, 1.0)]
    df = spark.createDataFrame(data, "series string, cid string, obs_date date, score double, target int, weight double")
    r = gini_by_period(df, ["s"], PERIODS[:1], W).collect()[0]
    assert r.Sample_Size == 2 and r.Bad_Rate_Pct == 50.0


def test_elementary_intervals_cut_at_every_end():
    cuts = elementary_intervals([("a", "2024-01-01", "2024-01-31"), ("b", "2024-01-10", "2024-02-28"), ("c", "2024-05-01", "2024-05-01"), ("none", "2024-06-02", "2024-06-01")])
    assert [(str(d), h) for d, h in cuts] == [("2024-01-01", True), ("2024-01-10", True), ("2024-02-01", True), ("2024-02-29", False), ("2024-05-01", True), ("2024-05-02", False)]


def test_a_row_lies_in_one_interval_and_the_merge_gives_its_periods(spark):
    rng = random.Random(8)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(120))
    periods = [(f"p{i}", str(min(a, b)), str(max(a, b))) for i in range(1000) for a, b in [(day(), day())]]
    rows = [(i, day() if i % 20 else None) for i in range(300)] + [(1000, dt.date(2030, 1, 1)), (1001, dt.date(2000, 1, 1))]
    df = spark.createDataFrame(rows, "i int, d date")
    cut = assign_intervals(df, "d", periods)
    states = cut.groupBy("_interval").agg(F.count(F.lit(1)).alias("n"))
    assert cut.count() <= len(rows) and states.count() <= 2 * 120
    got = {r.Period: r.n for r in assign_periods(states, "_interval", periods).groupBy("Period").agg(F.sum("n").alias("n")).collect()}
    want = {n: k for n, s, e in periods if (k := sum(d is not None and s <= str(d) <= e for _, d in rows))}
    assert got == want
    assert assign_intervals(df, "d", []).count() == 0


def test_gini_of_many_overlapping_periods_equals_each_alone(spark):
    rng = random.Random(2)
    data = [("s", f"c{rng.randrange(40)}", dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60)), rng.choice([None, 0.1, 0.2, 0.5, 0.9]) if i % 30 == 0 else rng.random(),
             rng.randrange(2), float(rng.randrange(5))) for i in range(600)]
    df = spark.createDataFrame(data, "series string, cid string, obs_date date, score double, target int, weight double")
    periods = [(f"p{i}", f"2024-01-{1 + 3 * i:02d}", f"2024-02-{5 + 2 * i:02d}") for i in range(8)]
    key = lambda r: (r.Period, r.Weighting)
    both = {"Unit": None, "Weighted": "weight"}
    together = sorted(gini_by_period(df, ["s"], periods, both).collect(), key=key)
    alone = sorted((r for p in periods[::3] for r in gini_by_period(df, ["s"], [p], both).collect()), key=key)
    assert [r for r in together if r.Period in {p[0] for p in periods[::3]}] == alone


def test_score_direction(spark):
    data = [(s, f"c{i}", D, i / 10, int(i > 5 or i == 2), 1.0) for i in range(10) for s in ("up", "down")]
    df = spark.createDataFrame(data, "series string, cid string, obs_date date, score double, target int, weight double")
    got = {r.series: r.Gini for r in gini_by_period(df, ["up", "down"], PERIODS[:1], low_is_good=("down",)).collect()}
    assert got["up"] == -got["down"] and got["up"] > 0
