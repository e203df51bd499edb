import datetime as dt

from pyspark.sql import functions as F

from scorewatch.functions import bands, core, dates, scorecard
from scorewatch.operators.rank_order import repay_rank_order


def _rows(spark, data, schema, *cols):
    return spark.createDataFrame(data, schema).select(*cols).collect()


def test_canonical_id_and_missing_tokens(spark):
    vals = [(" 12 ",), ("nan",), ("None",), ("",), ("<NA>",), ("NULL",), ("7",), (None,)]
    out = [r[0] for r in _rows(spark, vals, "v string", core.canonical_id("v"))]
    assert out == ["12", None, None, None, None, None, "7", None]


def test_month_arithmetic(spark):
    r = _rows(spark, [(dt.date(2024, 3, 31), dt.date(2023, 12, 1))], "a date, b date",
              core.shift_months("a", -1).alias("s"), core.months_diff("a", "b").alias("m"),
              core.month_key("a").alias("k"), core.month_label("a").alias("l"), core.day_distance("b", "a").alias("d"))[0]
    assert r.s == dt.date(2024, 2, 29)          # month-end clamp
    assert r.m == 3                             # calendar months, day ignored
    assert r.k == 202403 and r.l == "2024-03" and r.d == 121


def test_safe_ratio_and_rounding(spark):
    r = _rows(spark, [(1.0, 0.0, 71.25)], "a double, b double, c double",
              core.safe_ratio("a", "b").alias("r"), F.bround("c", 1).alias("h"))[0]
    assert r.r is None and r.h == 71.2          # zero denominator -> null; half-even


def test_attrition_bands(spark):
    data = [("1",), ("6",), ("12+",), ("13",), (None,), ("x",)]
    out = _rows(spark, data, "v string", bands.attrition_band(bands.open_ended_to_number("v")).alias("b"))
    assert [r.b for r in out] == ["Very high", "High", "Very low", "13.0", None, None]
    inf = _rows(spark, [(float("inf"),), (3.0,)], "v double", bands.inf_to_open_ended("v").alias("x"))
    assert [r.x for r in inf] == [15.0, 3.0]


def test_change_and_cohort_labels(spark):
    r = _rows(spark, [(1.0, 2.0, dt.date(2025, 2, 1)), (2.0, 1.0, None), (1.0, 1.0, dt.date(2024, 1, 1))],
              "o double, n double, d date",
              bands.change_category("o", "n").alias("c"), bands.cohort_label("d").alias("h"))
    assert [x.c for x in r] == ["CL Increased", "CL Decreased", "No CL Increase"]
    assert [x.h for x in r] == ["Onboarded Q1 2025", "Onboarded 2026", "Onboarded before"]


DIRTY = [
    ("2024-01-31", "valid", dt.date(2024, 1, 31)),
    (" 2024-01-31 ", "valid", dt.date(2024, 1, 31)),
    ("2024/1/3", "convertible", dt.date(2024, 1, 3)),
    ("2024-1-05", "convertible", dt.date(2024, 1, 5)),
    ("2024.01", "convertible", dt.date(2024, 1, 1)),
    ("20240131", "convertible", dt.date(2024, 1, 31)),
    ("31-01-2024", "convertible", dt.date(2024, 1, 31)),
    ("01-02-2024", "convertible", dt.date(2024, 1, 2)),
    ("3/15/2024", "convertible", dt.date(2024, 3, 15)),
    ("2024-02-30", "invalid", None),
    ("2024-13-01", "invalid", None),
    ("1850-01-01", "invalid", None),
    ("01012020", "invalid", None),
    ("2030-01-01", "invalid", None),
    ("abc", "invalid", None),
    ("2024-01-31T00:00", "invalid", None),
    ("nan", "null", None),
    ("NaN", "null", None),
    ("", "null", None),
    (None, "null", None),
]


def test_dirty_dates(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in DIRTY], "s string")
    tag, d = dates.normalise_date(dates.as_date_text("s"), "1990-01-01", "2025-10-01")
    out = df.select(tag.alias("t"), d.alias("d")).collect()
    for (s, want_tag, want_date), r in zip(DIRTY, out):
        assert (r.t, r.d) == (want_tag, want_date), s


def test_dirty_dates_per_row_bounds_and_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 1, 13, 0), dt.date(2024, 6, 1)),
                                (dt.datetime(2024, 7, 1, 0, 0), None)], "ts timestamp, lo date")
    text = dates.as_date_text("ts", df.schema["ts"].dataType)
    lo = F.coalesce(F.col("lo"), F.lit("1990-01-01").cast("date"))
    tag, d = dates.normalise_date(text, lo, "2025-10-01")
    out = df.select(tag.alias("t"), d.alias("d")).collect()
    assert [(r.t, r.d) for r in out] == [("invalid", None), ("valid", dt.date(2024, 7, 1))]


def test_points_scorecard(spark):
    rows = [(0.5, "Female", 21199.0, "Married"), (4.0, "Male", 40000.0, "Single"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "employer_time double, gender string, declared_income_num double, civil_status string")
    out = df.select(scorecard.total_points().alias("s")).select("s", scorecard.points_segment("s").alias("g")).collect()
    assert [r.s for r in out] == [98 + 120 + 119 + 127, 183 + 118 + 146 + 117, 119 * 4]
    assert [r.g for r in out] == ["E", "A", "D"]   # 464 > 452, 564 > 532, 476 > 468


def test_income_and_tenure(spark):
    df = spark.createDataFrame([("10000-20000", "2020-1", dt.date(2021, 1, 1)),
                                ("12345", "2020-01-15", dt.date(2021, 1, 14)),
                                ("bad", "2020-13", dt.date(2021, 1, 1))], "i string, e string, c date")
    out = df.select(scorecard.income_number("i").alias("n"), scorecard.tenure_years("e", "c").alias("t")).collect()
    assert [r.n for r in out] == [15000.0, 12345.0, None]
    assert abs(out[0].t - 366 / 365) < 1e-12 and abs(out[1].t - 365 / 365) < 1e-12 and out[2].t is None


def test_coerce_and_label_completion(spark):
    from pyspark.sql.types import DateType, StructField, StructType

    from scorewatch.operators.rank_order import with_all_labels
    df = spark.createDataFrame([("2024-01-31", "x"), ("bad", "y")], "d string, other string")
    out = core.coerce_columns(df, StructType([StructField("d", DateType())])).collect()
    assert [r.d for r in out] == [dt.date(2024, 1, 31), None] and out[1].other == "y"
    rep = spark.createDataFrame([("v1", "A", 3), ("v1", "C", 1), ("v2", "B", 2)], "ModelVersion string, RiskGroup string, Count int")
    full = with_all_labels(rep, "RiskGroup", list("ABCDEF"), keys=["ModelVersion"]).collect()
    assert len(full) == 12
    assert [(r.RiskGroup, r.Count) for r in full[:6]] == [("A", 3), ("B", None), ("C", 1), ("D", None), ("E", None), ("F", None)]


def test_repay_rank_order_sums_the_eligible_balance(spark):
    """Per segment: all members' balance on the eligible date, missing balances as nothing, segments without a label left out."""
    rows = [("1", "A", 1, 100.0, 40.0, 70.25), ("2", "A", 0, 50.0, 30.0, 20.5), ("3", "A", 0, None, None, None),
            ("4", "B", 1, None, None, None), ("5", None, 0, 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "ee_customer_id string, seg string, oop_target int, osbal_as_of_resignation_date double, "
                                     "osbal_as_of_current_date double, osbal_as_of_oop_eligible_date double")
    out = {r.RiskGroup: r for r in repay_rank_order(df, "seg", None, "m", "p", "2025-01").collect()}
    assert set(out) == {"A", "B"}
    assert (out["A"].Count, out["A"].Sum_Osbal_Eligible, out["A"].Sum_Osbal_Bads_Today) == (3, 90.75, 30.0)
    assert (out["B"].Sum_Osbal_Eligible, out["B"].Sum_Osbal_Resignation, out["B"].Outstanding_Bad_Rate) == (0.0, 0.0, None)
