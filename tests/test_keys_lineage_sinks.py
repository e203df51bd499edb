import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scorewatch.operators.keys import assert_unique, duplicate_keys, first_non_null, pick_first, rows_at_latest
from scorewatch.plans import lineage as ln
from scorewatch.sources import sinks


def test_pick_first_is_deterministic_with_ties(spark):
    rows = [("a", 1, 5, "x"), ("a", 1, 3, "y"), ("a", 2, 1, "z"), ("b", 0, 9, "w")]
    df = spark.createDataFrame(rows, "k string, d int, tie int, v string")
    out = {r.k: r.v for r in pick_first(df, ["k"], ["d", "tie"]).collect()}
    assert out == {"a": "y", "b": "w"}


def test_first_non_null_and_latest(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "t"), ("a", 3, "u")], "k string, o int, v string")
    assert first_non_null(df, ["k"], "v", ["o"]).collect()[0].v == "t"
    assert [r.o for r in rows_at_latest(df, "o").collect()] == [3]


def test_duplicate_audit_and_uniqueness(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [(r.k, r.n_rows) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    assert_unique(df.distinct(), ["k"])


def _repayments(spark):
    d = dt.date
    rows = [  # user, loan, vendor, date, inst, outstanding, paid, principal, part, supp
        ("u1", "L1", "TPSD", d(2024, 1, 31), 1, 100.0, 10.0, 10.0, 1, 1),
        ("u1", "L1", "TPFP", d(2024, 2, 29), 2, 90.0, 10.0, 10.0, 1, 1),
        ("u1", "L1", "TPSD", d(2024, 3, 31), 3, 80.0, 10.0, 10.0, 1, 1),
        ("u1", "L1", "TPFP", d(2024, 3, 31), 4, 70.0, 10.0, 10.0, 1, 1),   # switches twice
        ("u1", "L2", "TPSD", d(2024, 5, 1), 1, 50.0, 25.0, 25.0, 1, 1),    # one payment only
    ]
    schema = ("user_id string, loan_id string, vendor_id string, repaid_date date, installment_number int, "
              "outstanding_balance double, paid_amount double, paid_principal double, part_key long, supp_key long")
    return spark.createDataFrame(rows, schema)


def test_switch_dates_last_switch_plus_month(spark):
    out = ln.switch_dates(_repayments(spark)).collect()
    assert [(r.ee_customer_id, r.switch_resignation_date) for r in out] == [("u1", dt.date(2024, 4, 30))]


def test_ledger_invariants(spark):
    feats = spark.createDataFrame([("L1", 100.0), ("L2", 60.0)], "ln_loan_id string, ln_original_principal double")
    led = ln.balance_ledger(_repayments(spark), feats).orderBy("loan_id", "repaid_date", "installment_number").collect()
    assert [r.osbal_after for r in led] == [90.0, 80.0, 70.0, 60.0, 35.0]
    assert [r.osbal_before for r in led] == [100.0, 90.0, 80.0, 70.0, 60.0]
    for r in led:
        assert abs(r.osbal_before - r.paid_principal - r.osbal_after) < 1e-9


def test_sinks_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="scorewatch-sink-")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    sinks.publish_snapshot(df, f"{root}/snap", "2026-03-01")
    sinks.publish_snapshot(df.withColumn("v", F.lit(2)), f"{root}/snap", "2026-04-01")
    sinks.publish_snapshot(df.withColumn("v", F.lit(3)), f"{root}/snap", "2026-03-01")   # replaces one date only
    got = sorted((str(r.run_date), r.v) for r in sinks.read_snapshot(spark, f"{root}/snap").collect())
    assert got == [("2026-03-01", 3), ("2026-04-01", 2)]
    sinks.write_page(df, f"{root}/page")
    assert any(n.endswith(".csv") for n in os.listdir(f"{root}/page"))
    with pytest.raises(ValueError):
        sinks.write_table(df, f"{root}/x", fmt="xlsx")
