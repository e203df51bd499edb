"""Hand-made fixtures for the funnels and lookups; expected numbers are worked out by hand from the reports' rules."""

import datetime as dt
from dataclasses import replace

from scorewatch.plans import funnels as fn
from scorewatch.plans import lineage as ln
from scorewatch.plans import portfolio as pf
from scorewatch.plans.frames import balances, lookup_audit, matured_targets
from scorewatch.plans.params import TESTDATA

P = replace(TESTDATA, funnel_left_before="2000-02-01", points_left_by="2000-03-01")
D = dt.date
TARGETS = "user_id string, target int, target_maturity_flag int, ee_resignation_date_correct date"
BALANCES = ("ee_customer_id string, score_oop double, osbal_as_of_resignation_date double, osbal_as_of_oop_eligible_date double, "
            "osbal_as_of_current_date double")


def _tables(spark):
    cohort = spark.createDataFrame([("1", D(1996, 1, 5), "1996-01", "A"), ("2", D(1996, 1, 6), "1996-01", "A"), ("3", D(1996, 1, 7), "1996-01", "B"),
                                    ("4", D(1996, 1, 8), "1996-01", "B")],
                                   "employee_id string, ee_onboarding_date date, Onboarding_month string, oop_risk_segment string")
    targets = spark.createDataFrame([("1", 0, 1, D(2000, 1, 1)),     # matured, bad, left before the cutoff
                                     ("2", 0, 1, D(2000, 5, 1)),     # matured, bad, left after it
                                     ("3", 1, 1, None),              # matured, good, never left
                                     ("4", 0, 0, D(1999, 1, 1))],    # not matured
                                    TARGETS)
    bal = spark.createDataFrame([("1", 0.5, 100.0, 80.0, 60.0), ("2", 0.5, 50.0, 40.0, None), ("3", 0.5, 10.0, 8.0, 6.0), ("4", 0.5, 1.0, 1.0, 1.0)], BALANCES)
    profile = spark.createDataFrame([("1", "1000"), ("2", "500"), ("3", "bad text"), ("4", "7")], "user_id string, Credit_limit string")
    return cohort, targets, bal, profile


def test_unit_funnel_reads_the_targets_dates(spark):
    cohort, targets, _, _ = _tables(spark)
    rows = {r.oop_risk_segment: r for r in fn.unit_funnel(cohort, targets, P).collect()}
    assert [(rows[s].cnt_onboarded, rows[s].cnt_left_job, rows[s].cnt_had_oop_outstanding, rows[s].cnt_oop_flag_bad)
            for s in ("A", "B", "ALL")] == [(2, 1, 2, 2), (2, 1, 1, 0), (4, 2, 3, 2)]


def test_money_funnel_has_separate_measures_per_level(spark):
    cohort, targets, bal, profile = _tables(spark)
    rows = {r.oop_risk_segment: tuple(r)[2:] for r in fn.money_funnel(cohort, profile, targets, bal, P).collect()}
    # Segment A: customers 1 and 2 whatever their dates; month: only customer 1 left before the cutoff.
    assert rows["A"] == (2, 1500.0, 150.0, 120.0, 60.0)
    assert rows["B"] == (1, None, 10.0, 8.0, None)
    assert rows["ALL"] == (3, 1500.0, 100.0, 80.0, 60.0)


def test_points_funnels(spark):
    _, targets, bal, _ = _tables(spark)
    cohort = spark.createDataFrame([(u, D(2022, 7, 1), "A") for u in ("1", "2", "3", "4", "5")], "user_id string, onboarding_date date, risk_segment string")
    unit = fn.points_unit_funnel(cohort, targets, P).collect()
    assert [tuple(r) for r in unit] == [("2022-07", 5, 1, 3, 2, 0.67)]
    credit = spark.createDataFrame([("1", "credit-limit", "1000"), ("3", "credit-limit", "x"), ("5", "credit-limit", "9"), ("2", "other", "7")],
                                   "user_id string, key string, value string")
    money = fn.points_money_funnel(cohort, credit, targets, bal, P).collect()
    # Customers 1, 2, 3 have a matured target and a balance; 1 left by the date: 100; bad: 80 + 40; 120 / 100 * 100.
    assert [tuple(r) for r in money] == [("2022-07", 1000.0, 100.0, 128.0, 120.0, 120.0)]


def test_a_repeated_lookup_key_does_not_multiply_rows(spark):
    cohort, targets, bal, profile = _tables(spark)
    again = lambda d: d.union(d).union(d.limit(1))
    once, twice = fn.money_funnel(cohort, profile, targets, bal, P), fn.money_funnel(cohort, again(profile), again(targets), again(bal), P)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert matured_targets(again(targets)).count() == 3 and balances(again(bal), True).count() == 4
    onb = spark.createDataFrame([("1", None), ("1", D(1996, 1, 1))], "ee_customer_id string, ee_onboarding_date date")
    runs = spark.createDataFrame([("1", D(1996, 2, 1), 5.0), ("1", D(1996, 3, 1), 7.0)], "ee_customer_id string, run_date date, credit_limit double")
    master = pf.scorecard_master(runs, onb).collect()
    assert len(master) == 2 and {r.onboarding_date for r in master} == {D(1996, 1, 1)}
    ex = spark.createDataFrame([("1", D(1996, 2, 1), 0.5), ("1", D(1996, 2, 9), 0.6)], "ee_customer_id string, calc_date date, score_oop double")
    res = targets.selectExpr("user_id AS ee_customer_id", "ee_resignation_date_correct")
    audit = {r.lookup: (r.n_rows, r.n_keys, r.n_repeated_keys) for r in lookup_audit(again(targets), bal, res, ex, ex, onb).collect()}
    assert audit["matured_targets"] == (7, 3, 3) and audit["rescored_repay"] == (2, 1, 1) and audit["onboarding"] == (2, 1, 1)


def test_ledger_keeps_rows_without_loan_date_or_amount(spark):
    events = spark.createDataFrame([("u", "L", "TPSD", D(2000, 1, 1), 1, 9.0, 1.0, 10.0), ("u", "L", "TPSD", D(2000, 2, 1), 2, 8.0, 1.0, None),
                                    ("u", "L", "TPFP", D(2000, 3, 1), 3, 7.0, 1.0, 20.0), ("u", "L", "TPFP", None, 4, 6.0, 1.0, 5.0),
                                    ("u", None, "TPSD", D(2000, 1, 1), 1, 9.0, 1.0, 3.0), ("u", None, "TPFP", D(2000, 1, 2), 2, 9.0, 1.0, 3.0)],
                                   "user_id string, loan_id string, vendor_id string, repaid_date date, installment_number int, "
                                   "outstanding_balance double, paid_amount double, paid_principal double")
    loans = spark.createDataFrame([("L", 100.0), ("L", 100.0)], "ln_loan_id string, ln_original_principal double")
    rows = sorted(ln.balance_ledger(events, loans).collect(), key=lambda r: (r.loan_id is None, r.installment_number))
    assert [(r.cumulative_paid_principal, r.osbal_after, r.osbal_before) for r in rows] == [
        (10.0, 90.0, 100.0), (None, None, 90.0), (30.0, 70.0, 100.0), (35.0, 65.0, 70.0), (None, None, None), (None, None, None)]
    # The switch needs a loan: installment 2 to 3 on 2000-02-01.
    assert [tuple(r) for r in ln.switch_dates(events).collect()] == [("u", D(2000, 3, 1))]


def test_all_customer_bad_rates_count_one_run_per_customer(spark):
    """Three runs of one bad leaver are one customer in counts and sums alike."""
    import datetime as dt

    from scorewatch.plans import portfolio as pf
    from scorewatch.plans.params import REFERENCE as p
    d = dt.date.fromisoformat(p.bad_rate_from)
    master = spark.createDataFrame([("a", d, 1, 100.0, d), ("a", d + dt.timedelta(days=9), 2, 900.0, d), ("a", d + dt.timedelta(days=20), 3, 900.0, d),
                                    ("b", d, 4, 50.0, d), (None, d, 5, 7.0, d)],
                                   "ee_customer_id string, run_date date, run_key int, credit_limit double, onboarding_date date")
    resignation = spark.createDataFrame([("a", d)], "ee_customer_id string, ee_resignation_date_correct date")
    balances = spark.createDataFrame([("a", 0.5, 10.0, 8.0, 6.0)], "ee_customer_id string, score_oop double, osbal_as_of_resignation_date double, "
                                     "osbal_as_of_oop_eligible_date double, osbal_as_of_current_date double")
    targets = spark.createDataFrame([("a", 0, 1, d)], "user_id string, target int, target_maturity_flag int, ee_resignation_date_correct date")
    base = pf.onboarded_base(master, resignation, balances, targets, p, ("run_key",))
    unit, money = pf.onboarded_unit_bad_rate(base, "m").collect()[0], pf.onboarded_peso_bad_rate(base, "m").collect()[0]
    assert (unit.CntOnboarded, unit.CntLeftJob, unit.CntHadOopOutstanding, unit.CntOopFlagBad) == (2, 1, 1, 1)
    assert (money.TotCLAmt, money.TotOsAsOfResignation, money.TotOsAsOfOopEligible, money.TotOsFromBadCustomers) == (150.0, 10.0, 8.0, 6.0)
