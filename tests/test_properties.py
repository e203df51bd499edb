"""Invariants on the report outputs, on the sf0.01 test tables."""

import math

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def out(spark):
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = queries()[name](spark, SF).collect()
        return cache[name]
    return get


def test_funnel_monotone(out):
    for r in out("r12_unit_funnel"):
        assert r.cnt_oop_flag_bad <= r.cnt_had_oop_outstanding <= r.cnt_onboarded
        assert r.cnt_left_job <= r.cnt_onboarded
    for r in out("r14_points_unit_funnel"):
        assert r.cnt_oop_flag_bad <= r.cnt_had_oop_outstanding <= r.cnt_onboarded


def test_funnel_month_rows_are_sums_of_segments(out):
    rows = out("r12_unit_funnel")
    by_month = {}
    for r in rows:
        if r.oop_risk_segment != "ALL":
            by_month[r.Onboarding_month] = by_month.get(r.Onboarding_month, 0) + r.cnt_onboarded
    for r in rows:
        if r.oop_risk_segment == "ALL":
            assert r.cnt_onboarded == by_month[r.Onboarding_month]


def test_disjoint_periods_add_up_for_one_row_per_customer_series(out):
    rows = [r for r in out("r1_model_performance") if r.Period != "Dev"]
    new_users = {(r.Model, r.ModelVersion): {} for r in rows if r.UserType.startswith("New") and r.ModelVersion.startswith("v1")}
    for r in rows:
        if (r.Model, r.ModelVersion) in new_users and r.UserType.startswith("New"):
            new_users[(r.Model, r.ModelVersion)][r.Period] = r.Sample_Size
    for sizes in new_users.values():
        assert sizes["1996"] + sizes["1997"] == sizes["1996-1997"]
        assert sizes["2010"] == 0


def test_rank_order_ratios_recompute(out):
    for r in out("r3_repay_rank_order_new") + out("r4_repay_rank_order_existing"):
        if r.Sum_Osbal_Resignation:
            want = r.Sum_Osbal_Bads_Today / r.Sum_Osbal_Resignation * 100
            assert abs(r.Outstanding_Bad_Rate - want) <= 0.05 + 1e-9
        else:
            assert r.Outstanding_Bad_Rate is None


def test_bad_rates_null_exactly_on_zero_denominator_and_not_clamped(out):
    for r in out("r7_unit_bad_rate"):
        assert (r.UnitBadRate is None) == (r.CntLeftJob == 0)
    for r in out("r8_peso_bad_rate"):
        assert (r.PesoBadRate is None) == (r.TotOsAsOfOopEligible == 0)
        if r.PesoBadRate is not None:
            assert math.isclose(r.PesoBadRate, r.TotOsFromBadCustomers / r.TotOsAsOfOopEligible)


def test_ledger_balance_identity(out):
    rows = out("r18_balance_ledger")
    whole = [r for r in rows if r.loan_id is not None and r.paid_principal is not None]
    assert 0.9 * len(rows) < len(whole) < len(rows)            # the inputs also hold events without a loan or an amount
    for r in whole:
        assert abs(r.ln_original_principal - r.cumulative_paid_principal - r.osbal_after) < 0.011
        # The balance before is the balance after plus the payment, or the principal where a loan starts (again).
        assert abs(r.osbal_before - r.paid_principal - r.osbal_after) < 0.011 or r.osbal_before == r.ln_original_principal
    restarted = [r for r in whole if abs(r.osbal_before - r.paid_principal - r.osbal_after) >= 0.011]
    assert len(restarted) <= sum(r.loan_id is not None and r.paid_principal is None for r in rows)
    for r in rows:
        if r.loan_id is None or r.paid_principal is None:
            assert r.cumulative_paid_principal is None and r.osbal_after is None


def test_resignation_one_row_per_customer(out):
    rows = out("r17_resignation_resolution")
    assert len({r.ee_customer_id for r in rows}) == len(rows)
    tags = {r.resignation_tag for r in rows}
    assert {"valid", "convertible", "invalid", "null"} <= tags
