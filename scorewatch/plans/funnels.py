"""Onboarding -> resignation -> default funnels and the employee profile.

Funnel counts are taken over a cohort that is one row per employee (first
score run per employee, an aggregate pick), so the distinct counts of the
reference are plain sums of flags here: hash aggregates that combine
map-side. Month totals and month x segment rows come out of one pass as
two grouping levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import canonical_id, flag, month_label, safe_ratio, shift_months
from ..functions.scorecard import income_number, points_segment, tenure_years, total_points
from ..operators.keys import one_row_per_key, pick_first
from .ordered import carry_window
from .params import Params

UID = "user_id"
ALL = "ALL"

# Tags that mark an employee account as frozen.
FROZEN_TAGS = [39, 100, 101, 102, 103]


def _levels(df: DataFrame, keys: list[str], seg: str, aggs: list) -> DataFrame:
    """Aggregate by (keys, seg) and by keys alone (seg = 'ALL') in one pass
    (grouping sets; a real null segment stays null)."""
    out = df.groupingSets([[*keys, seg], keys], *keys, seg).agg(F.grouping(seg).alias("_lvl"), *aggs)
    return out.withColumn(seg, F.when(F.col("_lvl") == 1, F.lit(ALL)).otherwise(F.col(seg))).drop("_lvl")


def employee_profile(users: DataFrame, income_info: DataFrame, user_timelines: DataFrame, employers: DataFrame,
                     user_tag: DataFrame, credit_info: DataFrame,
                     product_types=("employer", "payroll"), activated: int = 2) -> DataFrame:
    """Tenure, income, frozen status and credit limit per activated employee."""
    frozen = user_tag.groupBy(UID).agg(F.max(flag(F.col("tag_id").isin(FROZEN_TAGS))).alias("frozen_tag"))
    u = users.where(F.col("product_type").isin(list(product_types)) & (F.col("account_activated") == activated))
    limit = credit_info.where(F.col("key") == "credit-limit").select(UID, F.col("value").alias("Credit_limit"))
    ii = income_info.select(UID, F.col("created_at").alias("income_created_at"), "employment_date",
                            F.col("employee_status").alias("employment_status"), "income", "verified_net_income")
    e = employers.select(F.col("id").cast("string").alias("employer_id"), F.col("name").alias("employer_name"))
    j = (u.select(F.col("id").alias(UID), F.col("created_at").alias("sign_up_date"), "employer_id", "gender",
                  "civil_status")
         .join(ii, UID, "left")
         .join(user_timelines.select(UID, F.col("first_account_activated_at").alias("ee_onboarding_date")), UID, "left")
         .join(e, "employer_id", "left")
         .join(frozen, UID, "left")
         .join(limit, UID, "inner"))
    return j.select(
        UID, "sign_up_date", "ee_onboarding_date", "employer_id", "employer_name", "employment_date",
        F.length("employment_date").alias("LENGTH_employment_date"),
        tenure_years("employment_date", "income_created_at").alias("employer_time"),
        "gender", "civil_status", "employment_status",
        income_number("income").alias("declared_income_num"), "verified_net_income",
        F.when(F.col("frozen_tag") == 1, "Frozen").otherwise("Not Frozen").alias("Frozen_Status"),
        "Credit_limit")


def onboarding_cohort(scores_api: DataFrame, user_timelines: DataFrame, p: Params, tie_break=()) -> DataFrame:
    """Employees activated in [funnel_from, funnel_to): first score run each."""
    t = one_row_per_key(user_timelines.select(canonical_id(UID).alias("employee_id"), "first_account_activated_at")
                        .where((F.col("first_account_activated_at") >= F.lit(p.funnel_from).cast("timestamp"))
                               & (F.col("first_account_activated_at") < F.lit(p.funnel_to).cast("timestamp"))), ["employee_id"])
    s = scores_api.select(canonical_id("ee_customer_id").alias("employee_id"), F.to_date("run_date").alias("run_date"),
                          *tie_break, F.col("oop_risk_segment_prod").alias("oop_risk_segment"))
    first = pick_first(s.join(t, "employee_id", "inner"), ["employee_id"], ["run_date", *tie_break])
    return first.select("employee_id", F.to_date("first_account_activated_at").alias("ee_onboarding_date"),
                        month_label(F.to_date("first_account_activated_at")).alias("Onboarding_month"),
                        "oop_risk_segment")


def _target_outcomes(targets: DataFrame, key: str) -> DataFrame:
    """Outcome, maturity and resignation date of the collection targets, one row per customer."""
    return one_row_per_key(targets.select(
        canonical_id(UID).alias(key), "target", "target_maturity_flag",
        F.to_date("ee_resignation_date_correct").alias("ee_resignation_date_correct")), [key])


def unit_funnel(cohort: DataFrame, targets: DataFrame, p: Params) -> DataFrame:
    """Onboarded -> left job -> matured -> bad, per month x segment and per month."""
    d = cohort.join(_target_outcomes(targets, "employee_id"), "employee_id", "left")
    left = F.col("ee_resignation_date_correct") < F.lit(p.funnel_left_before).cast("date")
    matured = F.col("target_maturity_flag") == 1
    out = _levels(d, ["Onboarding_month"], "oop_risk_segment", [
        F.count("employee_id").alias("cnt_onboarded"),
        F.sum(flag(left)).alias("cnt_left_job"),
        F.sum(flag(matured)).alias("cnt_had_oop_outstanding"),
        F.sum(flag(matured & (F.col("target") == 0))).alias("cnt_oop_flag_bad")])
    return out.withColumn("unit_rate_of_all_who_left_job",
                          F.bround(safe_ratio("cnt_oop_flag_bad", "cnt_left_job") * 100, 2))


def money_funnel(cohort: DataFrame, profile: DataFrame, targets: DataFrame, backscore_new: DataFrame,
                 p: Params) -> DataFrame:
    """Credit limit and balances of matured customers, per month x segment and per month.

    The two levels have their own measures: a segment row sums the balances
    of all its customers (the bad ones' current balance by outcome alone), a
    month row those of customers who left their job before the cutoff.
    """
    limits = one_row_per_key(profile.select(canonical_id(UID).alias("employee_id"),
                                            F.col("Credit_limit").try_cast("double").alias("credit_limit")), ["employee_id"])
    bal = one_row_per_key(backscore_new.select(
        canonical_id("ee_customer_id").alias("employee_id"), "osbal_as_of_resignation_date",
        "osbal_as_of_oop_eligible_date", "osbal_as_of_current_date"), ["employee_id"])
    matured = _target_outcomes(targets.where(F.col("target_maturity_flag") == 1), "employee_id")
    d = cohort.join(matured, "employee_id").join(limits, "employee_id", "left").join(bal, "employee_id", "left")
    left = F.col("ee_resignation_date_correct") < F.lit(p.funnel_left_before).cast("date")
    bad = F.col("target") == 0
    at_resignation, at_eligible = F.col("osbal_as_of_resignation_date"), F.col("osbal_as_of_oop_eligible_date")
    now = F.coalesce("osbal_as_of_current_date", F.lit(0.0))
    by_segment = F.grouping("oop_risk_segment") == 0
    measure = lambda segment, month, name: F.round(F.when(by_segment, F.sum(segment)).otherwise(F.sum(month)), 2).alias(name)
    return _levels(d, ["Onboarding_month"], "oop_risk_segment", [
        F.count("employee_id").alias("cnt_matured"),
        F.round(F.sum("credit_limit"), 2).alias("tot_credit_limit"),
        measure(at_resignation, F.when(left, at_resignation).otherwise(0.0), "tot_os_as_of_resignation"),
        measure(at_eligible, F.when(left, at_eligible).otherwise(0.0), "tot_os_as_of_oop_eligible"),
        measure(F.when(bad, now), F.when(left & bad, now), "tot_os_from_bad_customers")])


# ------------------------------------------------------------ points scorecard

def first_success(payment_responses: DataFrame, statuses=("PTOK", "CTOK")) -> DataFrame:
    """First successful payment date per user (the onboarding date)."""
    return (payment_responses.where(F.col("status").isin(list(statuses)))
            .groupBy(canonical_id("payer_user_id").alias(UID))
            .agg(F.min(F.to_date("created_at")).alias("onboarding_date")))


def points_scorecard(users: DataFrame, income_info: DataFrame, user_timelines: DataFrame,
                     product_types=("employer",)) -> DataFrame:
    """Points per attribute, total and A..F segment for activated users."""
    u = users.where(F.col("product_type").isin(list(product_types))).select(
        F.col("id").alias(UID), "gender", "civil_status")
    ii = income_info.select(UID, F.col("created_at").alias("income_created_at"), "employment_date", "income")
    ut = user_timelines.where(F.col("first_account_activated_at").isNotNull()).select(UID)
    d = (u.join(ii, UID, "left").join(ut, UID, "left_semi")
         .withColumn("employer_time", tenure_years("employment_date", "income_created_at"))
         .withColumn("declared_income_num", income_number("income")))
    scored = d.withColumn("score", total_points())
    return scored.select(canonical_id(UID).alias(UID), "score", points_segment("score").alias("risk_segment"))


def switch_resignation(repayment_responses: DataFrame, vendors=("TPSD", "TPFP"),
                       users: DataFrame | None = None) -> DataFrame:
    """Last TPSD -> TPFP switch per user + 1 month, from user-level repayment events (F2).

    ``users`` (one ``user_id`` column) restricts the events to the users a
    report needs before any ordering work (a semi join).
    """
    r = (repayment_responses.where(F.col("vendor_id").isin(list(vendors)) & F.col("repaid_at").isNotNull()
                                   & F.col(UID).isNotNull())
         .select(canonical_id(UID).alias(UID), "vendor_id", "repaid_at"))
    if users is not None:
        r = r.join(users.select(UID), UID, "left_semi")
    nxt = carry_window(r, [UID], ["repaid_at", "vendor_id"], nexts={"next_vendor": "vendor_id"})
    return (nxt.where((F.col("vendor_id") == vendors[0]) & (F.col("next_vendor") == vendors[1]))
            .groupBy(UID).agg(F.max(shift_months(F.to_date("repaid_at"), 1)).alias("resignation_date")))


def points_cohort(payment_responses: DataFrame, users: DataFrame, income_info: DataFrame,
                  user_timelines: DataFrame, p: Params) -> DataFrame:
    fs = first_success(payment_responses).where(
        F.col("onboarding_date").between(F.lit(p.points_from).cast("date"), F.lit(p.points_to).cast("date")))
    sc = points_scorecard(users, income_info, user_timelines)
    c = fs.join(sc, UID, "inner")
    return pick_first(c, [UID], ["risk_segment"])


def points_unit_funnel(cohort: DataFrame, targets: DataFrame, p: Params) -> DataFrame:
    """Per onboarding month: onboarded, left job, matured, bad, bad / matured.

    Who left the job is read from the matured target's resignation date.
    """
    tg = _target_outcomes(targets.where(F.col("target_maturity_flag") == 1), UID)
    d = cohort.join(tg, UID, "left")
    left = F.col("ee_resignation_date_correct") <= F.lit(p.points_left_by).cast("date")
    agg = d.groupBy(month_label("onboarding_date").alias("onboarding_month")).agg(
        F.count(UID).alias("cnt_onboarded"),
        F.sum(flag(left)).alias("cnt_left_job"),
        F.sum(flag(F.col("target_maturity_flag") == 1)).alias("cnt_had_oop_outstanding"),
        F.sum(flag(F.col("target") == 0)).alias("cnt_oop_flag_bad"))
    return agg.withColumn("unit_rate", F.bround(safe_ratio("cnt_oop_flag_bad", "cnt_had_oop_outstanding"), 2))


def points_money_funnel(cohort: DataFrame, credit_info: DataFrame, targets: DataFrame,
                        backscore_new: DataFrame, p: Params) -> DataFrame:
    """Credit limit and balances of customers with a matured target and a balance record.

    The rate is the bad customers' balance at the eligible date as a
    percentage of the leavers' balance at resignation.
    """
    limit = one_row_per_key(credit_info.where(F.col("key") == "credit-limit").select(
        canonical_id(UID).alias(UID), F.col("value").try_cast("double").alias("credit_limit")), [UID])
    tg = _target_outcomes(targets.where(F.col("target_maturity_flag") == 1), UID)
    bal = one_row_per_key(backscore_new.select(canonical_id("ee_customer_id").alias(UID), "osbal_as_of_resignation_date",
                                               "osbal_as_of_oop_eligible_date"), [UID])
    d = cohort.join(bal, UID).join(tg, UID).join(limit, UID, "left")
    left = F.col("ee_resignation_date_correct") <= F.lit(p.points_left_by).cast("date")
    agg = d.groupBy(month_label("onboarding_date").alias("onboarding_month")).agg(
        F.round(F.sum("credit_limit"), 2).alias("tot_credit_limit"),
        F.round(F.sum(F.when(left, F.col("osbal_as_of_resignation_date"))), 2).alias("tot_os_as_of_resignation"),
        F.round(F.sum("osbal_as_of_oop_eligible_date"), 2).alias("tot_os_as_of_oop_eligible"),
        F.round(F.sum(F.when(F.col("target") == 0, F.col("osbal_as_of_oop_eligible_date"))), 2).alias("tot_os_from_bad_customers"))
    return agg.withColumn("peso_rate", F.bround(safe_ratio("tot_os_from_bad_customers", "tot_os_as_of_resignation") * 100, 4))
