"""Bad rates by onboarding month and credit-limit exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import change_category, cohort_label, user_mix_type
from ..functions.core import canonical_id, flag, month_key, month_label, pct, safe_ratio
from ..operators.keys import first_and_last, one_row_per_key, pick_first
from . import frames as fr
from .params import Params

CID = fr.CID


def _money(c, digits=2):
    return F.round(F.coalesce(c, F.lit(0.0)), digits)


def outcome_base(oop_new: DataFrame, resignation: DataFrame, p: Params) -> DataFrame:
    """Customer-level flags behind pages 7 and 8 (one row per customer)."""
    resign = fr.resignation_lookup(resignation)
    b = oop_new.join(resign, CID, "left")
    left = flag(F.col("ee_resignation_date_correct") <= F.lit(p.left_job_cutoff).cast("date"))
    had = flag(F.coalesce(F.col("osbal_as_of_resignation_date"), F.lit(0.0)) > 0)
    return (b.withColumn("Scorecard", F.when(F.col("onboarding_date_ym") >= p.sc2_live_ym, F.lit("SC 2.0"))
                         .otherwise(F.lit("SC 1.0")))
            .withColumn("OnboardingMonth", month_label("ee_onboarding_date"))
            .withColumn("left_job", left)
            .withColumn("had_oop_outstanding", had)
            .withColumn("oop_flag_bad", flag((left == 1) & (had == 1) & (F.col("oop_target") == 0)))
            .withColumn("bad_if_left", flag((left == 1) & (F.col("oop_target") == 0))))


def unit_bad_rate(base: DataFrame, run_month: str) -> DataFrame:
    """Counts and unit bad rate per (Scorecard, OnboardingMonth)."""
    agg = base.groupBy("Scorecard", "OnboardingMonth").agg(
        F.count(CID).alias("CntOnboarded"),
        F.sum("left_job").alias("CntLeftJob"),
        F.sum(F.col("left_job") * F.col("had_oop_outstanding")).alias("CntHadOopOutstanding"),
        F.sum("oop_flag_bad").alias("CntOopFlagBad"))
    rate = safe_ratio("CntOopFlagBad", "CntLeftJob")
    return agg.select("*", rate.alias("UnitBadRate"), pct(rate, 2).alias("UnitBadRate_Pct"),
                      F.lit(run_month).alias("RunMonth"))


def peso_bad_rate(base: DataFrame, run_month: str) -> DataFrame:
    """Balances of leavers and of bad leavers; ratio of the reported totals."""
    left = F.col("left_job") == 1
    agg = base.groupBy("Scorecard", "OnboardingMonth").agg(
        _money(F.sum(F.when(left, F.coalesce("osbal_as_of_resignation_date", F.lit(0.0))).otherwise(0.0)))
        .alias("TotOsAsOfResignation"),
        _money(F.sum(F.when(left, F.coalesce("osbal_as_of_oop_eligible_date", F.lit(0.0))).otherwise(0.0)))
        .alias("TotOsAsOfOopEligible"),
        _money(F.sum(F.when(F.col("bad_if_left") == 1, F.coalesce("osbal_as_of_current_date", F.lit(0.0)))
                     .otherwise(0.0))).alias("TotOsFromBadCustomers"))
    rate = safe_ratio("TotOsFromBadCustomers", "TotOsAsOfOopEligible")
    return agg.select("*", rate.alias("PesoBadRate"), pct(rate, 2).alias("PesoBadRate_Pct"),
                      F.lit(run_month).alias("RunMonth"))


def onboarded_base(master: DataFrame, resignation: DataFrame, balances: DataFrame, targets: DataFrame, p: Params, tie_break=()) -> DataFrame:
    """Rows behind the all-customers form of pages 7 and 8: the first score run of every customer onboarded
    in the window, with its credit limit, so counts and sums are all per customer; a matured target is
    optional (its filter sits in the join)."""
    first = pick_first(master.where(F.col(CID).isNotNull()), [CID], ["run_date", *tie_break], ["credit_limit", "onboarding_date"])
    m = first.where(F.col("onboarding_date").between(F.lit(p.bad_rate_from).cast("date"), F.lit(p.bad_rate_to).cast("date")))
    b = (m.join(fr.resignation_lookup(resignation), CID, "left").join(fr.balances(balances, with_score=False), CID, "left")
         .join(fr.matured_targets(targets), CID, "left"))
    return b.select(
        CID, F.when(month_key("onboarding_date") >= p.sc2_live_ym, F.lit("SC 2.0")).otherwise(F.lit("SC 1.0")).alias("Scorecard"),
        month_label("onboarding_date").alias("OnboardingMonth"), "credit_limit", "oop_target",
        flag(F.col("ee_resignation_date_correct") <= F.lit(p.left_job_cutoff).cast("date")).alias("left_job"),
        flag(F.col("osbal_as_of_resignation_date") > 0).alias("had_oop_outstanding"),
        "osbal_as_of_resignation_date", "osbal_as_of_oop_eligible_date", "osbal_as_of_current_date")


def onboarded_unit_bad_rate(base: DataFrame, run_month: str) -> DataFrame:
    """R7 over all onboarded customers, one row each."""
    had = F.col("left_job") * F.col("had_oop_outstanding")
    agg = base.groupBy("Scorecard", "OnboardingMonth").agg(
        F.count(CID).alias("CntOnboarded"), F.sum("left_job").alias("CntLeftJob"), F.sum(had).alias("CntHadOopOutstanding"),
        F.sum(F.when(F.col("oop_target") == 0, had).otherwise(0)).alias("CntOopFlagBad"))
    rate = safe_ratio("CntOopFlagBad", "CntLeftJob")
    return agg.select("*", rate.alias("UnitBadRate"), pct(rate, 2).alias("UnitBadRate_Pct"), F.lit(run_month).alias("RunMonth"))


def onboarded_peso_bad_rate(base: DataFrame, run_month: str) -> DataFrame:
    """R8 over all onboarded customers, with the credit limit granted (TotCLAmt)."""
    left = F.col("left_job") == 1
    leavers = lambda c, more=None: F.round(F.sum(F.when(left if more is None else left & more, F.col(c)).otherwise(0.0)), 2)
    agg = base.groupBy("Scorecard", "OnboardingMonth").agg(
        F.round(F.sum("credit_limit"), 2).alias("TotCLAmt"),
        leavers("osbal_as_of_resignation_date").alias("TotOsAsOfResignation"),
        leavers("osbal_as_of_oop_eligible_date").alias("TotOsAsOfOopEligible"),
        leavers("osbal_as_of_current_date", F.col("oop_target") == 0).alias("TotOsFromBadCustomers"))
    rate = safe_ratio("TotOsFromBadCustomers", "TotOsAsOfOopEligible")
    return agg.select("*", rate.alias("PesoBadRate"), pct(rate, 2).alias("PesoBadRate_Pct"), F.lit(run_month).alias("RunMonth"))


def scorecard_master(scores_api: DataFrame, onboarding: DataFrame, tie_break=()) -> DataFrame:
    """Scores with credit limit and onboarding date, one row per run."""
    s = scores_api.select(canonical_id(CID).alias(CID), F.to_date("run_date").alias("run_date"), *tie_break,
                          F.col("credit_limit").cast("double").alias("credit_limit"))
    onb = one_row_per_key(onboarding.select(canonical_id(CID).alias(CID), F.to_date("ee_onboarding_date").alias("onboarding_date")), [CID])
    return s.join(onb, CID, "left")


def _exposure(delta: DataFrame, run_month: str) -> DataFrame:
    """Users, limits and change per category; ``delta`` has one row per user: old_cl, new_cl."""
    agg = (delta.withColumn("CLCategory", change_category("old_cl", "new_cl")).groupBy("CLCategory").agg(
        F.count(F.lit(1)).alias("UserCount"), _money(F.sum("old_cl")).alias("SumOldCL"), _money(F.sum("new_cl")).alias("SumNewCL"),
        _money(F.sum(F.col("new_cl") - F.col("old_cl"))).alias("CLDelta")))
    rate = safe_ratio("CLDelta", "SumOldCL")
    return agg.select("*", rate.alias("PctCLIncrease"), pct(rate, 1).alias("PctCLIncrease_Pct"), F.lit(run_month).alias("RunMonth"))


def cl_exposure(master: DataFrame, p: Params, tie_break=()) -> DataFrame:
    """Credit-limit change of existing users (onboarded before launch).

    old = first limit per customer, new = last (E9, by run date then the
    tie-break), both from one aggregate; limits that are null are left out,
    so a customer in the result has both (D8, D9).
    """
    pre = master.where(month_key("onboarding_date") < p.cl_launch_ym).where(F.col("credit_limit").isNotNull())
    return _exposure(first_and_last(pre, [CID], "credit_limit", ["run_date", *tie_break], "old_cl", "new_cl"), p.run_month)


def cl_change_exposure(changes: DataFrame, p: Params) -> DataFrame:
    """R9 from explicit before/after limits of existing users who have a start date."""
    kept = changes.where(F.col("is_existing_user") & F.col("cl_plus_start_date").isNotNull()) \
        .select(canonical_id("user_id").alias("user_id"), F.col("old_cl").cast("double").alias("old_cl"),
                F.col("new_cl").cast("double").alias("new_cl"))
    return _exposure(one_row_per_key(kept, ["user_id"]), p.run_month)


def cohort_exposure(master: DataFrame, cl_summary: DataFrame, p: Params, tie_break=()) -> DataFrame:
    """Limit by onboarding cohort (first run per customer) + user mix share.

    ``CohortOrder`` is the cohort's earliest onboarding date, by which the
    page is ordered (G3).
    """
    first = pick_first(master, [CID], ["run_date", *tie_break], ["credit_limit", "onboarding_date"])
    cohort = (first.groupBy(cohort_label("onboarding_date", p.cohort_before, p.cohorts, p.cohort_rest)
                            .alias("OnboardingCohort"))
              .agg(F.count(CID).alias("UserCount"), _money(F.sum("credit_limit")).alias("SumNewCL"),
                   F.min("onboarding_date").alias("CohortOrder"))
              .withColumn("TableType", F.lit("CohortCL")))
    mix = (cl_summary.groupBy(user_mix_type("is_new_user", "has_cl_plus").alias("UserType"))
           .agg(F.count_distinct(canonical_id("user_id")).alias("UserCount"))
           .withColumn("TableType", F.lit("UserMix")))
    # Share of the total over the (four-row) aggregate.
    share = safe_ratio(F.col("UserCount"), F.sum("UserCount").over(Window.partitionBy("TableType")))
    mix = mix.withColumn("Pct", share).withColumn("Pct_Pct", pct("Pct", 1))
    return cohort.unionByName(mix, allowMissingColumns=True).withColumn("RunMonth", F.lit(p.run_month))


def utilisation(snapshot: DataFrame, p: Params) -> DataFrame:
    """Limit, unpaid principal and utilisation per report month."""
    d = F.col("report_month_end")
    agg = (snapshot.where(d.between(F.lit(p.utilisation_from).cast("date"), F.lit(p.as_of).cast("date")))
           .groupBy(month_label(d).alias("ReportMonth"))
           .agg(_money(F.sum("credit_limit")).alias("CreditLimit"),
                _money(F.sum("unpaid_principal_balance")).alias("UnpaidPrincipal")))
    rate = safe_ratio("UnpaidPrincipal", "CreditLimit")
    return agg.select("*", rate.alias("UtilizationRate"), pct(rate, 1).alias("UtilizationRate_Pct"),
                      F.lit(p.run_month).alias("RunMonth"))
