"""Base and master frames the monitoring reports are built from.

Every function is pure (DataFrame in, DataFrame out). All joins are on the
canonical customer id; every lookup is reduced to one row per key (or per
key and month) before it is joined, so a repeated key cannot multiply rows
(the smallest row stays; ``lookup_audit`` reports repeats). Lookups are small
next to the score tables and Spark broadcasts them when its size estimate
allows; the score side is never broadcast. Picks of one row per customer are
aggregates (see ``operators.keys``), not windows, and end in the caller's
tie-break columns, then in all other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import attrition_band, inf_to_open_ended, open_ended_to_number
from ..functions.core import canonical_id, day_distance, event_flag, key_of, month_key, months_diff, shift_months
from ..operators.keys import dedup_on, one_row_per_key, pick_first

CID = "ee_customer_id"


def _onboarding_lookup(onboarding: DataFrame) -> DataFrame:
    return one_row_per_key(onboarding.select(key_of(onboarding, CID).alias(CID),
                                             F.to_date("ee_onboarding_date").alias("ee_onboarding_date"))
                           .where(F.col(CID).isNotNull()), [CID])


def _with_onboarding(scores: DataFrame, onboarding: DataFrame) -> DataFrame:
    return (scores.join(_onboarding_lookup(onboarding), CID, "left")
            .withColumn("run_date_ym", month_key("run_date"))
            .withColumn("onb_rd_diff", day_distance("run_date", "ee_onboarding_date"))
            .withColumn("onboarding_date_ym", month_key("ee_onboarding_date")))


def _score_columns(scores: DataFrame, tie_break) -> list:
    return [key_of(scores, CID).alias(CID), *tie_break, "attrition_risk_segment", "attrition_time_to_leave",
            F.col("oop_score_prod").cast("double").alias("oop_score_prod"), "oop_risk_segment_prod"]


def prod_api_base(scores_api: DataFrame, onboarding: DataFrame, tie_break=()) -> DataFrame:
    """New-user production scores: run date truncated to the day."""
    s = scores_api.select(*_score_columns(scores_api, tie_break), F.to_date("run_date").alias("run_date"))
    return _with_onboarding(s, onboarding)


def prod_batch_base(scores_batch: DataFrame, onboarding: DataFrame, tie_break=()) -> DataFrame:
    """Existing-user production scores, duplicates on the four score columns removed (H4)."""
    s = scores_batch.select(*_score_columns(scores_batch, tie_break), "run_date")
    s = dedup_on(s, [CID, "run_date", "attrition_time_to_leave", "oop_score_prod"], list(tie_break))
    return _with_onboarding(s, onboarding)


def matured_targets(targets: DataFrame) -> DataFrame:
    """A2: matured repay outcomes, one row per customer."""
    return one_row_per_key(targets.where(F.col("target_maturity_flag") == 1)
                           .select(key_of(targets, "user_id").alias(CID), F.col("target").cast("int").alias("oop_target")), [CID])


def balances(backscore_new: DataFrame, with_score: bool) -> DataFrame:
    cols = [key_of(backscore_new, CID).alias(CID), "osbal_as_of_resignation_date",
            "osbal_as_of_oop_eligible_date", "osbal_as_of_current_date"]
    if with_score:
        cols.insert(1, F.col("score_oop").cast("double").alias("score_oop"))
    return one_row_per_key(backscore_new.select(*cols), [CID])


def _calc_month(df: DataFrame) -> DataFrame:
    """Re-scored tables are dated the month after the data month."""
    return (df.withColumn("calc_date_correct", shift_months("calc_date", -1))
            .withColumn("calc_date_ym", month_key("calc_date_correct")))


def _closest(df: DataFrame, tie_break=()) -> DataFrame:
    """One row per onboarded customer, closest run to onboarding, then earliest."""
    return pick_first(df.where(F.col("ee_onboarding_date").isNotNull()), [CID], ["onb_rd_diff", "run_date", *tie_break])


def _month_lookup(df: DataFrame, columns: list[str]) -> DataFrame:
    """Re-scored rows by (customer, data month), one row per key."""
    return one_row_per_key(df.select(CID, F.col("calc_date_ym").alias("run_date_ym"), *columns), [CID, "run_date_ym"])


def _rescored_repay(backscore_existing: DataFrame) -> DataFrame:
    return _month_lookup(_calc_month(backscore_existing.select(
        key_of(backscore_existing, CID).alias(CID), "calc_date", F.col("score_oop").cast("double").alias("score_oop"))), ["score_oop"])


def oop_new_calc(api_base: DataFrame, targets: DataFrame, backscore_new: DataFrame, tie_break=()) -> DataFrame:
    """The target is per customer, so the run is picked before the lookups are joined."""
    return (_closest(api_base, tie_break).join(matured_targets(targets), CID, "left")
            .join(balances(backscore_new, with_score=True), CID, "left")
            .withColumn("osbal_as_of_oop_eligible_date_log", F.log1p("osbal_as_of_oop_eligible_date"))
            .where(F.col("oop_target").isNotNull()))


def oop_existing_calc(batch_base: DataFrame, targets: DataFrame, backscore_new: DataFrame,
                      backscore_existing: DataFrame) -> DataFrame:
    bse = _rescored_repay(backscore_existing)
    j = (batch_base.join(matured_targets(targets), CID, "left")
         .join(balances(backscore_new, with_score=False), CID, "left")
         .join(bse, [CID, "run_date_ym"], "left")
         .withColumn("osbal_as_of_oop_eligible_date_log", F.log1p("osbal_as_of_oop_eligible_date")))
    return j.where(F.col("ee_onboarding_date").isNotNull() & F.col("oop_target").isNotNull())


# ---------------------------------------------------------------- attrition

def resignation_lookup(resignation: DataFrame) -> DataFrame:
    return one_row_per_key(resignation.select(key_of(resignation, CID).alias(CID),
                                              F.to_date("ee_resignation_date_correct").alias("ee_resignation_date_correct")), [CID])


def attrition_scores(backscore_attrition: DataFrame) -> DataFrame:
    bs = backscore_attrition.select(key_of(backscore_attrition, CID).alias(CID), "calc_date",
                                    F.col("score_attr").cast("double").alias("score_attr"),
                                    "score_attr_segment", "ee_onboarding_month", "is_new_customer_flag_3m")
    bs = _calc_month(bs)
    return bs.withColumn("is_new_customer_flag_1m",
                         (F.col("ee_onboarding_month") == F.col("calc_date_ym")).cast("int"))


def with_attrition_targets(df: DataFrame, score_date: str) -> DataFrame:
    """Months to resignation, event flag, +inf -> 15."""
    resign = F.col("ee_resignation_date_correct")
    return (df.withColumn("time_to_attrition", months_diff(resign, F.col(score_date)).cast("double"))
            .withColumn("attrition_event", event_flag(resign))
            .withColumn("score_attr_corrected", inf_to_open_ended("score_attr")))


def _with_prod_attrition(df: DataFrame) -> DataFrame:
    return (df.withColumn("attrition_score_prod", open_ended_to_number("attrition_time_to_leave"))
            .withColumn("attrition_risk_segment_prod", attrition_band("attrition_score_prod")))


def _attach_attrition(base: DataFrame, resignation: DataFrame, bs_attr: DataFrame) -> DataFrame:
    right = _month_lookup(bs_attr, ["score_attr", "score_attr_segment", "is_new_customer_flag_1m"])
    return (base.join(resignation_lookup(resignation), CID, "left")
            .join(right, [CID, "run_date_ym"], "left")
            .where(F.col("ee_onboarding_date").isNotNull()))


def attr_prod_api_calc(api_base: DataFrame, resignation: DataFrame, backscore_attrition: DataFrame, tie_break=()) -> DataFrame:
    j = _attach_attrition(_closest(api_base, tie_break), resignation, attrition_scores(backscore_attrition))
    return _with_prod_attrition(with_attrition_targets(j, "run_date"))


def attr_prod_batch_calc(batch_base: DataFrame, resignation: DataFrame, backscore_attrition: DataFrame) -> DataFrame:
    j = _attach_attrition(batch_base, resignation, attrition_scores(backscore_attrition))
    return _with_prod_attrition(with_attrition_targets(j, "run_date"))


def attr_bs_calc(backscore_attrition: DataFrame, resignation: DataFrame, new_users: bool) -> DataFrame:
    """Re-scored attrition: new users = onboarded in the score month,
    existing = not new within three months."""
    bs = attrition_scores(backscore_attrition).join(resignation_lookup(resignation), CID, "left")
    cond = (F.col("is_new_customer_flag_1m") == 1) if new_users else (F.col("is_new_customer_flag_3m") == 0)
    return with_attrition_targets(bs.where(cond), "calc_date_correct")


# ------------------------------------------------------- one pass, many series

def new_user_outcomes(api_base: DataFrame, targets: DataFrame, backscore_new: DataFrame, resignation: DataFrame,
                      backscore_attrition: DataFrame, tie_break=()) -> DataFrame:
    """One row per new customer (closest run to onboarding) with every
    outcome and score the new-user series need.

    The repay series drop customers without a matured target before the
    pick; the target is per customer, so picking first and filtering later
    selects the same run.
    """
    pick = _closest(api_base, tie_break)
    bs = _month_lookup(attrition_scores(backscore_attrition), ["score_attr", "score_attr_segment"])
    j = (pick.join(matured_targets(targets), CID, "left")
         .join(balances(backscore_new, with_score=True), CID, "left")
         .join(resignation_lookup(resignation), CID, "left")
         .join(bs, [CID, "run_date_ym"], "left")
         .withColumn("osbal_as_of_oop_eligible_date_log", F.log1p("osbal_as_of_oop_eligible_date")))
    return _with_prod_attrition(with_attrition_targets(j, "run_date"))


def existing_user_outcomes(batch_base: DataFrame, targets: DataFrame, backscore_new: DataFrame,
                           backscore_existing: DataFrame, resignation: DataFrame,
                           backscore_attrition: DataFrame) -> DataFrame:
    """One row per existing-user run with every outcome and score the
    existing-user series need (all lookups are one row per key)."""
    bse = _rescored_repay(backscore_existing)
    bs = _month_lookup(attrition_scores(backscore_attrition), ["score_attr", "score_attr_segment"])
    j = (batch_base.where(F.col("ee_onboarding_date").isNotNull())
         .join(matured_targets(targets), CID, "left")
         .join(balances(backscore_new, with_score=False), CID, "left")
         .join(bse, [CID, "run_date_ym"], "left")
         .join(resignation_lookup(resignation), CID, "left")
         .join(bs, [CID, "run_date_ym"], "left")
         .withColumn("osbal_as_of_oop_eligible_date_log", F.log1p("osbal_as_of_oop_eligible_date")))
    return _with_prod_attrition(with_attrition_targets(j, "run_date"))


def rescored_attrition_outcomes(backscore_attrition: DataFrame, resignation: DataFrame) -> DataFrame:
    """Re-scored attrition rows with outcomes (new and existing series)."""
    bs = attrition_scores(backscore_attrition).join(resignation_lookup(resignation), CID, "left")
    return with_attrition_targets(bs, "calc_date_correct")


# ------------------------------------------------------------------ audit

def lookup_audit(targets: DataFrame, backscore_new: DataFrame, resignation: DataFrame, backscore_existing: DataFrame,
                 backscore_attrition: DataFrame, onboarding: DataFrame) -> DataFrame:
    """Rows, keys and repeated keys of every lookup, before it is reduced to one row per key."""
    month = lambda d: _calc_month(d.select(canonical_id(CID).alias(CID), "calc_date"))
    keyed = {
        "matured_targets": targets.where(F.col("target_maturity_flag") == 1).select(F.struct(canonical_id("user_id").alias(CID)).alias("k")),
        "balances": backscore_new.select(F.struct(canonical_id(CID).alias(CID)).alias("k")),
        "resignation": resignation.select(F.struct(canonical_id(CID).alias(CID)).alias("k")),
        "onboarding": onboarding.select(F.struct(canonical_id(CID).alias(CID)).alias("k")),
        "rescored_repay": month(backscore_existing).select(F.struct(CID, "calc_date_ym").alias("k")),
        "rescored_attrition": month(backscore_attrition).select(F.struct(CID, "calc_date_ym").alias("k"))}
    out = None
    for name, d in keyed.items():
        one = (d.groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
            F.count(F.when(F.col("n") > 1, 1)).alias("n_repeated_keys"))
            .select(F.lit(name).alias("lookup"), "n_rows", "n_keys", "n_repeated_keys"))
        out = one if out is None else out.unionByName(one)
    return out
