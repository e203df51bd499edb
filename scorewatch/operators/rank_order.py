"""Rank-order tables per risk segment.

Both tables are one grouped aggregate over the segment column (null
segments dropped, as pandas ``groupby`` does), followed by column
arithmetic; the aggregate combines map-side, so a dominant segment costs
nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import attrition_order, segment_order
from ..functions.core import pct, safe_ratio


def _subset(df: DataFrame, where) -> DataFrame:
    if where is None:
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)


def repay_rank_order(df: DataFrame, segment: str, where, model_label, period_label: str,
                     run_month: str, target: str = "oop_target", cid: str = "ee_customer_id",
                     money_digits: int | None = 2, by: list[str] | None = None) -> DataFrame:
    """Count, balances, bad rate and money bad rate per segment.

    ``model_label`` is a string or a Column (with ``by`` naming extra
    grouping columns, e.g. a version column when several versions are
    aggregated in one pass).
    """
    by = by or []
    sub = _subset(df, where).where(F.col(segment).isNotNull())
    bad = (1 - F.col(target))
    money = (lambda c: F.round(c, money_digits)) if money_digits is not None else (lambda c: c)
    label = model_label if isinstance(model_label, Column) else F.lit(model_label)
    agg = sub.groupBy(*by, F.col(segment).cast("string").alias("RiskGroup")).agg(
        F.count(cid).alias("Count"),
        F.sum(bad).alias("_bad"),
        F.coalesce(F.sum("osbal_as_of_resignation_date"), F.lit(0.0)).alias("_res"),
        F.coalesce(F.sum(bad * F.col("osbal_as_of_current_date")), F.lit(0.0)).alias("_bad_today"),
        F.coalesce(F.sum("osbal_as_of_oop_eligible_date"), F.lit(0.0)).alias("_eligible"))
    return agg.select(
        "RiskGroup", "Count",
        money(F.col("_res")).alias("Sum_Osbal_Resignation"),
        money(F.col("_bad_today")).alias("Sum_Osbal_Bads_Today"),
        money(F.col("_eligible")).alias("Sum_Osbal_Eligible"),
        pct(safe_ratio("_bad", "Count"), 1).alias("Bad_Rate_Pct"),
        pct(safe_ratio("_bad_today", "_res"), 1).alias("Outstanding_Bad_Rate"),
        label.alias("ModelVersion"),
        F.lit(period_label).alias("Period"),
        segment_order("RiskGroup").alias("Segment_Order"),
        F.lit(run_month).alias("RunMonth"))


def attrition_rank_order(df: DataFrame, segment: str, where, model_label: str, period_label: str,
                         run_month: str, cid: str = "ee_customer_id") -> DataFrame:
    """Count, expected vs actual months to leave, attrition rate."""
    sub = _subset(df, where).where(F.col(segment).isNotNull())
    agg = sub.groupBy(F.col(segment).cast("string").alias("AttritionGroup")).agg(
        F.count(cid).alias("Count"),
        F.avg("score_attr_corrected").alias("_exp"),
        F.avg("time_to_attrition").alias("_act"),
        F.avg("attrition_event").alias("_rate"))
    return agg.select(
        "AttritionGroup", "Count",
        F.bround("_exp", 1).alias("Expected_Avg_TTA"),
        F.bround("_act", 1).alias("Actual_Avg_TTA"),
        pct(F.col("_rate"), 1).alias("Attrition_Rate_Pct"),
        F.lit(model_label).alias("ModelVersion"),
        F.lit(period_label).alias("Period"),
        attrition_order("AttritionGroup").alias("Segment_Order"),
        F.lit(run_month).alias("RunMonth"))


def month_range(c: str, lo: int, hi: int) -> Column:
    """YYYYMM key within [lo, hi]."""
    return F.col(c).between(lo, hi)


def with_all_labels(report: DataFrame, label_col: str, labels: list[str], order_col: str = "Segment_Order",
                    keys: list[str] | None = None) -> DataFrame:
    """Every label appears in the report, in fixed order.

    A label missing from the data gets a row with null metrics (the
    reference's ``pt.loc[order]`` raises instead). ``keys`` identify one
    report block (e.g. ModelVersion); labels are completed per block by
    exploding the short literal label list, so no join to a label table is
    needed to build the grid.
    """
    keys = keys or []
    listed = F.explode(F.array(*[F.struct(F.lit(x).alias(label_col), F.lit(i + 1).alias(order_col))
                                 for i, x in enumerate(labels)])).alias("_l")
    base = report.select(*keys).distinct() if keys else report.sparkSession.range(1).select()
    grid = base.select(*keys, listed).select(*keys, f"_l.{label_col}", f"_l.{order_col}")
    body = report.drop(order_col) if order_col in report.columns else report
    return grid.join(body, [*keys, label_col], "left").orderBy(*keys, order_col)
