"""Resignation dates, loan balances and data-quality audits.

Repayment events are ordered per loan by (repaid date, installment,
outstanding balance desc, paid amount desc), nulls last, and then by the
caller's tie-break columns. Ordered work per loan is a carry scan over ranges
of that order (``plans.ordered``): a loan with very many events is spread over
several ranges instead of being sorted in a single task.

Events without a loan id belong to no sequence: they have no next event and
no running balance. A null paid amount leaves its own row without a balance
and adds nothing to the rows after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import canonical_id, shift_months
from ..functions.dates import as_date_text, normalise_date
from ..operators.keys import duplicate_keys, one_row_per_key
from .ordered import carry_window
from .params import Params

CID = "ee_customer_id"
REPAYMENT_ORDER = ["repaid_date", "installment_number", ("outstanding_balance", False), ("paid_amount", False)]
SALARY_DEDUCTION, SELF_PAY = "TPSD", "TPFP"


def employer_loans(features: DataFrame, only_employer: bool = True) -> DataFrame:
    """Employer-product loans with an onboarding date (explicit filter)."""
    f = features.withColumn(CID, canonical_id(CID)).where(F.col(CID).isNotNull())
    if only_employer:
        f = f.where((F.col("ee_product_type") == "employer") & F.col("ee_onboarding_date").isNotNull())
    return f


def customer_dates(loans: DataFrame, p: Params, order=("ee_onboarding_date", "ln_loan_id")) -> DataFrame:
    """First non-null HR resignation text and freeze date per customer, normalised.

    One aggregate gives every customer and both first non-null values
    (E9, in the order of the loan rows that ``order`` names): a row whose value
    is null gets a null ordering key, which ``min_by`` skips. The lower bound is the earliest onboarding date of the
    book (E17), evaluated once as a scalar subquery.
    """
    types = dict((f.name, f.dataType) for f in loans.schema.fields)
    res = as_date_text("ee_resignation_date", types["ee_resignation_date"])
    frz = as_date_text("ee_permanent_freeze_date", types["ee_permanent_freeze_date"])
    order = F.struct(*order)
    out = loans.groupBy(CID).agg(
        F.min_by(res, F.when(res.isNotNull(), order)).alias("resignation_text"),
        F.min_by(frz, F.when(frz.isNotNull(), order)).alias("freeze_text"))
    lo = loans.agg(F.min(F.to_date("ee_onboarding_date"))).scalar()
    r_tag, r_date = normalise_date(F.col("resignation_text"), lo, p.max_valid_date)
    f_tag, f_date = normalise_date(F.col("freeze_text"), lo, p.max_valid_date)
    return out.select(CID, "resignation_text", r_tag.alias("resignation_tag"), r_date.alias("resignation_date"),
                      "freeze_text", f_tag.alias("freeze_tag"), f_date.alias("freeze_date"))


def ordered_repayments(repayments: DataFrame, tie_break=()) -> DataFrame:
    return repayments.select(canonical_id("user_id").alias("user_id"), canonical_id("loan_id").alias("loan_id"),
                             "vendor_id", F.to_date("repaid_date").alias("repaid_date"), "installment_number",
                             "outstanding_balance", "paid_amount", "paid_principal", *tie_break)


def next_vendor(repayments: DataFrame, tie_break=(), columns: list[str] | None = None) -> DataFrame:
    """every event with a loan and the vendor of the loan's next event."""
    events = ordered_repayments(repayments, tie_break).where(F.col("loan_id").isNotNull())
    return carry_window(events, ["loan_id"], [*REPAYMENT_ORDER, *tie_break], nexts={"next_vendor": "vendor_id"}, columns=columns)


def switch_dates(repayments: DataFrame, tie_break=()) -> DataFrame:
    """Last salary-deduction -> self-pay switch per user, plus one month."""
    r = next_vendor(repayments, tie_break, ["user_id", "vendor_id", "repaid_date"])
    switches = r.where((F.col("vendor_id") == SALARY_DEDUCTION) & (F.col("next_vendor") == SELF_PAY))
    return (switches.groupBy(F.col("user_id").alias(CID))
            .agg(F.max(shift_months("repaid_date", 1)).alias("switch_resignation_date")))


def resolve_resignation(features: DataFrame, repayments: DataFrame, p: Params,
                        only_employer: bool = True, tie_break=(), loan_order=("ee_onboarding_date", "ln_loan_id")) -> DataFrame:
    """HR date, else freeze date (both validated), else repayment switch + 1 month."""
    dates = customer_dates(employer_loans(features, only_employer), p, loan_order)
    sw = switch_dates(repayments, tie_break)
    out = dates.join(sw, CID, "left")
    resolved = F.coalesce("resignation_date", "freeze_date", "switch_resignation_date")
    source = (F.when(F.col("resignation_date").isNotNull(), F.lit("hr"))
              .when(F.col("freeze_date").isNotNull(), F.lit("freeze"))
              .when(F.col("switch_resignation_date").isNotNull(), F.lit("repayment_switch")))
    return out.select(CID, "resignation_tag", "freeze_tag", resolved.alias("ee_resignation_date_correct"),
                      source.alias("resignation_source"))


def balance_ledger(repayments: DataFrame, features: DataFrame, digits: int | None = 2, tie_break=()) -> DataFrame:
    """Cumulative paid principal and balance after / before each payment.

    The balance before a payment is the balance after the loan's previous
    payment; the first payment, and one after a payment without an amount,
    starts from the loan's principal.
    """
    loans = one_row_per_key(features.select(canonical_id("ln_loan_id").alias("loan_id"),
                                            F.col("ln_original_principal").cast("double").alias("ln_original_principal"))
                            .where(F.col("loan_id").isNotNull()), ["loan_id"])
    events = ordered_repayments(repayments, tie_break)
    columns = ["user_id", "loan_id", "vendor_id", "repaid_date", "installment_number", "paid_principal"]
    in_order = carry_window(events.where(F.col("loan_id").isNotNull()), ["loan_id"], [*REPAYMENT_ORDER, *tie_break],
                            sums={"_so_far": "paid_principal"}, previous={"_previous": "paid_principal"}, columns=columns)
    rows = in_order.unionByName(
        events.where(F.col("loan_id").isNull()).select(*columns, F.lit(None).cast("double").alias("_so_far"),
                                                       F.lit(None).cast("double").alias("_previous")))
    r = rows.join(loans, "loan_id", "left")
    principal, paid = F.col("ln_original_principal"), F.col("paid_principal")
    cumulative = F.when(paid.isNotNull(), F.col("_so_far"))
    before = F.when(F.col("_previous").isNull(), principal).otherwise(
        principal - (F.col("_so_far") - F.coalesce(paid, F.lit(0.0))))
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return r.select(*columns, "ln_original_principal", rnd(cumulative).alias("cumulative_paid_principal"),
                    rnd(principal - cumulative).alias("osbal_after"), rnd(before).alias("osbal_before"))


def date_quality(dates: DataFrame) -> DataFrame:
    """Number of customers per validation tag and source column."""
    cols = [("ee_resignation_date", "resignation_tag"), ("ee_permanent_freeze_date", "freeze_tag")]
    parts = F.explode(F.array(*[F.struct(F.lit(src).alias("source_column"), F.col(tag).alias("tag"))
                                for src, tag in cols]))
    return (dates.select(parts.alias("x")).select("x.*")
            .groupBy("source_column", "tag").agg(F.count(F.lit(1)).alias("n_customers")))


def repayment_duplicates(repayments: DataFrame) -> DataFrame:
    """(loan, installment) pairs that occur more than once."""
    r = repayments.select(canonical_id("loan_id").alias("loan_id"), "installment_number")
    return duplicate_keys(r, ["loan_id", "installment_number"])


def tag_date_disagreement(user_tag: DataFrame, resignation: DataFrame, tag_id: int = 100) -> DataFrame:
    """Active resignation tags whose date differs from the resolved date."""
    tags = (user_tag.where((F.col("tag_id") == tag_id) & F.col("deleted_at").isNull())
            .select(canonical_id("user_id").alias(CID), F.to_date("created_at").alias("tag_date")))
    res = one_row_per_key(resignation.select(canonical_id(CID).alias(CID),
                                             F.to_date("ee_resignation_date_correct").alias("ee_resignation_date_correct")), [CID])
    return (tags.join(res, CID, "inner")
            .where(F.col("tag_date") != F.col("ee_resignation_date_correct")))
