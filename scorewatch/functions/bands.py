"""Band and order maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col

# Months-to-leave value -> attrition band; '12+' and +inf mean 15.
ATTRITION_BANDS = {
    1: "Very high", 2: "Very high", 3: "Very high",
    4: "High", 5: "High", 6: "High",
    7: "Average", 8: "Average", 9: "Average",
    10: "Low", 11: "Low", 12: "Low",
    15: "Very low",
}
# Report order of the attrition bands and of the repay segments.
ATTRITION_ORDER = {"Very low": 1, "Low": 2, "Average": 3, "High": 4, "Very high": 5}
SEGMENT_ORDER = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6}
SEGMENTS = ["A", "B", "C", "D", "E", "F"]
OPEN_ENDED_VALUE = 15.0


def _map_literal(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def open_ended_to_number(c) -> Column:
    """B12: '12+' -> 15, else try_cast to double (bad text -> null)."""
    s = col(c).cast("string")
    return F.when(s == "12+", F.lit(OPEN_ENDED_VALUE)).otherwise(s.try_cast("double"))


def inf_to_open_ended(c) -> Column:
    """+inf ('no exit in horizon') -> 15."""
    c = col(c)
    return F.when(c == F.lit(float("inf")), F.lit(OPEN_ENDED_VALUE)).otherwise(c)


def attrition_band(c) -> Column:
    """Numeric months -> band; unmapped values are kept as their text."""
    c = col(c)
    mapped = F.element_at(_map_literal({float(k): v for k, v in ATTRITION_BANDS.items()}), c.cast("double"))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(mapped, c.cast("double").cast("string")))


def attrition_order(c) -> Column:
    return F.element_at(_map_literal(ATTRITION_ORDER), col(c))


def segment_order(c) -> Column:
    return F.element_at(_map_literal(SEGMENT_ORDER), col(c))


def change_category(old, new) -> Column:
    """Three-way category of a credit-limit change."""
    o, n = col(old), col(new)
    return (F.when(n > o, "CL Increased").when(n < o, "CL Decreased").otherwise("No CL Increase"))


# Onboarding cohort boundaries (inclusive quarter ranges).
COHORTS = [
    ("Onboarded Q1 2025", "2025-01-01", "2025-03-31"),
    ("Onboarded Q2 2025", "2025-04-01", "2025-06-30"),
    ("Onboarded Q3 2025", "2025-07-01", "2025-09-30"),
    ("Onboarded Q4 2025", "2025-10-01", "2025-12-31"),
]


def cohort_label(c, before: str = "2025-01-01", cohorts=COHORTS, rest: str = "Onboarded 2026") -> Column:
    """Date -> cohort; a null date falls to the last label as in the reference."""
    d = F.to_date(col(c))
    out = F.when(d < F.lit(before).cast("date"), F.lit("Onboarded before"))
    for label, lo, hi in cohorts:
        out = out.when(d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), F.lit(label))
    return out.otherwise(F.lit(rest))


def user_mix_type(is_new, has_plus) -> Column:
    """new/old x with/without CL+."""
    n, p = col(is_new), col(has_plus)
    return (F.when(n & p, "new_user_w_cl+")
            .when(n & ~p, "new_user_w_no_cl+")
            .when(~n & p, "old_user_w_cl+")
            .otherwise("old_user_w_no_cl+"))
