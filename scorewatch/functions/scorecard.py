"""Points scorecard (B24) and the attribute derivations it needs.

The scorecard is data: a list of attributes, each with ordered rules
(predicate -> points) and a default for rows no rule matches (nulls). The
total is a sum of CASE expressions, evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col

# Declared-income band -> number.
INCOME_BANDS = {
    "0-10000": 5000,
    "10000-20000": 15000,
    "20000-30000": 25000,
    "30000-40000": 35000,
    "40000-50000": 45000,
    "50000+": 50000,
}


@dataclass(frozen=True)
class Rule:
    kind: str          # 'lt' (value < bound), 'ge' (value >= bound) or 'in' (value in set)
    arg: object
    points: int


@dataclass(frozen=True)
class Attribute:
    column: str
    rules: tuple
    default: int


# Scorecard 1.0 points and segment thresholds.
SCORECARD_V1 = (
    Attribute("employer_time", (Rule("lt", 0.55, 98), Rule("lt", 2.35, 123), Rule("lt", 3.85, 139),
                                Rule("ge", 3.85, 183)), 119),
    Attribute("gender", (Rule("in", ("Female",), 120), Rule("in", ("Male", "not specified"), 118)), 119),
    Attribute("declared_income_num", (Rule("lt", 21200, 119), Rule("lt", 26525, 110), Rule("lt", 33050, 118),
                                      Rule("ge", 33050, 146)), 119),
    Attribute("civil_status", (Rule("in", ("Divorced", "Married", "Widowed"), 127), Rule("in", ("Single",), 117)),
              119),
)
SEGMENT_THRESHOLDS_V1 = ((532, "A"), (492, "B"), (478, "C"), (468, "D"), (452, "E"))
SEGMENT_FLOOR_V1 = "F"


def _predicate(c: Column, rule: Rule) -> Column:
    if rule.kind == "lt":
        return c < F.lit(rule.arg)
    if rule.kind == "ge":
        return c >= F.lit(rule.arg)
    if rule.kind == "in":
        return c.isin(list(rule.arg))
    raise ValueError(rule.kind)


def attribute_points(attr: Attribute) -> Column:
    c = F.col(attr.column)
    out = None
    for r in attr.rules:
        p = _predicate(c, r)
        out = F.when(p, F.lit(r.points)) if out is None else out.when(p, F.lit(r.points))
    return out.otherwise(F.lit(attr.default))


def total_points(card=SCORECARD_V1) -> Column:
    total = None
    for attr in card:
        pts = attribute_points(attr)
        total = pts if total is None else total + pts
    return total


def points_segment(score, thresholds=SEGMENT_THRESHOLDS_V1, floor=SEGMENT_FLOOR_V1) -> Column:
    s = col(score)
    out = None
    for bound, label in thresholds:
        out = F.when(s > bound, F.lit(label)) if out is None else out.when(s > bound, F.lit(label))
    return out.otherwise(F.lit(floor))


def income_number(c) -> Column:
    """Band -> midpoint, else the text as a number (bad text -> null)."""
    s = col(c).cast("string")
    out = None
    for band, value in INCOME_BANDS.items():
        cond = s == band
        out = F.when(cond, F.lit(float(value))) if out is None else out.when(cond, F.lit(float(value)))
    return out.otherwise(s.try_cast("double"))


def employment_start(c) -> Column:
    """B23: 'yyyy-M' (6), 'yyyy-MM' (7) -> first of month; 'yyyy-MM-dd' (10)."""
    s = col(c).cast("string")
    n = F.length(s)
    month_text = F.concat_ws("-", F.substring(s, 1, 4), F.lpad(F.substring(s, 6, 2), 2, "0"), F.lit("01"))
    return (F.when(n.isin(6, 7), F.try_to_date(month_text, "yyyy-MM-dd"))
            .when(n == 10, F.try_to_date(s, "yyyy-MM-dd")))


def tenure_years(employment_date, as_of) -> Column:
    """Whole days between start and ``as_of`` divided by 365."""
    return F.datediff(F.to_date(col(as_of)), employment_start(employment_date)) / F.lit(365.0)
