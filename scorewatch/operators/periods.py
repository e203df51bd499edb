"""Period membership (D11) without a join.

Periods are a parameter list (name, start, end), possibly overlapping. Each
row is matched against the list, one constant array in the plan, with a
higher-order ``filter`` and exploded once per matching period, so the data
is read once for all periods and no join or exchange is needed.

Where rows are aggregated per period anyway, ``assign_intervals`` comes first:
the periods' ends cut the line of days into elementary intervals, every row
belongs to one of them, and what is aggregated per interval (counts, sums,
minima and maxima per customer, score histograms) is merged into the periods
afterwards, by ``assign_periods`` over the intervals' first days. Rows are then
not copied, however many periods overlap.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import count_below

SCHEMA = "array<struct<Period:string,Start_Date:date,End_Date:date>>"


def periods_literal(periods):
    """[(name, 'yyyy-MM-dd', 'yyyy-MM-dd'), ...] -> constant array<struct>, of any length."""
    return F.from_json(F.lit(json.dumps([{"Period": n, "Start_Date": s, "End_Date": e} for n, s, e in periods])), SCHEMA)


def assign_periods(df: DataFrame, date_col: str, periods) -> DataFrame:
    """One output row per (input row, period containing its date); ends inclusive."""
    d = F.to_date(F.col(date_col))
    matches = F.filter(periods_literal(periods), lambda p: (d >= p["Start_Date"]) & (d <= p["End_Date"]))
    return (df.withColumn("_p", F.explode(matches))
            .select("*", "_p.Period", "_p.Start_Date", "_p.End_Date").drop("_p"))


def elementary_intervals(periods) -> list[tuple[dt.date, bool]]:
    """First day of every interval between two ends of periods, in order, and whether any period holds it."""
    day = dt.date.fromisoformat
    spans = [(day(s), day(e) + dt.timedelta(days=1)) for _, s, e in periods if s <= e]
    change: dict[dt.date, int] = {}
    for start, end in spans:
        change[start] = change.get(start, 0) + 1
        change[end] = change.get(end, 0) - 1
    out, held = [], 0
    for first in sorted(change):
        held += change[first]
        out.append((first, held > 0))
    return out


def assign_intervals(df: DataFrame, date_col: str, periods, out: str = "_interval") -> DataFrame:
    """Add ``out``, the first day of the elementary interval that holds the row's date; rows in no period go."""
    cuts = elementary_intervals(periods)
    if not cuts:
        return df.withColumn(out, F.lit(None).cast("date")).where(F.lit(False))
    days = F.from_json(F.lit(json.dumps([(d - dt.date(1970, 1, 1)).days for d, _ in cuts])), "array<int>")
    held = F.from_json(F.lit(json.dumps([h for _, h in cuts])), "array<boolean>")
    at = count_below(days, F.unix_date(F.to_date(F.col(date_col))) + 1, len(cuts)) - 1
    return (df.withColumn("_at", at).where(F.get(held, F.col("_at")))
            .withColumn(out, F.date_from_unix_date(F.get(days, F.col("_at")))).drop("_at"))
