"""Scalar building blocks shared by every report.

The helpers fix, once, how pandas/BigQuery semantics map to Spark:
null ids, NaN, division by zero, month arithmetic and rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens the reference treats as a missing id.
MISSING_TOKENS = ["<NA>", "None", "NaN", "nan", "", "null", "NULL"]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_id(c) -> Column:
    """Ids are strings, trimmed; missing-value tokens become null."""
    s = F.trim(col(c).cast("string"))
    return F.when(s.isin(MISSING_TOKENS), F.lit(None).cast("string")).otherwise(s)


def key_of(df, name: str) -> Column:
    """Canonical id column ``name`` of ``df``: as it is where a keyed table holds it canonical already
    (so the table's bucketing stays known to the planner), else ``canonical_id``."""
    return F.col(name) if df.schema[name].metadata.get("canonical") else canonical_id(name)


def month_key(c) -> Column:
    """B1: integer YYYYMM; null for a null date."""
    c = col(c)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def month_label(c) -> Column:
    """B2: 'yyyy-MM'."""
    return F.date_format(col(c), "yyyy-MM")


def shift_months(c, n: int) -> Column:
    """Calendar month shift, clamped to month end (as DateOffset)."""
    return F.add_months(F.to_date(col(c)), n)


def day_distance(a, b) -> Column:
    """Absolute whole-day distance between two dates."""
    return F.abs(F.datediff(F.to_date(col(a)), F.to_date(col(b))))


def months_diff(later, earlier) -> Column:
    """Calendar-month difference ignoring the day; null if either is null."""
    a, b = col(later), col(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def event_flag(c) -> Column:
    """1 when the value is present."""
    return col(c).isNotNull().cast("int")


def safe_ratio(num, den) -> Column:
    """SAFE_DIVIDE(x, NULLIF(y, 0)) -> null on zero or null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct(c, digits: int) -> Column:
    """x*100 rounded half-even (numpy parity)."""
    return F.bround(col(c) * 100, digits)


def clamp01(c) -> Column:
    """Clip to [0, 1]; a null stays null (``greatest`` alone skips nulls)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def flag(cond: Column) -> Column:
    """1/0 flag from a predicate (null predicate -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def valid_number(c) -> Column:
    """Not null and not NaN."""
    c = col(c)
    return c.isNotNull() & ~F.isnan(c)


def coerce_columns(df, schema):
    """Cast columns to a declared StructType; text that does not parse
    becomes null (try_cast) instead of failing the job. Columns not in the
    schema are kept as they are."""
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).try_cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns])


def count_below(values: Column, x: Column, size: int) -> Column:
    """How many of the (ascending) array's values lie below ``x``, by binary search; at most ``size`` values."""
    start = F.struct(F.lit(0).alias("lo"), F.size(values).alias("hi"))

    def halve(at: Column, _) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        right = (at["lo"] < at["hi"]) & (F.get(values, mid) < x)
        return F.struct(F.when(right, mid + 1).otherwise(at["lo"]).alias("lo"),
                        F.when(right, at["hi"]).otherwise(F.least(mid, at["hi"])).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, size.bit_length()))), start, halve, lambda at: at["lo"])
