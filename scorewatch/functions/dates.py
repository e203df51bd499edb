"""Dirty-date normaliser (B29) as native column expressions.

Rules, in order (first match wins):

1. null, '' or 'nan' (any case)                      -> tag 'null'
2. the first run of 4 digits must start with 19 or 20 -> else 'invalid'
3. YYYY<s>M<s>D with one separator s of '-', '/', '.' -> 'valid' when s is '-'
   and month and day have two digits, else 'convertible'
4. YYYY<s>M                                          -> day 01, 'convertible'
5. YYYYMMDD                                          -> 'convertible'
6. A<s>B<s>YYYY: A > 12 -> A is the day; otherwise A is the month
                                                     -> 'convertible'
7. anything else                                     -> 'invalid'

An impossible calendar date (2024-02-30, month 13) or a date outside
[min, max] is 'invalid'. Date and timestamp inputs are first written as
'yyyy-MM-dd'. Per-row min/max columns override the defaults where not null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from .core import col

TAG_VALID, TAG_CONVERTIBLE, TAG_INVALID, TAG_NULL = "valid", "convertible", "invalid", "null"

_YMD = r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})$"
_YM = r"^(\d{4})([-/.])(\d{1,2})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_DMY = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})$"


def as_date_text(c, dtype: DataType | None = None) -> Column:
    """Date/timestamp -> 'yyyy-MM-dd'; strings are trimmed."""
    c = col(c)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd")
    return F.trim(c.cast("string"))


def _ymd(y: Column, m: Column, d: Column) -> Column:
    text = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def normalise_date(text: Column, min_date, max_date) -> tuple[Column, Column]:
    """Return (tag, date) columns for a trimmed date text column.

    ``min_date`` / ``max_date`` are Columns or 'yyyy-MM-dd' strings.
    """
    lo = F.to_date(min_date if isinstance(min_date, Column) else F.lit(min_date))
    hi = F.to_date(max_date if isinstance(max_date, Column) else F.lit(max_date))
    s = text

    is_null = s.isNull() | (s == "") | (F.lower(s) == "nan")
    year4 = F.regexp_extract(s, r"(\d{4})", 1)
    bad_year = (year4 != "") & ~F.substring(year4, 1, 2).isin("19", "20")

    def grp(pattern, i):
        return F.regexp_extract(s, pattern, i)

    m_ymd, m_ym, m_compact, m_dmy = (s.rlike(p) for p in (_YMD, _YM, _COMPACT, _DMY))

    ymd_date = _ymd(grp(_YMD, 1), grp(_YMD, 3), grp(_YMD, 4))
    ymd_exact = (grp(_YMD, 2) == "-") & (F.length(grp(_YMD, 3)) == 2) & (F.length(grp(_YMD, 4)) == 2)
    ym_date = _ymd(grp(_YM, 1), grp(_YM, 3), F.lit("01"))
    compact_date = _ymd(grp(_COMPACT, 1), grp(_COMPACT, 2), grp(_COMPACT, 3))
    a, b = grp(_DMY, 1), grp(_DMY, 3)
    day_first = a.cast("int") > 12
    dmy_date = _ymd(grp(_DMY, 4), F.when(day_first, b).otherwise(a), F.when(day_first, a).otherwise(b))

    parsed = (F.when(is_null | bad_year, F.lit(None).cast("date"))
              .when(m_ymd, ymd_date).when(m_ym, ym_date)
              .when(m_compact, compact_date).when(m_dmy, dmy_date))
    in_range = parsed.isNotNull() & (parsed >= lo) & (parsed <= hi)

    tag = (F.when(is_null, F.lit(TAG_NULL))
           .when(bad_year, F.lit(TAG_INVALID))
           .when(~in_range, F.lit(TAG_INVALID))
           .when(m_ymd & ymd_exact, F.lit(TAG_VALID))
           .otherwise(F.lit(TAG_CONVERTIBLE)))
    date = F.when(tag.isin(TAG_VALID, TAG_CONVERTIBLE), parsed)
    return tag, date
