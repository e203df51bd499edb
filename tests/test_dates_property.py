"""Dirty-date rules: Spark expressions vs a plain-Python statement of the rules."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from scorewatch.functions import dates

LO, HI = dt.date(1990, 1, 1), dt.date(2025, 10, 1)


def _mk(y, m, d):
    try:
        return dt.date(int(y), int(m), int(d))
    except ValueError:
        return None


def rules(s):
    if s is None:
        return "null", None
    s = s.strip()
    if s == "" or s.lower() == "nan":
        return "null", None
    y4 = re.search(r"\d{4}", s)
    if y4 and y4.group(0)[:2] not in ("19", "20"):
        return "invalid", None
    exact = False
    m = re.fullmatch(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})", s)
    if m:
        d = _mk(m.group(1), m.group(3), m.group(4))
        exact = m.group(2) == "-" and len(m.group(3)) == 2 and len(m.group(4)) == 2
    elif (m := re.fullmatch(r"(\d{4})[-/.](\d{1,2})", s)):
        d = _mk(m.group(1), m.group(2), 1)
    elif (m := re.fullmatch(r"(\d{4})(\d{2})(\d{2})", s)):
        d = _mk(*m.groups())
    elif (m := re.fullmatch(r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4})", s)):
        a, b = int(m.group(1)), int(m.group(3))
        d = _mk(m.group(4), b, a) if a > 12 else _mk(m.group(4), a, b)
    else:
        return "invalid", None
    if d is None or d < LO or d > HI:
        return "invalid", None
    return ("valid" if exact else "convertible"), d


def _fmt(draw_parts):
    y, m, d, style, sep, pad = draw_parts
    mm = f"{m:02d}" if pad else str(m)
    dd = f"{d:02d}" if pad else str(d)
    return {
        "ymd": f"{y}{sep}{mm}{sep}{dd}",
        "ym": f"{y}{sep}{mm}",
        "compact": f"{y}{m:02d}{d:02d}",
        "dmy": f"{dd}{sep}{mm}{sep}{y}",
        "mdy": f"{mm}{sep}{dd}{sep}{y}",
        "mixed": f"{y}-{mm}/{dd}",
    }[style]


texts = st.one_of(
    st.tuples(st.integers(1850, 2099), st.integers(0, 14), st.integers(0, 33),
              st.sampled_from(["ymd", "ym", "compact", "dmy", "mdy", "mixed"]),
              st.sampled_from(["-", "/", "."]), st.booleans()).map(_fmt),
    st.sampled_from(["", "nan", "NaN", " 2024-01-31 ", "01012020", "abc", "2024-01-31T00:00", None]),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(texts, min_size=50, max_size=120))
def test_spark_rules_match_python_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    tag, d = dates.normalise_date(dates.as_date_text("s"), LO.isoformat(), HI.isoformat())
    got = [(r.t, r.d) for r in df.select(tag.alias("t"), d.alias("d")).collect()]
    want = [rules(v) for v in values]
    assert got == want
