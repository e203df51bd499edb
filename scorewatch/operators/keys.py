"""Key-level picks and audits.

Picks are aggregates (``min_by`` / ``max_by`` over a struct of the order
columns), not ``row_number`` windows: aggregates combine map-side, so a key
holding a large share of the rows is reduced in every task before the
shuffle instead of landing whole in one task. Struct values make Spark plan
them as sort aggregates, so each task sorts its rows by key first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _struct(cols):
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])


def pick_first(df: DataFrame, keys: list[str], order: list, columns: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    Rows that tie on ``order`` are settled by all their other columns, so the
    pick is deterministic. Null order values sort first (Spark struct ordering).
    """
    columns = [c for c in (columns or df.columns) if c not in keys]
    rest = [c for c in df.columns if c not in keys and not any(isinstance(o, str) and o == c for o in order)]
    picked = df.groupBy(*keys).agg(F.min_by(_struct(columns), _struct([*order, *rest])).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def first_non_null(df: DataFrame, keys: list[str], value: str, order: list, out: str | None = None) -> DataFrame:
    """First non-null ``value`` per key in ``order`` (pandas ``first``)."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys).agg(F.min_by(F.col(value), _struct(order)).alias(out or value)))


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """A lookup reduced to one row per key, so a join on the key cannot multiply rows: the smallest
    row, a value before a null. A single value column takes a plain minimum, which Spark hashes."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if len(rest) == 1:
        return df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0]))
    return pick_first(df, keys, [x for c in rest for x in (F.col(c).isNull(), F.col(c))])


def first_and_last(df: DataFrame, keys: list[str], value: str, order: list, first: str, last: str) -> DataFrame:
    """Value of the first and of the last row per key in ``order``, in one aggregate."""
    return df.groupBy(*keys).agg(F.min_by(value, _struct(order)).alias(first), F.max_by(value, _struct(order)).alias(last))


def dedup_on(df: DataFrame, subset: list[str], order: list) -> DataFrame:
    """H4: distinct on a key subset with a deterministic survivor."""
    return pick_first(df, subset, order)


def duplicate_keys(df: DataFrame, keys: list[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1)
            .orderBy(F.desc(count_col), *keys))


def assert_unique(df: DataFrame, keys: list[str], what: str = "lookup") -> DataFrame:
    """Fail fast when a lookup that is joined by ``keys`` repeats a key.

    Runs one aggregate job; call it where a fan-out would corrupt counts.
    """
    dup = duplicate_keys(df, keys).limit(5).collect()
    if dup:
        raise ValueError(f"{what} is not unique on {keys}: {[tuple(r) for r in dup]}")
    return df


def rows_at_latest(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the latest date (uncorrelated scalar subquery, run once)."""
    latest = df.agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == latest)
