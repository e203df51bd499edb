"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def left_join_where(left: DataFrame, right: DataFrame, on: list[str], right_filter: Column) -> DataFrame:
    """``LEFT JOIN r ON keys AND <predicate on r>``.

    The predicate restricts which right rows can match; left rows without a
    match are kept. Filtering the right side first is the same join and
    lets the predicate reach the right side's scan.
    """
    return left.join(right.where(right_filter), on=on, how="left")
