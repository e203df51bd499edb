"""scorewatch: Spark-native monitoring reports for credit-risk models.

Layout
------
sources/    table loading, logical-table adapters, sinks
functions/  column expressions (dates, ids, bands, ratios, scorecard points)
operators/  DataFrame -> DataFrame building blocks (picks, Gini, cut points,
            ledgers, audits)
plans/      skew-safe multi-stage plans (two-level prefix sums, chunked lead)
            and the report queries built from the operators
"""

__all__ = ["session"]
