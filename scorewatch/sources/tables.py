"""Base-table access.

Tables are read lazily from parquet; Catalyst prunes columns and pushes
filters into the scan, so callers select what they need afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class TableSet:
    """Lazy, cached handles on the parquet tables of one data directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._frames[name]


def scan(spark: SparkSession, path: str, columns: dict[str, str] | None = None,
         where=None) -> DataFrame:
    """A1-A3: scan with projection + rename and an optional filter.

    ``columns`` maps source name -> output name. The filter is applied on the
    source names before the rename so it reaches the parquet reader.
    """
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    if columns:
        from pyspark.sql import functions as F
        df = df.select([F.col(src).alias(dst) for src, dst in columns.items()])
    return df
