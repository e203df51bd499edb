"""Report sinks (A5-A7, A9; page runs are in ``plans.runs``, snapshots switched by a manifest in ``sources.snapshots``).

Reports are small aggregates; snapshots (resolved resignation dates, master
frames) can be large. Writers never collect: they hand the DataFrame to
Spark's writers, which write one file per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("csv", "parquet")


def write_page(df: DataFrame, path: str, order_by: list | None = None) -> None:
    """A5: one report page as a CSV directory with a header.

    Report pages hold a few hundred rows, so they are written as a single
    ordered file (``coalesce(1)`` after the aggregate, never before it).
    """
    out = df.orderBy(*order_by) if order_by else df
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write as csv or parquet; any other format is rejected."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; use one of {FORMATS}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def save_table(df: DataFrame, name: str, append: bool = False) -> None:
    """Truncate-and-load (or append to) a catalog table."""
    df.write.mode("append" if append else "overwrite").saveAsTable(name)


def publish_snapshot(df: DataFrame, root: str, run_date: str) -> None:
    """Dated snapshot, partitioned by run date; re-running a date
    replaces only that date's partition."""
    (df.withColumn("run_date", F.lit(run_date).cast("date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").parquet(root))


def read_snapshot(spark, root: str, run_date: str | None = None) -> DataFrame:
    """A4: read a published snapshot; a run date prunes to one partition."""
    df = spark.read.parquet(root)
    return df if run_date is None else df.where(F.col("run_date") == F.lit(run_date).cast("date"))
