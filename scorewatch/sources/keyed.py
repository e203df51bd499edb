"""Keyed tables: score, outcome and lookup tables bucketed by their canonical customer id.

Every monthly report joins the score tables with the same lookups on the
customer, and most joins need a shuffle of both sides. A keyed table is
written once per load, shuffled by its id into a fixed number of buckets (one
file each, sorted by id); readers that join, pick or aggregate by customer
then need no exchange, because equal ids lie in buckets of equal number in
every table. The id is canonical when it is written and its column says so
(column metadata), so ``key_of`` reads it as it is: an expression over the id
would hide the bucketing from the planner.

Joins on (customer, month) also stay inside the buckets once the planner may
co-partition on part of a join's keys (``within_buckets``). Rows whose id is
null lie in one bucket; they never join. The number of buckets bounds the
parallelism of everything that reads the tables: size it for files of a few
hundred megabytes, and alike for all tables of a set.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import canonical_id
from ..plans.staging import adopt
from ..session import ensure_checkpoint_dir

CID = "ee_customer_id"

#: The customer id of every table that the master frames read.
KEYS = {"scores_api": CID, "scores_batch": CID, "onboarding": CID, "targets": "user_id", "backscore_oop_new": CID,
        "backscore_oop_existing": CID, "backscore_attrition": CID, "resignation": CID}


def publish_keyed(df: DataFrame, key: str, buckets: int, table: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` bucketed and sorted by its canonical ``key`` and read it back.

    ``table`` names it in the catalog (replaced if it exists), ``path`` its
    folder. Without a name it is staged: it lies under the checkpoint folder,
    is dropped with the staged tables and leaves no entry in the catalog.
    """
    spark = df.sparkSession
    name = table or f"keyed_{uuid.uuid4().hex}"
    if table is None and path is None:
        path = adopt(f"{ensure_checkpoint_dir(spark).rstrip('/')}/scorewatch-{name}")
    rows = df.withColumn(key, canonical_id(key).alias(key, metadata={"canonical": True}))
    writer = rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    held = spark.table(name)
    if table is None:
        held.schema                                       # resolved, with its buckets, before the entry goes
        spark.sql(f"DROP TABLE {name}")
    return held


def within_buckets(spark: SparkSession) -> None:
    """Let joins on (customer, month) use tables that are dealt by the customer alone."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


class KeyedTables(Mapping):
    """The logical tables of a run; those in ``KEYS`` are published keyed when they are first asked for."""

    def __init__(self, tables, buckets: int):
        self.tables, self.buckets = tables, buckets
        self._published: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in KEYS:
            return self.tables[name]
        if name not in self._published:
            self._published[name] = publish_keyed(self.tables[name], KEYS[name], self.buckets)
        return self._published[name]

    def __iter__(self):
        return iter(KEYS)

    def __len__(self):
        return len(KEYS)
