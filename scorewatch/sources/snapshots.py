"""Dated snapshots switched by a manifest.

A snapshot is a set of dates, each with its own data folder. A publish writes
a new folder aside, verifies its row count and content digest against the
frame it was asked to write, and only then replaces the manifest entry of its
date. Readers follow the manifest, so a publish that fails half-way leaves
every date as it was, and a reader never sees half a date.

    root/data/<date>-<run id>/*.parquet      written aside, never changed afterwards
    root/manifest/<version>.json             one small file per switch; the highest version counts

A manifest version is created with an exclusive write: of two publishers that
switch at the same time one gets the version, the other reads the manifest
again and takes the next one, so neither loses the other's date. Folders that
no manifest names any more are removed by ``expire``, never by a publish.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ATTEMPTS = 50


class SnapshotMismatch(RuntimeError):
    """What was written differs from what should have been written."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def digest(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free digest of all columns, in one aggregate that combines map-side.

    The digest is the sum of the rows' 64-bit hashes as an exact decimal, so it
    counts repeated rows and does not depend on partitioning.
    """
    columns = [F.struct(F.lit(i), F.col(f"`{c}`")) for i, c in enumerate(df.columns)]
    row = F.xxhash64(*columns) if columns else F.lit(0)
    n, total = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(20,0)"))).first()
    return n, int(total or 0)


def manifest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Version and entries (date -> path, rows, digest) of the manifest in force; (0, {}) before the first."""
    fs, folder = _fs(spark, f"{root}/manifest")
    if not fs.exists(folder):
        return 0, {}
    versions = [f.getPath().getName() for f in fs.listStatus(folder)]
    versions = [int(v[:-5]) for v in versions if v.endswith(".json") and v[:-5].isdigit()]
    if not versions:
        return 0, {}
    latest = max(versions)
    lines = spark.read.text(f"{root}/manifest/{latest:08d}.json", wholetext=True).first()
    return latest, json.loads(lines[0])


def _switch(spark: SparkSession, root: str, change) -> int:
    """Write the next manifest version with ``change(entries)`` applied; returns the version."""
    for _ in range(ATTEMPTS):
        version, entries = manifest(spark, root)
        body = json.dumps(change(dict(entries)), sort_keys=True)
        # The file is complete before it gets its name; a rename onto an existing name is refused.
        fs, aside = _fs(spark, f"{root}/switch/{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(body.encode()))
        out.close()
        _, named = _fs(spark, f"{root}/manifest/{version + 1:08d}.json")
        fs.mkdirs(named.getParent())
        if not fs.exists(named) and fs.rename(aside, named):
            return version + 1
        fs.delete(aside, False)
    raise RuntimeError(f"no manifest version could be taken in {ATTEMPTS} attempts: {root}")


def publish(df: DataFrame, root: str, run_date: str) -> dict:
    """Write ``df`` as the snapshot of ``run_date`` and switch the manifest to it; returns the entry.

    Raises ``SnapshotMismatch`` and leaves the manifest alone if the files hold
    other rows than the frame (for example because its plan is not
    deterministic or its sources changed in between).
    """
    spark, root = df.sparkSession, root.rstrip("/")
    path = f"data/{run_date}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(f"{root}/{path}")
    expected, found = digest(df), digest(spark.read.schema(df.schema).parquet(f"{root}/{path}"))
    if expected != found:
        raise SnapshotMismatch(f"{run_date}: {expected} rows and digest expected, {found} written")
    entry = {"path": path, "rows": found[0], "digest": str(found[1]), "schema": df.schema.json()}
    _switch(spark, root, lambda entries: {**entries, run_date: entry})
    return entry


def dates(spark: SparkSession, root: str) -> list[str]:
    """Published dates, ascending."""
    return sorted(manifest(spark, root.rstrip("/"))[1])


def read(spark: SparkSession, root: str, run_date: str | None = None) -> DataFrame:
    """The snapshot of one date, or of the latest; ``run_date`` is added as a column.

    A date that was never published is a ``KeyError``.
    """
    from pyspark.sql.types import StructType
    root = root.rstrip("/")
    entries = manifest(spark, root)[1]
    at = run_date if run_date is not None else max(entries)
    entry = entries[at]
    df = spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(f"{root}/{entry['path']}")
    return df.withColumn("run_date", F.lit(at).cast("date"))


def expire(spark: SparkSession, root: str, keep: int | None = None) -> list[str]:
    """Forget all but the latest ``keep`` dates (all stay by default) and delete folders that
    no entry names; returns the deleted folders. Run it when no publish is under way."""
    root = root.rstrip("/")
    if keep is not None and len(manifest(spark, root)[1]) > keep:
        _switch(spark, root, lambda entries: {d: entries[d] for d in sorted(entries)[len(entries) - keep:]})
    named = {e["path"] for e in manifest(spark, root)[1].values()}
    fs, folder = _fs(spark, f"{root}/data")
    gone = []
    for f in fs.listStatus(folder) if fs.exists(folder) else []:
        name = f"data/{f.getPath().getName()}"
        if name not in named:
            fs.delete(f.getPath(), True)
            gone.append(name)
    return sorted(gone)
