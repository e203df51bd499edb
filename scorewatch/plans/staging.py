"""Stage an intermediate DataFrame as a parquet table under the checkpoint directory.

A frame that feeds several branches of a plan (cut points and pivots, the
Gini aggregates, the chunk tables of ordered work) is written once and read
back, so the joins behind it run once. The table lives in the shared
directory the cluster names in ``spark.checkpoint.dir``; it survives executor
loss like a checkpoint, but it is written by one columnar job
(``Dataset.checkpoint`` would compute the plan twice and serialise rows).

Staged tables are kept until ``drop_staged``: call it when the results built
on them have been written. A run that drops its tables on its own holds a
``Scope``; what is staged while the scope is entered belongs to it alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

#: Rows a task writes of a table whose size is known.
ROWS_A_TASK = 20_000

_STAGED: list[str] = []
_CURRENT: ContextVar[list[str]] = ContextVar("staged", default=_STAGED)


class Scope:
    """The staged tables of one run."""

    def __init__(self):
        self.paths: list[str] = []

    def drop(self, spark: SparkSession) -> int:
        return _drop(spark, self.paths)

    @contextmanager
    def begin(self, spark: SparkSession) -> Iterator[None]:
        """Drop what the scope staged before (its results must have been written), and stage into it."""
        self.drop(spark)
        token = _CURRENT.set(self.paths)
        try:
            yield
        finally:
            _CURRENT.reset(token)


def stage(df: DataFrame, name: str = "stage", compression: str = "snappy", rows: int | None = None) -> DataFrame:
    """Write ``df`` and read it back.

    ``rows`` (None: not known) is the most rows it can have: no more tasks write it than that
    takes, as every file costs its executor more than a few rows do (on a local folder, processes).
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(rows // ROWS_A_TASK + 1)
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/scorewatch-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", compression).parquet(path)
    _CURRENT.get().append(path)
    release_driver_memory(spark)
    return spark.read.parquet(path)


def release_driver_memory(spark: SparkSession) -> None:
    """Have the driver's JVM give memory that it has freed back to the system.

    A run of hundreds of stages leaves much of it in the allocator, beside the heap. JVMs
    without the command (before 17.0.9, or not on Linux) go on as they are.
    """
    try:
        command = spark._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        server = spark._jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        server.invoke(command, "systemTrimNativeHeap", None, None)
    except Py4JError:
        pass


def adopt(path: str) -> str:
    """Have a table that is written elsewhere dropped with the staged ones."""
    _CURRENT.get().append(path)
    return path


def _drop(spark: SparkSession, paths: list[str]) -> int:
    dropped = 0
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        dropped += 1
    return dropped


def drop_staged(spark: SparkSession) -> int:
    """Delete every table staged so far by this process outside any scope; returns how many."""
    return _drop(spark, _STAGED)
