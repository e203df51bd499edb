"""Helpers shared by the corpus operators: staging, row numbers, word rules."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import stage


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of about 2 MB (or one row): neither a Python worker nor the executor beside it holds more of the texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def release_memory() -> None:
    """Give memory that a batch no longer needs back to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_remainder(id_col: str, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(modulus)


def arrow_type(field_type: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary()}[field_type]


def arrow_schema(ddl: str) -> pa.Schema:
    """'a long, b string' -> pyarrow schema."""
    return pa.schema([(n, arrow_type(t)) for n, t in (f.split() for f in ddl.split(","))])


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(sizes: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Cut 0..len(sizes) into runs whose sizes sum to about ``budget`` (one long item may exceed it)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > budget:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijective mixing step (multiply and xor-shift) on uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)


def word_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``raw``: their starts in it and lengths; their bytes, each byte's place in its word, and where each word's bytes begin."""
    a = np.frombuffer(raw, np.uint8)
    inside = ~_BREAK[a]
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    lengths = np.diff(np.append(first, len(at)))
    return starts, lengths, a[at], np.arange(len(at)) - np.repeat(first, lengths), first


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and start of every word (polynomial over its bytes, then mixed)."""
    starts, lengths, letters, place, first = word_bytes(raw)
    if not starts.size:
        return np.zeros(0, np.uint64), starts
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(lengths.max()) - 1, _BASE))))
    return mix64(np.add.reduceat(_BYTE[letters] * powers[place], first) + lengths.astype(np.uint64)), starts


def number_rows(df: DataFrame, order: list, name: str, lengths: str | None = None) -> DataFrame:
    """Add ``row_no`` (global, gapless from 0, in ``order``) and, if ``lengths``
    names a column, ``row_offset`` (its sum over all earlier rows).

    The rows are range-partitioned, sorted per partition and staged in the
    checkpoint folder with their partition and place, so a lost executor
    cannot renumber them. Only one (partition, rows, sum) line per partition
    is added up across partitions. Rows that tie on the whole order are dealt
    over partitions by their place in the input.
    """
    spread = F.monotonically_increasing_id().alias("_spread")
    sized = F.col(lengths) if lengths else F.lit(0)
    ranged = df.select("*", spread).repartitionByRange(*order, "_spread").sortWithinPartitions(*order, "_spread").drop("_spread")
    place = F.monotonically_increasing_id()
    placed = stage(ranged.withColumn("_part", F.shiftright(place, 33))
                   .withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1))), name)
    from pyspark.sql import Window
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    per_part = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.sum(sized).alias("_sum"))
                .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_base"),
                        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_base")))
    out = placed.join(F.broadcast(per_part), "_part")        # one line per shuffle partition
    out = out.withColumn("row_no", F.col("_row_base") + F.col("_place"))
    if lengths:
        out = out.withColumn("row_offset", F.col("_sum_base") + F.coalesce(F.sum(lengths).over(inside), F.lit(0)))
    return out.drop("_part", "_place", "_row_base", "_sum_base")
