"""Skew-safe ordered computations.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task. When one key (a loan, a reporting period) holds a large share of
the rows, that task dominates the job. The plans below do not need a key's
rows together:

* ``carry_window``  running sums, next and previous values per key by a carry
  scan: rows are range-partitioned by (key, order), each sorted partition is
  scanned once, and one line per partition hands what it ends with to the
  next. A hot key is spread over as many partitions as its rows fill.
* ``bucketed_exclusive_prefix``  exclusive prefix sums per group over a sorted
  numeric column; chunks are equal-frequency buckets whose number follows the
  row count.

Rows with null keys, order columns or values are kept, and results equal the
plain window's with nulls last in every order column (as the reference's sorts
put them): null keys form one group, sums skip nulls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DoubleType, IntegerType, StructField, StructType

from ..functions.core import count_below
from .staging import stage

#: Marks of a partition's outermost rows.
FIRST, LAST = 1, 2


def _spec(order):
    """Order spec: column names (ascending) or (name, ascending) pairs."""
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def order_columns(order):
    """Window ordering for an order spec, nulls last."""
    return [F.col(n).asc_nulls_last() if asc else F.col(n).desc_nulls_last() for n, asc in _spec(order)]


# ------------------------------------------------------------------ carry scan

def _differs(column: pa.Array) -> np.ndarray:
    """Per row from the second on: is the value unlike the one before (nulls are alike)?"""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    unlike = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null()))
    return unlike.to_numpy(zero_copy_only=False)


def segmented_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Inclusive running sums that begin anew where ``starts`` holds; by doubling steps, so that no sum
    is taken over a boundary and then subtracted again."""
    place = np.arange(len(values)) - np.maximum.accumulate(np.where(starts, np.arange(len(values)), 0))
    total, step = values.copy(), 1
    while step <= place.max(initial=0):
        moved = np.where(place[step:] >= step, total[:-step], 0)
        total[step:] = total[step:] + moved
        step *= 2
    return total


def _pick(values: pa.Array, places: np.ndarray, without: np.ndarray) -> pa.Array:
    """The values at the places, null where ``without`` holds."""
    return values.take(pa.array(places, mask=without))


def _scan(keys: list[str], sums: dict, nexts: dict, previous: dict, names: list[str]):
    """The scan of one sorted partition: rows in, rows with local results and marks out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, running, opened, pending = None, {}, True, None

        def finish(held, batch, last: bool) -> list:
            """The held rows, now that the row after them (or the partition's end) is known."""
            columns, edge, ends = held
            for v in nexts.values():
                value = columns[names.index(v)]
                goes_on = batch is not None and batch[1]
                tail = batch[0].column(names.index(v)).slice(0, 1) if goes_on else pa.nulls(1, value.type)
                columns.append(_pick(pa.concat_arrays([value, tail]), np.arange(1, len(value) + 1), ends))
            if last:
                edge[-1] += LAST
            columns.append(pa.array(edge, pa.int8()))
            return columns

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = [batch.column(names.index(k)) for k in keys]
            new = np.zeros(n, bool)
            for k in key:
                new[1:] |= _differs(k)
            new[0] = before is not None and any(a.as_py() != k[0].as_py() for a, k in zip(before["key"], key, strict=True))
            start = new.copy()
            start[0] = True
            if pending is not None:
                yield pa.RecordBatch.from_arrays(finish(pending, (batch, not new[0]), False), schema=schema)
            columns = [*batch.columns, pa.array(np.full(n, part), pa.int32())]
            runs = np.cumsum(new)
            columns.append(pa.array((runs == 0) & opened))
            for o, v in sums.items():
                value = batch.column(names.index(v))
                valid = value.is_valid().to_numpy(zero_copy_only=False)
                total = segmented_sums(np.where(valid, value.to_numpy(zero_copy_only=False), 0.0), start)
                seen = segmented_sums(valid.astype(np.int64), start)
                if before is not None and running.get(o) is not None:                    # the run goes on from the last batch
                    total, seen = total + np.where(runs == 0, running[o], 0.0) * (not new[0]), seen + ((runs == 0) & (not new[0]))
                columns.append(pa.array(total, mask=seen == 0))
                running[o] = float(total[-1]) if seen[-1] else None
            for _, v in previous.items():
                value = batch.column(names.index(v))
                head = before["row"][v] if before is not None else pa.nulls(1, value.type)
                columns.append(_pick(pa.concat_arrays([head, value]), np.arange(n), new))
            edge = np.zeros(n, np.int8)
            if before is None:
                edge[0] = FIRST
            schema = pa.schema([*batch.schema, pa.field("_part", pa.int32()), pa.field("_open", pa.bool_()),
                                *[pa.field(f"_sum_{o}", pa.float64()) for o in sums], *[pa.field(f"_prev_{o}", batch.schema.field(v).type) for o, v in previous.items()],
                                *[pa.field(f"_next_{o}", batch.schema.field(v).type) for o, v in nexts.items()], pa.field("_edge", pa.int8())])
            pending = columns, edge, np.append(new[1:], False)
            opened = opened and not new.any()
            before = {"key": [k[-1] for k in key], "row": {v: batch.column(names.index(v)).slice(n - 1) for v in previous.values()}}
        if pending is not None:
            yield pa.RecordBatch.from_arrays(finish(pending, None, True), schema=schema)

    return scan


def _carries(edges: list, keys: list[str], sums: dict, nexts: dict, previous: dict) -> list[tuple]:
    """What each partition takes over from its neighbours: (part, base per sum, value before, value after).

    ``edges`` holds the first and the last row of every partition that has rows.
    """
    first = {r["_part"]: r for r in edges if r["_edge"] & FIRST}
    last = {r["_part"]: r for r in edges if r["_edge"] & LAST}
    parts, key = sorted(first), lambda r: tuple(r[k] for k in keys)
    base = {p: [None] * len(sums) for p in parts}
    before = {p: [None] * len(previous) for p in parts}
    after = {p: [None] * len(nexts) for p in parts}
    for p, q in zip(parts, parts[1:], strict=False):
        if key(last[p]) != key(first[q]):
            continue
        through = last[p]["_open"]                          # all rows of p belong to one run, so what p took over goes on
        for i, o in enumerate(sums):
            known = [x for x in (base[p][i] if through else None, last[p][f"_sum_{o}"]) if x is not None]
            base[q][i] = sum(known) if known else None
        before[q] = [last[p][v] for v in previous.values()]
        after[p] = [first[q][v] for v in nexts.values()]
    return [(p, *base[p], *before[p], *after[p]) for p in parts]


def carry_window(df: DataFrame, keys: list[str], order: list, sums: dict | None = None, nexts: dict | None = None,
                 previous: dict | None = None, columns: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Running sums (``sums``: out -> double column, inclusive), values of the next row (``nexts``) and of the
    previous row (``previous``) per ``keys`` in ``order``, beside ``columns`` (default: all).

    The rows are shuffled once, by ranges of (keys, order): a key with very
    many rows fills several partitions. Each sorted partition is scanned once
    (Arrow batches, whole columns at a time) and staged with its local results
    and the marks of its first run and outermost rows. From the outermost rows,
    two per partition, the driver adds up what each partition takes over; these
    lines are joined back, one per partition. Rows that tie on the whole order
    take any order, so end it in a unique column. Keys must not be floating.
    """
    sums, nexts, previous = sums or {}, nexts or {}, previous or {}
    spark = df.sparkSession
    by = [*[F.col(k).asc_nulls_last() for k in keys], *order_columns(order)]
    rows = df.withColumns({v: F.col(v).cast("double") for v in set(sums.values())}) if sums else df
    ranged = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    columns = columns or df.columns
    held = list(dict.fromkeys([*columns, *keys, *sums.values(), *nexts.values(), *previous.values()]))     # the rest only orders the rows
    fields = [StructField("_part", IntegerType()), StructField("_open", BooleanType()), *[StructField(f"_sum_{o}", DoubleType()) for o in sums],
              *[StructField(f"_prev_{o}", rows.schema[v].dataType) for o, v in previous.items()],
              *[StructField(f"_next_{o}", rows.schema[v].dataType) for o, v in nexts.items()], StructField("_edge", ByteType())]
    scanned = stage(ranged.sortWithinPartitions(*by).select(*held)
                    .mapInArrow(_scan(keys, sums, nexts, previous, held), StructType([*[StructField(c, rows.schema[c].dataType) for c in held], *fields])), "carry-scan")
    edges = scanned.where(F.col("_edge") > 0).select(
        "_part", "_open", "_edge", *dict.fromkeys([*keys, *nexts.values(), *previous.values()]), *[f"_sum_{o}" for o in sums]).collect()     # two rows per partition
    lines = StructType([StructField("_at", IntegerType()), *[StructField(f"_base_{o}", DoubleType()) for o in sums],
                        *[StructField(f"_before_{o}", rows.schema[v].dataType) for o, v in previous.items()],
                        *[StructField(f"_after_{o}", rows.schema[v].dataType) for o, v in nexts.items()]])
    carry = spark.createDataFrame(_carries(edges, keys, sums, nexts, previous), lines)
    joined = scanned.join(F.broadcast(carry), F.col("_part") == F.col("_at"))               # one line per partition

    def total(o):
        a, b = F.col(f"_sum_{o}"), F.when(F.col("_open"), F.col(f"_base_{o}"))
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)

    marked = lambda mark: F.col("_edge").bitwiseAND(F.lit(mark).cast("byte")) != 0
    return joined.select(
        *columns, *[total(o).alias(o) for o in sums],
        *[F.when(marked(LAST), F.col(f"_after_{o}")).otherwise(F.col(f"_next_{o}")).alias(o) for o in nexts],
        *[F.when(marked(FIRST), F.col(f"_before_{o}")).otherwise(F.col(f"_prev_{o}")).alias(o) for o in previous])


# ------------------------------------------------------------------ prefix sums

def bucketed_exclusive_prefix(df: DataFrame, groups: list[str], order: str, values: list[str],
                              rows_per_bucket: int = 100_000, accuracy: int = 10000) -> DataFrame:
    """Exclusive prefix sums of ``values`` per ``groups`` ordered by ``order``.

    ``df`` has one row per (groups, order) value (aggregate first), no null
    order values, and is staged or cheap to read (it is counted). Up to
    ``rows_per_bucket`` rows a plain window per group does; beyond that the
    order column is cut into equal-frequency ranges per group by a quantile
    sketch, as many as the row count asks for. The bucketed rows are staged,
    so that every branch sees the same buckets.
    """
    buckets = -(-df.count() // rows_per_bucket)
    zero = F.lit(0.0)
    if buckets <= 1:
        before = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(before), zero) for v in values})
    probs = [i / buckets for i in range(1, buckets)]
    group = F.struct(*groups)
    cuts = df.groupBy(*groups).agg(F.percentile_approx(order, probs, max(accuracy, 10 * buckets)).alias("_cuts")) \
        .select(group.alias("_cg"), "_cuts")
    bucket = count_below(F.col("_cuts"), F.col(order), len(probs))
    rows = stage(df.withColumn("_g", group).join(cuts, F.col("_g") == F.col("_cg"))
                 .withColumn("_b", F.struct("_g", bucket.alias("bucket"))).drop("_cuts", "_cg", "_g"), "prefix-rows")
    inner = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({f"_local_{v}": F.coalesce(F.sum(v).over(inner), zero) for v in values})
    totals = rows.groupBy("_b").agg(*[F.sum(v).alias(f"_tot_{v}") for v in values])
    across = Window.partitionBy("_b._g").orderBy("_b.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_b").alias("_ob"), *[F.coalesce(F.sum(f"_tot_{v}").over(across), zero).alias(f"_off_{v}")
                                                        for v in values])
    return local.join(offsets, F.col("_b") == F.col("_ob")).select(
        *df.columns, *[(F.col(f"_local_{v}") + F.col(f"_off_{v}")).alias(f"{v}_before") for v in values])
