"""Sharding by a Feistel permutation over global row numbers (operator 7).

Every row gets a global row number (order of its id). A keyed Feistel
network with cycle walking permutes the numbers 0..N-1 onto themselves: the
result is a reproducible shuffle in which any row's place can be computed
from (row number, N, seed) alone, without a table. Shard = place mod shards,
slot = place div shards: shard sizes differ by at most one row (law
``rows``) and slots are gapless.

Defined cases: a null text has size 8 and crc32 0; null ids come first;
rows that agree in id, size and crc are interchangeable; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import number_rows

ROUNDS = 6
_MASK31 = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """(odd multiplier, addend) below 2**31 per round, from the seed."""
    keys, state = [], seed & _MASK31
    for _ in range(rounds):
        state = (state * 1103515245 + 12345) & _MASK31
        multiplier = state | (1 << 30) | 1
        state = (state * 1103515245 + 12345) & _MASK31
        keys.append((multiplier, state))
    return keys


def half_bits(n: int) -> int:
    """Smallest h >= 1 with 4**h >= n."""
    h = 1
    while (1 << (2 * h)) < n:
        h += 1
    return h


def feistel(x: np.ndarray, h: int, keys: list[tuple[int, int]]) -> np.ndarray:
    """One pass of the network over 2h-bit numbers (int64; no product reaches 2**63)."""
    mask = (1 << h) - 1
    left, right = x >> h, x & mask
    for multiplier, addend in keys:
        t = right * multiplier + addend
        t = ((t ^ (t >> 15)) & _MASK31) * multiplier
        left, right = right, left ^ ((t >> 11) & mask)
    return (left << h) | right


def permute(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Permutation of 0..n-1: walk the cycle of the network until the number is below n."""
    h, keys = half_bits(n), round_keys(seed)
    y = feistel(x.astype(np.int64), h, keys)
    while (outside := np.flatnonzero(y >= n)).size:
        y[outside] = feistel(y[outside], h, keys)
    return y


def feistel_shards(df: DataFrame, shards: int, seed: int = 7, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot, row_no, place for every row of ``df``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = df.select(F.col(id_col), (F.octet_length(text) + 8).cast("long").alias("size"),
                     F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    numbered = number_rows(slim, [F.col(id_col).asc_nulls_first(), "size", "text_crc32"], "shard-rows")
    n = numbered.count()

    @F.arrow_udf("long")
    def place(row_no: pa.Array) -> pa.Array:
        return pa.array(permute(row_no.to_numpy(zero_copy_only=False), n, seed))

    return (numbered.withColumn("place", place("row_no"))
            .withColumn("shard", (F.col("place") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("place") / shards)))


def op7_feistel_sharding(spark, sf_dir):
    from .common import table
    out = feistel_shards(table(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row_no")
