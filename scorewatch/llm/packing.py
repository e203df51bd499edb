"""Best-fit-decreasing packing of token ids into windows (operator 8).

Documents are tokenised (byte-level BPE of the tokenizers library, then an
end id); a document longer than the window is first cut into full windows
and a rest. Pieces are dealt evenly over groups of a bounded number of
pieces, and each group is packed on its own: longest piece first, each into
the open window with the least remaining room that still fits, found by a
segment tree indexed by remaining capacity.

Documents are tokenised whole, one at a time.

Defined cases: a null or empty text is the end id alone; null and repeated
ids are kept, one document per row; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import arrow_schema, bounded_batches, release_memory

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Token ids of a byte-level BPE file of the tokenizers library, as little-endian uint32 bytes.

    Where the ids of the file follow its merges in order, the same merges run
    as tiktoken ranks, which gives the same ids at four times the speed;
    otherwise the tokenizers library encodes.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, byte = spec["model"]["vocab"], _byte_of_symbol()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.path = path
        pre = spec["pre_tokenizer"]
        in_order = pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and spec["normalizer"] is None \
            and all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(pairs))
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if i < 256 + len(pairs)} if in_order else {}
        self.ranked = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if in_order else None

    @functools.cached_property
    def library(self):
        """The tokenizers library's own encoder, loaded when a text needs it."""
        from tokenizers import Tokenizer
        loaded = Tokenizer.from_file(self.path)
        loaded.encode_special_tokens = True
        return loaded

    def encode(self, text: str) -> bytes:
        if self.ranked is None or len(text) > 200_000:      # its pattern engine gives up on very long runs
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.ranked.encode_ordinary(text), "<u4").tobytes()


def tokenised_pieces(df: DataFrame, tokenizer_path: str, pattern: str, end_id: int, window: int,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: full windows of long documents and every document's rest."""
    bounded_batches(df.sparkSession)
    schema = arrow_schema(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = ByteBpe(tokenizer_path, pattern), end_id.to_bytes(4, "little")     # held for the task, not for the worker's life
        release_memory()                        # what reading its file took
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(at, 1000), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = encoder.encode(text.as_py() or "") + end
                    for start in range(0, len(ids) // 4, window):
                        piece = ids[4 * start:4 * (start + window)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        del encoder
        release_memory()

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(cut, PIECES)


class CapacityTree:
    """Segment tree over remaining capacities 0..size-1: which have an open window."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves < size:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size)]

    def push(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def pop_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) with the least capacity >= need."""
        count, node = self.count, need + self.leaves
        if need >= len(self.open):
            return None
        if not count[node]:
            # Climb until a right sibling holds an open window, then take its leftmost leaf.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        capacity = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset for each length (each in 1..window; order: longest first, ties by place)."""
    tree, opened = CapacityTree(window + 1), 0
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.pop_tightest(lengths[i])
        capacity, number = found if found else (window, opened)
        opened += found is None
        sequence[i], offset[i] = number, window - capacity
        if capacity > lengths[i]:
            tree.push(capacity - lengths[i], number)
    return sequence, offset


def pack(pieces: DataFrame, window: int, group_rows: int = 20_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; groups of about ``group_rows`` pieces are packed apart.

    ``pieces`` must be staged (it is counted, then dealt by place).
    """
    groups = max(1, -(-pieces.count() // group_rows))
    schema = arrow_schema(PIECES + ", sequence_id long, offset long")

    def one(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        sequence, offset = best_fit_decreasing(rows.column("length").to_pylist(), window)
        first = key[0].as_py() << 32
        return pa.table([*(rows.column(n) for n in schema.names[:5]), pa.array([first + s for s in sequence], pa.int64()),
                         pa.array(offset, pa.int64())], schema=schema)

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(one, PIECES + ", sequence_id long, offset long")


def pack_documents(df: DataFrame, tokenizer_path: str, pattern: str, window: int = 2048, end_id: int = 1,
                   group_rows: int = 20_000) -> DataFrame:
    """Pieces of all documents with their place (PIECES, sequence_id, offset)."""
    return pack(stage(tokenised_pieces(df, tokenizer_path, pattern, end_id, window), "pack-pieces"), window, group_rows)


def op8_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    from .common import table
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
