"""SentencePiece encoding and decoding through a distinct-chunk table (operator 9).

No piece of the vocabulary holds a white-space marker after another
character (checked when the model is loaded), so a text, marked, falls into
chunks (a run of markers and the characters up to the next) that are
segmented independently. Each distinct chunk of a batch is segmented once;
the ids of a text are joined back by position from the table. If the check
fails, whole texts are encoded instead.

Defined cases: a null or empty text has the end id only and decodes to the
empty text; null and repeated ids are kept, one row each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, bounded_batches, slices

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    def __init__(self, path: str, entries: int = 300_000):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = entries
        self.table: dict[str, bytes] = {}
        size = self.model.get_piece_size()
        self.cuttable = not any(MARK in self.model.id_to_piece(i).lstrip(MARK) for i in range(size)) \
            and self.model.encode("a", out_type=str)[0].startswith(MARK) \
            and self.model.encode("a  b") == self.model.encode("a " + MARK + "b")
        self.marker = np.array([self.model.piece_to_id(MARK)], "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, as the model gives them (no end id)."""
        if not self.cuttable:
            return self.model.encode(texts, num_threads=1)
        if len(self.table) > self.entries:
            self.table.clear()
        table = self.table
        cut = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list({c for chunks in cut for c in chunks}.difference(table))
        # The model puts one marker before what it is given, so the chunk goes without its first.
        for chunk, ids in zip(new, self.model.encode([c[1:] for c in new], num_threads=1), strict=True):
            table[chunk] = np.array(ids, "<i4").tobytes() if len(chunk) > 1 else self.marker
        return [np.frombuffer(b"".join([table[c] for c in chunks]), "<i4").tolist() for chunks in cut]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids, num_threads=1) if ids else []


@functools.lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_texts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) for every row, end id included in ids."""
    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def run(text: pa.Array) -> pa.Array:
        c = codec(model_path)
        ids = [x + [c.model.eos_id()] for x in c.encode([t or "" for t in text.to_pylist()])]
        return pa.StructArray.from_arrays([pa.array(ids, pa.list_(pa.int32())), pa.array(c.decode(ids), pa.string())],
                                          ["ids", "decoded"])

    return df.select(F.col(id_col), run(text_col).alias("_r")).select(id_col, "_r.ids", "_r.decoded")


def encode_digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                   slice_chars: int = 1_000_000) -> DataFrame:
    """Digest columns of ``encode_texts`` without moving ids and texts back to the JVM."""
    bounded_batches(df.sparkSession)
    schema = arrow_schema(DIGEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        names = [str(i).encode() for i in range(c.model.get_piece_size())]
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts], slice_chars):
                ids = [x + [c.model.eos_id()] for x in c.encode(texts[a:b])]
                shas = [hashlib.sha256(b" ".join([names[i] for i in x])).hexdigest() for x in ids]
                back = [hashlib.sha256(t.encode()).hexdigest() for t in c.decode(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(docs[a:b], pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                                                  pa.array(shas, pa.string()), pa.array(back, pa.string())], schema=schema)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, DIGEST)


def op9_piece_codec(spark, sf_dir):
    import public_tokenizers

    from .common import table
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
