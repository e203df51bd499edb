"""Quality classifier by compression with two zstandard dictionaries (operator 12).

One dictionary is trained on text labelled good, one on text labelled bad. A
text is cut into pieces of 1,024 bytes, each piece is compressed with either
dictionary, and the difference of the two total sizes, bad minus good, per
byte of text is the text's evidence for quality. All pieces of the whole
text count alike, so what a long text holds at its end weighs as much as its
beginning. A logistic curve, fitted on labelled texts that no dictionary has
seen, turns the evidence into the probability of label 1.

The classifier is fitted on a bounded sample, the documented parameters
``sample_per_class`` (the labelled rows with the smallest id hash per class)
and ``pieces_per_text`` (pieces of a sampled text given to the dictionary
trainer, spread evenly over the text). Half of the sample, by a hash of the
text so that copies stay together, trains the dictionaries, one task per
class; the other half, whole texts scored in Spark, fits the curve. The
curve's classes weigh as all labelled rows do. Scoring reads every whole text
in place.

Defined cases: a null text is empty; an empty text has evidence 0; a null
label is no label, of several labels for an id the lower counts, and of
several texts for an id the smallest is learned from; when a class has no
labelled text in either half, every score is the smoothed share of good
labels, 0 without labels; null and repeated ids are scored row by row; an
empty table gives an empty result; ``keep_good_quality`` keeps all columns,
whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import arrow_schema, bounded_batches, id_remainder, release_memory, table

PIECE = 1024
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
SAMPLE_PER_CLASS = 4_000
PIECES_PER_TEXT = 32
THRESHOLD = 0.7


def pieces(raw: bytes) -> list[memoryview]:
    whole = memoryview(raw)
    return [whole[i:i + PIECE] for i in range(0, len(raw), PIECE)]


class Sizes:
    """Compressed sizes with the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for content in (good, bad):
            held = zstandard.ZstdCompressionDict(content)
            held.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False))

    def evidence(self, raw: bytes) -> float:
        """(size with the bad dictionary - size with the good one) per byte of the text."""
        if not raw:
            return 0.0
        good, bad = (sum(len(c.compress(p)) for p in pieces(raw)) for c in self.compressors)
        return (bad - good) / len(raw)


@dataclass
class CompressionClassifier:
    good: bytes
    bad: bytes
    slope: float
    bias: float

    def scorer(self):
        """Function from a text's bytes to its score; without dictionaries the bias alone decides."""
        sizes = Sizes(self.good, self.bad) if self.good and self.bad else None
        return lambda raw: logistic(self.bias + (self.slope * sizes.evidence(raw) if sizes else 0.0))


def logistic(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 100) -> tuple[float, float]:
    """Slope and bias of a weighted logistic regression on one input, by Newton's method with halved steps."""
    scale = float(x.std()) or 1.0
    u, w = x / scale, weight / weight.sum()

    def loss(v):
        z = v[0] * u + v[1]
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + l2 / 2 * v[0] ** 2)

    v = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(v[0] * u + v[1], -500, 500)))
        h = w * p * (1 - p)
        grad = np.array([(w * (p - y) * u).sum() + l2 * v[0], (w * (p - y)).sum()])
        move = np.linalg.solve([[(h * u * u).sum() + l2, (h * u).sum()], [(h * u).sum(), h.sum() + 1e-12]], grad)
        step = 1.0
        while loss(v - step * move) > loss(v) and step > 1e-6:
            step /= 2
        v = v - step * move
        if np.abs(step * move).max() < 1e-10:
            break
    return float(v[0] / scale), float(v[1])


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; the samples themselves where they are too few to choose from."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _spread(raw: bytes, most: int) -> list[bytes]:
    """At most ``most`` of the text's pieces, evenly spread."""
    each = pieces(raw)
    if len(each) > most:
        each = [each[i * len(each) // most] for i in range(most)]
    return [bytes(p) for p in each]


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_per_class: int = SAMPLE_PER_CLASS, pieces_per_text: int = PIECES_PER_TEXT) -> CompressionClassifier:
    """Fit the classifier on a bounded sample of ``labels`` (id, 0/1) joined with their texts."""
    spark = documents.sparkSession
    bounded_batches(spark)
    given = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg((F.min(F.col(label_col).cast("int")) > 0).cast("int").alias("_y")))
    given = stage(given.withColumn("_h", F.xxhash64("_id")), "quality-labels")
    share = {r["_y"]: r["n"] for r in given.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = (share.get(1, 0) + 0.5) / (sum(share.values()) + 1) if share else 0.0
    flat = CompressionClassifier(b"", b"", 0.0, float(np.log(prior / (1 - prior))) if prior else -800.0)
    if len(share) < 2:
        return flat
    picked = [given.where(F.col("_y") == y).orderBy("_h", "_id").limit(sample_per_class) for y in (0, 1)]
    sample = (documents.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
              .join(F.broadcast(picked[0].union(picked[1])), "_id")                 # at most 2 * sample_per_class ids
              .groupBy("_id", "_h", "_y").agg(F.min("_text").alias("_text")))
    sample = stage(sample.withColumn("_half", F.pmod(F.xxhash64("_text"), F.lit(2))), "quality-sample")
    schema = arrow_schema("y int, dictionary binary")

    def dictionary(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("_h", "_id", "_text")), strict=True))
        samples = [p for _, _, text in rows for p in _spread(text.encode(), pieces_per_text)]
        return pa.table([pa.array([group.column("_y")[0].as_py()], pa.int32()), pa.array([train_dictionary(samples)], pa.binary())], schema=schema)

    learned = {r["y"]: bytes(r["dictionary"]) for r in sample.where("_half = 0").select("_h", "_id", "_y", "_text")
               .groupBy("_y").applyInArrow(dictionary, "y int, dictionary binary").collect()}     # the bounded sample, a task per class
    if not (learned.get(0) and learned.get(1)):
        return flat
    held = sorted((r["_h"], r["_id"], r["_y"], r["e"]) for r in sample.where("_half = 1")
                  .select("_h", "_id", "_y", evidence(spark, learned[1], learned[0], "_text").alias("e")).collect())
    y = np.array([r[2] for r in held], float)
    if not 0 < y.sum() < len(y):
        return flat
    weight = np.where(y == 1, share[1] / max(1, y.sum()), share[0] / max(1, (1 - y).sum()))
    return CompressionClassifier(learned[1], learned[0], *fit_curve(np.array([r[3] for r in held]), y, weight))


def _over_texts(held, make, text_col):
    """Column of doubles: ``make(model)`` applied to the bytes of every text."""
    @F.arrow_udf("double")
    def each(text: pa.Array) -> pa.Array:
        value = make(held.value)
        out = pa.array([value((t.as_py() or "").encode()) for t in text], pa.float64())
        release_memory()
        return out

    return each(text_col)


def evidence(spark, good: bytes, bad: bytes, text_col: str = "text"):
    """Evidence column of two dictionaries."""
    return _over_texts(spark.sparkContext.broadcast((good, bad)), lambda d: Sizes(*d).evidence, text_col)


def quality_score(spark, model: CompressionClassifier, text_col: str = "text"):
    """Score column (0 to 1) of a fitted classifier."""
    return _over_texts(spark.sparkContext.broadcast(model), lambda m: m.scorer(), text_col)


def training_labels(labels: DataFrame, folds: int = 4, held_out: int = 2, id_col: str = "doc_id") -> DataFrame:
    """Labels outside the held-out fold (crc32 of the id as text, remainder 2)."""
    return labels.where(id_remainder(id_col, folds) != held_out)


def keep_good_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score reaches the threshold."""
    return docs.where(quality_score(docs.sparkSession, train(docs, training_labels(labels))) >= threshold)


def op12_compression_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, training_labels(labels.select("doc_id", "quality")))
    return (docs.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), quality_score(spark, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
