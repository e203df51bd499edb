"""Toxicity classifier: character n-grams scaled by naive Bayes log-count ratios (operator 3).

Features are character 3- to 5-grams of the lower-cased text (ASCII
punctuation and white space count as one blank), present or absent, under
64-bit keys. From labelled rows the smoothed log ratio r of a feature's
document frequency in toxic and other texts is counted in Spark, and a
logistic regression is fitted on features with values r instead of 1, so
the linear weights start from the naive Bayes evidence. Every n-gram of the
sample is a feature. Both classes weigh the same in the fit.

Scores are calibrated: the sample is cut into ``folds`` by its texts'
hashes (copies share a fold) and each fold is scored by a model whose ratios
and weights come from the other folds. A logistic curve through these
margins gives the scores' slope; 0.5 lies where missed texts plus
``false_alarm_cost`` times false alarms (shares of their classes) are least.
The fits run beside each other in ``folds`` tasks, each holding its rows'
features once; with as many machines none holds two fits.

The classifier is fitted on a bounded sample, the documented parameter
``sample_per_class`` (the labelled ids with the smallest hash per class, one
text each); the sample's ids are broadcast (bounded), only its texts are
moved. Scoring reads every whole text in place.

Defined cases: a null text is empty; an empty text gets the score of no
features; a null label is no label, and of several labels for an id the
toxic one counts; of several texts for a sampled id the smallest is learnt
from; without labelled rows of both classes the score is the smoothed share
of toxic labels, 0 without labels; where a fold leaves one class without a
row, margins are taken as they are; null and repeated ids are scored row by
row; an empty table gives an empty result; other columns are kept by
``drop_toxic`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import bounded_batches, id_remainder, release_memory, table

ORDERS = (3, 4, 5)
SAMPLE_PER_CLASS = 4_000
FOLDS = 3
SLICE = 1 << 18           # code points turned into keys at a time
CHUNK = 1 << 20           # features of the fit's rows worked on at a time

#: ASCII code -> blank where it is no letter or digit.
_FOLD = np.array([c if chr(c).isalnum() else 32 for c in range(128)], np.uint32)


def gram_slices(text: str, orders=ORDERS) -> Iterator[np.ndarray]:
    """64-bit keys of the whole text's character n-grams, with repeats, slice by slice."""
    a = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    low = a < 128
    a = np.where(low, _FOLD[np.where(low, a, 0)], a)
    blank = a == 32
    a = a[~(blank & np.concatenate(([False], blank[:-1])))]      # runs of blanks are one
    for start in range(0, max(1, len(a) - min(orders) + 1), SLICE):
        part = a[start:start + SLICE + max(orders) - 1].astype(np.uint64)
        h = part + np.uint64(1)
        for n in range(2, max(orders) + 1):
            if len(part) < n:
                break
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1:]
            if n in orders:
                yield (h[:SLICE] ^ (h[:SLICE] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def distinct(parts, dtype) -> np.ndarray:
    """The distinct values of some arrays, ascending; sorts, which takes a quarter of np.unique's time here."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size > 8 * SLICE:
            held = [_sorted_distinct(np.concatenate(held))]
            size = 0
    return _sorted_distinct(np.concatenate(held)) if held else np.zeros(0, dtype)


def _sorted_distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def gram_hashes(text: str, orders=ORDERS) -> np.ndarray:
    """Distinct keys of the whole text, ascending."""
    return distinct(gram_slices(text, orders), np.uint64)


class KeyIndex:
    """Positions of sorted distinct 64-bit keys: a table of where each prefix starts, then steps forward."""

    def __init__(self, keys: np.ndarray):
        bits = min(22, len(keys).bit_length() + 2)
        self.size, self.shift = len(keys), np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.keys = np.append(keys, np.uint64(2 ** 64 - 1))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Positions of the wanted keys that are held, in the order wanted."""
        at = self.first[wanted >> self.shift]
        behind = np.flatnonzero(self.keys[at] < wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < wanted[behind]]
        at = at[self.keys[at] == wanted]
        return at[at < self.size]

    def positions(self, text: str) -> np.ndarray:
        """Distinct positions of the features that the text has, ascending."""
        return distinct(map(self.find, gram_slices(text)), np.int32)


@dataclass
class NaiveBayesLinear:
    index: KeyIndex
    weights: np.ndarray       # weight times log-count ratio, calibrated, by position
    bias: float

    def score(self, text: str) -> float:
        z = self.bias + (self.weights[self.index.positions(text)].sum() if self.index.size else 0.0)
        with np.errstate(over="ignore"):
            return float(1 / (1 + np.exp(-z)))


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, sample_weight: np.ndarray, scale: np.ndarray,
                 l2: float, steps: int = 60) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on features ``scale`` at the given positions, by L-BFGS.

    Rows are worked through in chunks of at most ``CHUNK`` features (or one row)."""
    lengths, d, sw = np.array([len(r) for r in rows], np.int64), len(scale), sample_weight / sample_weight.sum()
    ends, chunks, low = np.cumsum(lengths), [], 0
    while low < len(rows):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CHUNK, "right")))
        chunks.append((low, high))
        low = high

    def loss(w):
        value, grad, total = scale * w[:d], np.zeros(d + 1), l2 / 2 * (w[:d] ** 2).sum()
        for low, high in chunks:
            own, at = np.concatenate(rows[low:high]), np.repeat(np.arange(high - low), lengths[low:high])
            z = np.bincount(at, value[own], high - low) + w[d]
            error = sw[low:high] * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[low:high])
            grad[:d] += np.bincount(own, error[at], d)
            grad[d] += error.sum()
            total += (sw[low:high] * (np.logaddexp(0, z) - y[low:high] * z)).sum()
        grad[:d] = grad[:d] * scale + l2 * w[:d]
        return float(total), grad

    w = np.zeros(d + 1)
    value_now, grad = loss(w)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, t in reversed(history):
            alphas.append((s @ q) / (t @ s))
            q -= alphas[-1] * t
        if history:
            s, t = history[-1]
            q *= (s @ t) / (t @ t)
        for (s, t), a in zip(history, reversed(alphas), strict=True):
            q += (a - (t @ q) / (t @ s)) * s
        step, slope = (1.0 if history else min(1.0, 1 / max(1e-12, np.abs(grad).sum()))), grad @ q
        while True:
            trial, trial_grad = loss(w - step * q)
            if trial <= value_now - 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        moved, turned = -step * q, trial_grad - grad
        w, done = w + moved, value_now - trial < 1e-9
        value_now, grad = trial, trial_grad
        if moved @ turned > 1e-15:
            history = [*history[-9:], (moved, turned)]
        if done:
            break
    return w[:d], float(w[d])


def calibration(margins: np.ndarray, y: np.ndarray, false_alarm_cost: float, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that map margins to scores.

    The slope is that of the logistic curve through the margins, both classes
    weighing the same, targets smoothed by one row of each class. The offset
    puts 0.5 where the share of missed rows plus ``false_alarm_cost`` times
    the share of false alarms is least: the middle between the two margins
    around that cut, the highest such cut on ties. (1, 0) where a class is
    missing or larger margins do not go with label 1."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, theta = np.stack([margins, np.ones(len(margins))], axis=1), np.array([1.0, 0.0])

    def loss(t):
        z = x @ t
        return (weight * (np.logaddexp(0, z) - target * z)).sum()

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (weight * (p - target)))
        size = 1.0
        while loss(theta - size * step) > loss(theta) and size > 1e-6:
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    if theta[0] <= 0:
        return 1.0, 0.0
    level, at = np.unique(margins, return_inverse=True)           # a cut lies below level i: rows from level i on are flagged
    missed = np.concatenate(([0.0], np.cumsum(np.bincount(at, y == 1, len(level))))) / n1
    alarms = 1 - np.concatenate(([0.0], np.cumsum(np.bincount(at, y == 0, len(level))))) / n0
    cost = missed + false_alarm_cost * alarms
    cut = int(np.flatnonzero(cost <= cost.min() + 1e-12)[-1])
    near = level[max(0, cut - 1):cut + 1]
    return float(theta[0]), -float(theta[0]) * float(near.mean())


def log_ratios(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int, smoothing: float) -> np.ndarray:
    """Log ratio of the smoothed document frequencies in toxic and other texts; 0 for a feature without a text."""
    ratio = np.log((toxic + smoothing) / (n_toxic + 2 * smoothing)) - np.log((clean + smoothing) / (n_clean + 2 * smoothing))
    return np.where(clean + toxic > 0, ratio, 0.0)


def fit_tasks(folds: int) -> list[list[int]]:
    """The fits of each task, by the fold left out (``folds``: none): the last task does two, one after the other on the same rows."""
    return [[f] for f in range(folds - 1)] + [[folds - 1, folds]]


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_per_class: int = SAMPLE_PER_CLASS, smoothing: float = 1.0,
          l2: float = 1e-2, folds: int = FOLDS, false_alarm_cost: float | None = None) -> NaiveBayesLinear:
    """Fit the classifier on a bounded sample of ``labels`` (id, 0/1) joined with their texts.

    ``false_alarm_cost`` (None: other labels for each toxic one, so every wrong text counts the same) places score 0.5."""
    bounded_batches(documents.sparkSession)
    given = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg((F.max(F.col(label_col).cast("int")) > 0).cast("int").alias("_y")))
    given = stage(given.withColumn("_h", F.xxhash64("_id")), "toxic-labels")
    share = {r["_y"]: r["n"] for r in given.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(share) < 2:
        prior = (share.get(1, 0) + 0.5) / (sum(share.values()) + 1) if share else 0.0
        return NaiveBayesLinear(KeyIndex(np.zeros(0, np.uint64)), np.zeros(0), float(np.log(prior / (1 - prior))) if prior else -np.inf)
    picked = [given.where(F.col("_y") == y).orderBy("_h", "_id").limit(sample_per_class) for y in (0, 1)]
    sample = stage(documents.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
                   .join(F.broadcast(picked[0].union(picked[1])), "_id")          # at most 2 * sample_per_class ids
                   .groupBy("_id", "_h", "_y").agg(F.min("_text").alias("_text"))
                   .withColumn("_fold", F.pmod(F.xxhash64("_text"), F.lit(folds)).cast("int")), "toxic-sample")
    classes = np.zeros((folds, 2), np.int64)
    for r in sample.groupBy("_fold", "_y").agg(F.count(F.lit(1)).alias("n")).collect():
        classes[r["_fold"], r["_y"]] = r["n"]

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def counted():
            for code, keys in held.items():
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(key), code, np.int32)),
                                                  pa.array(n.astype(np.int32))], ["key", "code", "n"])

        for batch in batches:
            for fold, y, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = gram_hashes(text)
                held.setdefault(2 * fold + y, []).append(keys)
                size += len(keys)
                if size >= CHUNK:
                    yield from counted()
                    held, size = {}, 0
        yield from counted()

    counts = (sample.select("_fold", "_y", "_text").mapInArrow(document_counts, "key long, code int, n int")
              .groupBy("key").agg(*[F.sum(F.when(F.col("code") == c, F.col("n")).otherwise(0)).cast("int").alias(f"c{c}")
                                    for c in range(2 * folds)]).toArrow())
    keys = counts.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    by_fold = np.stack([counts.column(f"c{c}").to_numpy()[order] for c in range(2 * folds)]).reshape(folds, 2, len(keys))
    index = KeyIndex(keys[order])
    held, tasks = sample.sparkSession.sparkContext.broadcast((index, by_fold)), fit_tasks(folds)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The models of each value of ``task``: all folds but one, or all."""
        index, by_fold = held.value
        rows: dict[int, list] = {}
        for batch in batches:
            for task, *row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.setdefault(task, []).append((*row, index.positions(text)))
        for own in rows.values():
            own.sort(key=lambda r: r[:2])
        for task, left_out in [(t, f) for t in rows for f in tasks[t]]:
            own = rows[task]
            y, fold = np.array([r[2] for r in own], float), np.array([r[3] for r in own])
            used = [f for f in range(folds) if f != left_out]
            n = classes[used].sum(axis=0)
            if not n.all():
                continue
            scale = log_ratios(*by_fold[used].sum(axis=0), *n, smoothing)
            learn, rest = np.flatnonzero(fold != left_out), np.flatnonzero(fold == left_out)
            w, bias = fit_logistic([own[i][4] for i in learn], y[learn], 1 / n[y[learn].astype(int)], scale, l2)
            w *= scale
            margins = np.array([bias + w[own[i][4]].sum() for i in rest])
            yield pa.RecordBatch.from_arrays(
                [pa.array([left_out], pa.int32()), pa.array([w.tobytes() if left_out == folds else None], pa.binary()), pa.array([bias]),
                 pa.array([y[rest].tobytes()], pa.binary()), pa.array([margins.tobytes()], pa.binary())],
                ["fit", "weights", "bias", "labels", "margins"])
        release_memory()

    given_to = F.explode(F.array(*[F.lit(t) for t in range(len(tasks))])).alias("task")
    fitted = {r["fit"]: r for r in sample.select(given_to, "_h", "_id", "_y", "_fold", "_text").repartitionByRange(len(tasks), "task")
              .mapInArrow(fit, "fit int, weights binary, bias double, labels binary, margins binary").collect()}
    held.destroy()                             # the driver's copy goes too
    if folds not in fitted:                    # no text of one class is in the documents
        prior = (classes[:, 1].sum() + 0.5) / (classes.sum() + 1)
        return NaiveBayesLinear(KeyIndex(np.zeros(0, np.uint64)), np.zeros(0), float(np.log(prior / (1 - prior))))
    slope, offset = 1.0, 0.0
    if len(fitted) == folds + 1:
        labelled, margins = (np.concatenate([np.frombuffer(fitted[f][c], "<f8") for f in range(folds)]) for c in ("labels", "margins"))
        slope, offset = calibration(margins, labelled, share[0] / share[1] if false_alarm_cost is None else false_alarm_cost)
    return NaiveBayesLinear(index, slope * np.frombuffer(fitted[folds]["weights"], "<f8"), slope * fitted[folds]["bias"] + offset)


def toxicity_score(spark, model: NaiveBayesLinear, text_col: str = "text"):
    """Score column (0 to 1) of a fitted model."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        scores = pa.array([held.value.score(t.as_py() or "") for t in text], pa.float64())
        release_memory()
        return scores

    return score(text_col)


def training_labels(labels: DataFrame, folds: int = 5, id_col: str = "doc_id") -> DataFrame:
    """Labels outside the held-out fold (crc32 of the id as text, remainder 0)."""
    return labels.where(id_remainder(id_col, folds) != 0)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score stays below the threshold."""
    model = train(docs, training_labels(labels))
    return docs.where(toxicity_score(docs.sparkSession, model) < threshold)


def op3_nb_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, training_labels(labels.select("doc_id", "toxic")))
    return (docs.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"),
                        toxicity_score(spark, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
