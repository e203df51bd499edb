import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.llm import toxicity
from scorewatch.llm.queries import QUERIES
from scorewatch.llm.toxicity import (KeyIndex, calibration, drop_toxic, fit_logistic, gram_hashes, toxicity_score, train,
                                     training_labels)

from .helpers import SF, empty, messy, messy_rows


def test_fit_reaches_the_minimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(12, rng.integers(0, 6), replace=False)) for _ in range(200)]
    y = np.array([float(3 in r) if rng.random() < 0.9 else float(rng.random() < 0.5) for r in rows])
    weight, scale, l2 = rng.random(200) + 0.5, rng.standard_normal(12), 0.01
    w, b = fit_logistic(rows, y, weight, scale, l2, steps=300)

    def loss(v):
        z = np.array([(v[:12] * scale)[r].sum() + v[12] for r in rows])
        return ((weight / weight.sum()) * (np.logaddexp(0, z) - y * z)).sum() + l2 / 2 * (v[:12] ** 2).sum()

    best = np.append(w, b)
    for i in range(13):
        step = np.eye(13)[i] * 1e-4
        assert abs(loss(best + step) - loss(best - step)) / 2e-4 < 1e-3


def plain_grams(text):
    kept = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in f" {text.lower()} ")
    kept = re.sub(" +", " ", kept)
    return {kept[i:i + n] for n in (3, 4, 5) for i in range(len(kept) - n + 1)}


def test_grams_see_case_blanks_and_edges_alike():
    assert gram_hashes("An Idiot!").tolist() == gram_hashes("an   idiot.").tolist()
    assert len(gram_hashes("")) == 0 and len(gram_hashes("a")) == 1
    assert set(gram_hashes("idiot").tolist()) <= set(gram_hashes("an idiot here").tolist())


@pytest.mark.parametrize("cut", [4, 7, 1 << 18])
def test_keys_are_the_distinct_grams_however_a_text_is_sliced(monkeypatch, cut):
    texts = ["", "x", "ab", "aaaaaaaaaaaa", "An idiot, \U0001f600 and naïve 中文文本 of no spaces", "word " * 40]
    whole = [gram_hashes(t) for t in texts]
    monkeypatch.setattr(toxicity, "SLICE", cut)
    for t, keys in zip(texts, whole, strict=True):
        assert gram_hashes(t).tolist() == keys.tolist() and len(keys) == len(plain_grams(t))


def test_index_finds_exactly_the_held_keys():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 1000):
        keys = np.unique(np.concatenate((rng.integers(0, 2 ** 63, size // 2, dtype=np.uint64) * np.uint64(2),
                                         np.arange(size - size // 2, dtype=np.uint64) + np.uint64(7))))    # one crowded prefix
        wanted = np.concatenate((keys, keys + np.uint64(1), np.array([0, 2 ** 64 - 1], np.uint64)))
        place = {int(k): i for i, k in enumerate(keys)}
        assert KeyIndex(keys).find(wanted).tolist() == [place[int(w)] for w in wanted if int(w) in place]


def test_calibration_puts_one_half_at_the_least_cost():
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.3).astype(float)
    margins = np.round(rng.normal(2 * y - 1, 1), 1)
    for cost in (0.5, 1.0, 4.0):
        slope, offset = calibration(margins, y, cost)
        def price(flagged):
            return (1 - flagged[y == 1].mean()) + cost * flagged[y == 0].mean()
        best = min(price(margins >= c) for c in [*np.unique(margins), np.inf])
        assert slope > 0 and price(slope * margins + offset >= 0) == pytest.approx(best)
    apart = np.array([-3.0, -2.0, 4.0])
    slope, offset = calibration(apart, np.array([0.0, 0.0, 1.0]), 1.0)
    assert -offset / slope == pytest.approx(1.0)
    assert calibration(apart, np.zeros(3), 1.0) == (1.0, 0.0)
    assert calibration(-apart, np.array([0.0, 0.0, 1.0]), 1.0) == (1.0, 0.0)


@pytest.mark.parametrize("chunk", [5, 1 << 21])
def test_scores_equal_a_plain_version(spark, monkeypatch, chunk):
    """Every n-gram a feature, ratios from the other folds, fit, calibration: in plain Python over strings."""
    monkeypatch.setattr(toxicity, "CHUNK", chunk)
    rng = np.random.default_rng(11)
    words = ["idiot", "fool", "table", "river", "warm", "stupid", "green", "walks", "naïve", "trash"]
    rows = []
    for i in range(80):
        bad = int(i % 3 == 0)
        pick = rng.choice(len(words), rng.integers(1, 7), p=np.array([3, 3, 1, 1, 1, 3, 1, 1, 1, 3] if bad else [1] + [1] + [3] * 3 + [1] + [3] * 3 + [1]) / (18 if bad else 22))
        rows.append((i, " ".join(words[k] for k in pick) if i else None, bad))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    folds = dict(docs.select("doc_id", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(3)).cast("int")).collect())
    order = [r[0] for r in docs.orderBy(F.xxhash64("doc_id")).collect()]
    label, grams = {i: y for i, _, y in rows}, {i: plain_grams(t or "") for i, t, _ in rows}
    vocabulary = sorted(set().union(*grams.values()))

    def plain_fit(ids):
        n = [sum(label[i] == y for i in ids) for y in (0, 1)]
        seen = [Counter(g for i in ids if label[i] == y for g in grams[i]) for y in (0, 1)]
        scale = np.array([math.log((seen[1][g] + 1) / (n[1] + 2)) - math.log((seen[0][g] + 1) / (n[0] + 2))
                          if seen[0][g] + seen[1][g] else 0.0 for g in vocabulary])
        place = {g: k for k, g in enumerate(vocabulary)}
        w, bias = fit_logistic([np.array(sorted(place[g] for g in grams[i]), np.int32) for i in ids],
                               np.array([float(label[i]) for i in ids]), np.array([1 / n[label[i]] for i in ids]), scale, 0.01)
        weight = dict(zip(vocabulary, w * scale, strict=True))
        return lambda i: bias + sum(weight[g] for g in grams[i])

    margins = {}
    for f in range(3):
        margin = plain_fit([i for i in order if folds[i] != f])
        margins |= {i: margin(i) for i in order if folds[i] == f}
    slope, offset = calibration(np.array([margins[i] for i in order]), np.array([float(label[i]) for i in order]),
                                sum(not y for y in label.values()) / sum(label.values()))
    margin = plain_fit(order)
    found = scored(spark, docs, labels)
    for i, t, _ in rows:
        assert found[(i, t)] == pytest.approx(1 / (1 + math.exp(-(slope * margin(i) + offset))), abs=1e-4)


def test_a_hot_id_is_learnt_from_once(spark):
    docs = spark.range(400).selectExpr("CASE WHEN id < 300 THEN 0 ELSE id END AS doc_id",
                                       "CASE WHEN id < 300 OR id % 2 = 0 THEN 'you idiot fool' ELSE 'a warm green table' END AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 2 = 0 AS int) AS toxic")
    once = docs.dropDuplicates(["doc_id"])
    assert set(scored(spark, docs, labels).items()) == set(scored(spark, once, labels).items())


def scored(spark, docs, labels, **kw):
    model = train(docs, labels, **kw)
    return {(r[0], r[1]): r[2] for r in docs.select("doc_id", "text", toxicity_score(spark, model)).collect()}


def test_messy_rows_and_missing_classes(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (2, 0), (3, 1), (4, None), (None, 1), (100, 1), (101, 0), (999, 1), (106, 0)],
                                   "doc_id long, toxic int")
    found = scored(spark, docs, labels)
    assert set(found) == {(r[0], r[1]) for r in messy_rows()} and all(0 <= s <= 1 for s in found.values())
    assert found[(100, None)] == found[(101, "")]
    none = scored(spark, docs, labels.limit(0))
    assert set(none.values()) == {0.0}
    one = scored(spark, docs, labels.where("toxic = 0"))
    assert all(0 < s < 0.5 for s in one.values()) and len(set(one.values())) == 1
    assert drop_toxic(docs, labels.limit(0)).columns == docs.columns
    assert drop_toxic(docs, labels.limit(0)).count() == len(messy_rows())
    assert drop_toxic(empty(spark), labels).collect() == []
    named = docs.selectExpr("doc_id", "text", "1.5 AS _toxicity")
    assert drop_toxic(named, labels.limit(0)).columns == named.columns


def test_held_out_accuracy_and_use_of_training_labels_only(spark, tmp_path):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op3_nb_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for d, r in rows.items())
    assert {r.doc_id for r in training_labels(spark.createDataFrame(labels)).collect()} == \
        {r.doc_id for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5}
    out = [(r.toxic, rows[r.doc_id]) for r in labels if rows[r.doc_id].held_out]
    clean, toxic = [r for t, r in out if not t], [r for t, r in out if t]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean]
    assert sum(pairs) / len(pairs) > 0.95


@pytest.mark.parametrize("bound", [3, 40])
def test_the_sample_is_bounded(spark, bound):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = train(docs, labels, sample_per_class=bound)
    hashed = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y")) \
        .withColumn("h", F.xxhash64("doc_id")).collect()
    ids = [r.doc_id for y in (0, 1) for r in sorted((r for r in hashed if r.y == y), key=lambda r: (r.h, r.doc_id))[:bound]]
    texts = docs.where(F.col("doc_id").isin(ids)).select("text").collect()
    assert len(model.weights) == len(set().union(*(plain_grams(r.text or "") for r in texts)))


def test_every_model_is_fitted_once_in_as_many_tasks_as_folds():
    for folds in (1, 2, 3, 5):
        tasks = toxicity.fit_tasks(folds)
        assert len(tasks) == folds and sorted(sum(tasks, [])) == list(range(folds + 1))


def test_a_worker_gets_few_texts_at_once(spark):
    from scorewatch.llm.common import bounded_batches

    def sizes(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    bounded_batches(spark)
    texts = spark.range(0, 1200, 1, 1).select(F.expr("repeat('ab cd', 2000)").alias("text"))
    held = [r.bytes for r in texts.mapInArrow(sizes, "bytes long").collect()]
    assert sum(held) > 12_000_000 and max(held) < 3_000_000


def test_the_fit_leaves_no_copy_of_its_counts_at_the_driver(spark, monkeypatch):
    from pyspark.core.broadcast import Broadcast
    gone, destroy = [], Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (gone.append(self), destroy(self, *a))[1])
    docs = spark.createDataFrame([(i, "you idiot" if i % 2 else "a fine day") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = train(docs, labels)
    assert len(gone) == 1 and model.score("you idiot") > model.score("a fine day")
