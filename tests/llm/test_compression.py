import zlib

import numpy as np
import pytest
import zstandard

from scorewatch.llm.compression import LEVEL, PIECE, CompressionClassifier, Sizes, fit_curve, keep_good_quality, quality_score, train, training_labels
from scorewatch.llm.queries import QUERIES

from .helpers import SF, empty, messy, messy_rows


def plain_score(model: CompressionClassifier, text):
    """The definition, piece by piece with fresh compressors."""
    raw = (text or "").encode()
    sizes = []
    for content in (model.good, model.bad):
        total = 0
        for i in range(0, len(raw), PIECE):
            c = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_dict_id=False)
            total += len(c.compress(raw[i:i + PIECE]))
        sizes.append(total)
    x = (sizes[1] - sizes[0]) / len(raw) if raw else 0.0
    return 1 / (1 + np.exp(-(model.bias + model.slope * x)))


def test_curve_reaches_the_minimum():
    rng = np.random.default_rng(0)
    x = rng.standard_normal(500) * 0.02
    y = (rng.random(500) < 1 / (1 + np.exp(-(80 * x + 0.5)))).astype(float)
    weight = rng.random(500) + 0.5
    slope, bias = fit_curve(x, y, weight)
    scale = x.std()

    def loss(a, b):
        z = a * x + b
        return ((weight / weight.sum()) * (np.logaddexp(0, z) - y * z)).sum() + 1e-4 / 2 * (a * scale) ** 2

    for da, db in ((1e-3, 0), (-1e-3, 0), (0, 1e-4), (0, -1e-4)):
        assert loss(slope + da, bias + db) >= loss(slope, bias) - 1e-12
    assert fit_curve(np.zeros(10), np.array([0.0, 1.0] * 5), np.ones(10))[1] == pytest.approx(0, abs=1e-9)


def test_every_piece_of_a_long_text_counts():
    sizes = Sizes(b"the good words here " * 50, b"### bad $$$ words &&& " * 50)
    good, bad = b"the good words here " * 400, b"### bad $$$ words &&& " * 400
    assert sizes.evidence(good) > 0 > sizes.evidence(bad) and sizes.evidence(b"") == 0.0
    aligned = good[:PIECE * 5]
    assert sizes.evidence(aligned + bad[:PIECE * 5]) < sizes.evidence(aligned)


def test_scores_equal_the_plain_version_and_labels_of_the_held_out_fold_are_not_used(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = train(docs, training_labels(labels))
    assert model.good and model.bad and model.slope > 0
    got = docs.select("doc_id", "text", quality_score(spark, model).alias("s")).collect()
    assert all(abs(r.s - plain_score(model, r.text)) < 1e-9 for r in got)
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    assert train(docs, training_labels(turned)) == model
    query = {r.doc_id: r for r in QUERIES["op12_compression_quality"](spark, SF).collect()}
    assert all(query[r.doc_id].score == r.s for r in got) and len(query) == len(got)


def test_messy_rows_and_missing_classes(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (2, 0), (3, 1), (4, None), (None, 1), (100, 1), (101, 0), (999, 1), (106, 0), (5, 1), (6, 1), (8, 0)],
                                   "doc_id long, quality int")
    model = train(docs, labels)
    rows = docs.select("doc_id", "text", quality_score(spark, model).alias("s")).collect()
    found = {(r.doc_id, r.text): r.s for r in rows}
    assert len(rows) == len(messy_rows()) and set(found) == {(r[0], r[1]) for r in messy_rows()} and all(0 <= s <= 1 for s in found.values())
    assert found[(100, None)] == found[(101, "")]
    scored = lambda lab: {r.s for r in docs.select(quality_score(spark, train(docs, lab)).alias("s")).collect()}
    assert scored(labels.limit(0)) == {0.0}
    one = scored(labels.where("quality = 1"))
    assert len(one) == 1 and 0.5 < min(one) < 1
    assert keep_good_quality(docs, labels.limit(0)).columns == docs.columns and keep_good_quality(docs, labels.limit(0)).count() == 0
    assert keep_good_quality(empty(spark), labels).collect() == []


def test_one_id_with_very_many_texts_keeps_the_sample_bounded(spark):
    rows = [(1, f"text number {i} of one id") for i in range(500)] + [(i, f"good words of document {i}") for i in range(2, 40)] + [(i, f"### bad $$$ {i}") for i in range(40, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(1, 80)], "doc_id long, quality int")
    model = train(docs, labels, sample_per_class=20)
    assert len(model.good) <= 20 * 1024
    assert docs.select(quality_score(spark, model).alias("s")).count() == len(rows)


def test_held_out_accuracy_and_calibration(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op12_compression_quality"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality is not None]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for d, r in rows.items())
    out = [(r.quality, rows[r.doc_id]) for r in labels if rows[r.doc_id].held_out]
    good, bad = [r for q, r in out if q], [r for q, r in out if not q]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.93 * len(bad)
    assert abs(np.mean([r.score for _, r in out]) - np.mean([q for q, _ in out])) < 0.02
    sure = [q for q, r in out if r.score >= 0.95]
    assert np.mean(sure) >= 0.95
