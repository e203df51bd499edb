import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.llm.hmm import CLASSES, Hmm, class_texts, first_guess, hmm_scores, segments
from scorewatch.llm.queries import QUERIES

from .helpers import SF, empty, messy, messy_rows, words_of


def small(seed=0, k=3, n=5):
    rng = np.random.default_rng(seed)
    emit = rng.random((n, k))
    return Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), emit / emit.sum(axis=0))


def paths(model, text):
    """(states, probability) of every path."""
    k = len(model.start)
    for z in itertools.product(range(k), repeat=len(text)):
        p = model.start[z[0]] * model.emit[text[0], z[0]]
        for t in range(1, len(text)):
            p *= model.move[z[t - 1], z[t]] * model.emit[text[t], z[t]]
        yield z, p


def test_forward_equals_the_sum_over_paths():
    model = small()
    texts = [np.array(t) for t in ([0], [1, 2], [4, 4, 3, 0, 1], [2, 0, 1], [3], [0, 0, 0, 0, 0, 0])]
    want = [math.log(sum(p for _, p in paths(model, t))) for t in texts]
    assert model.forward(texts) == pytest.approx(want)
    long = [np.arange(5000) % 5]
    assert np.isfinite(model.forward(long)).all()


def test_expected_counts_equal_the_posterior_over_paths():
    model = small(3)
    texts = [np.array([0, 1, 4]), np.array([2]), np.array([3, 3, 0, 2])]
    starts, moves, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for t in texts:
        every = list(paths(model, t))
        total = sum(p for _, p in every)
        for z, p in every:
            starts[z[0]] += p / total
            for i, s in enumerate(z):
                emissions[t[i], s] += p / total
                if i:
                    moves[z[i - 1], s] += p / total
    got = model.expected(*segments(texts, 4))
    for a, b in zip(got, (starts, moves, emissions)):
        assert a == pytest.approx(b)


def test_each_pass_raises_the_likelihood():
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(0, 20, 30) + 20 * (i % 2), 40) for i in range(40)]
    share = np.bincount(np.concatenate(texts), minlength=41) / 31 / 40
    model, last = first_guess(share, 2), -math.inf
    for _ in range(8):
        now = model.forward(texts).sum()
        assert now > last - 5           # smoothing may cost a little near the end
        last = now
        model = Hmm.of_counts(*model.expected(*segments(texts, 64)), share)
    assert last > first_guess(share, 2).forward(texts).sum() + 100


def test_segments_hold_every_token():
    texts = [np.arange(n) % 7 for n in (1, 3, 4, 5, 9)]
    tokens, begins, lengths = segments(texts, 4)
    assert lengths.tolist() == [1, 3, 4, 4, 1, 4, 4, 1] and begins.tolist() == [True, True, True, True, False, True, False, False]
    assert np.concatenate([t[:n] for t, n in zip(tokens, lengths)]).tolist() == np.concatenate(texts).tolist()


def plain_base(rows, held_out):
    counts = Counter()
    for d, t in rows:
        if not held_out(d):
            counts.update([*words_of(t), "\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        tokens = [*words_of(t), "\n"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        out.append((str(d), held_out(d), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6)))
    return sorted(out)


def fold(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0


def got(rows):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


def test_messy_rows_and_empty_table(spark):
    from scorewatch.llm.common import id_remainder
    rows = hmm_scores(messy(spark), id_remainder("doc_id", 10) == 0, passes=1).collect()
    assert got(rows) == plain_base([(r[0], r[1]) for r in messy_rows()], fold)
    assert all(np.isfinite(r.score) and r.score <= 0 for r in rows)
    assert hmm_scores(empty(spark), F.lit(False)).collect() == []
    unseen = hmm_scores(messy(spark), F.lit(True)).collect()           # nothing to learn from
    assert {r.n_known for r in unseen} == {0} and all(np.isfinite(r.score) for r in unseen)


def test_blocks_change_nothing(spark, monkeypatch):
    from scorewatch.llm import hmm
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = got(QUERIES["op4_hmm_scores"](spark, SF).collect())
    monkeypatch.setattr(hmm, "BLOCK_ROWS", 17)
    from scorewatch.llm.common import id_remainder
    assert got(hmm_scores(docs, id_remainder("doc_id", 10) == 0).collect()) == want
    assert want == plain_base([(r.doc_id, r.text) for r in docs.collect()], fold)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in QUERIES["op4_hmm_scores"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 0.05


def test_within_class_shares_and_the_end_sum_to_one():
    texts = class_texts([b"One two", b"", b" one\n"])
    assert [t[-1] for t in texts] == [CLASSES] * 3 and [len(t) for t in texts] == [3, 1, 2] and texts[0][0] == texts[2][0]


def alternating(n, a, b):
    """The Thue-Morse word of n letters: sums of powers of one base cancel out between it and its complement."""
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


def test_words_of_patterned_letters_stay_apart(spark):
    rows = [(i, f"w{i} common words here") for i in range(50)]
    rows += [(100, alternating(2048, "p", "q")), (101, alternating(2048, "q", "p"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    from scorewatch.llm.common import id_remainder
    assert got(hmm_scores(docs, id_remainder("doc_id", 10) == 0, passes=1).collect()) == plain_base(rows, fold)


def test_blocks_over_several_row_groups_count_once(spark):
    from scorewatch.llm.common import id_remainder
    hadoop, small = spark.sparkContext._jsc.hadoopConfiguration(), {"parquet.block.size": "65536", "parquet.block.size.row.check.min": "10"}
    conf = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"}
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 100_000, 300))) for i in range(400)]      # hardly compressible
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    try:
        for k, v in small.items():
            hadoop.set(k, v)
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert got(hmm_scores(docs, id_remainder("doc_id", 10) == 0, passes=1).collect()) == plain_base(rows, fold)
    finally:
        for k in small:
            hadoop.unset(k)
        for k in conf:
            spark.conf.unset(k)


def test_training_counts_every_text_in_every_pass(spark):
    from scorewatch.llm.common import id_remainder
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{x}" for x in rng.integers(0, 40, 50))) for i in range(2000)]   # more than 1,500 texts
    train = [t.encode() for d, t in rows if not fold(d)]
    counts = Counter(w for t in train for w in words_of(t.decode()))
    classes = {w: int(class_texts([w.encode()])[0][0]) for w in {w for _, t in rows for w in words_of(t)}}
    n, v = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for w, c in counts.items():
        n[classes[w]] += c
        v[classes[w]] += 1
    n[CLASSES], v[CLASSES] = len(train), 1
    share = (n + 0.5) / (n + 0.5).sum()
    model, parts = first_guess(share, 8), segments(class_texts(train))
    for _ in range(3):
        model = Hmm.of_counts(*model.expected(*parts), share)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    have = {r.doc_id: r.score for r in hmm_scores(docs, id_remainder("doc_id", 10) == 0, passes=3).collect()}
    for (d, t), whole in zip(rows, model.forward(class_texts([t.encode() for _, t in rows])), strict=True):
        within = sum(math.log10((counts[w] + 0.1) / (n[classes[w]] + 0.1 * (v[classes[w]] + 1))) for w in words_of(t))
        assert have[d] == pytest.approx(within + whole / math.log(10), rel=1e-6)
