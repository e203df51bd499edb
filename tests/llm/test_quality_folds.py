import math

import numpy as np
import pytest

from scorewatch.llm.quality import ORDER, quality_verdicts, symbols_of, train_model

from .test_quality import plain_kneser_ney

WORDS = ["the", "house", "of", "river", "stone", "green", "and", "walks", "under", "light"]


def noise(rng, n):
    return "".join(chr(int(c)) if i % 9 else " " for i, c in enumerate(rng.integers(0x21, 0x7E, n)))


def verdicts(spark, texts):
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    return {r.doc_id: r for r in quality_verdicts(df).collect()}


def test_neither_length_nor_copies_make_noise_predictable(spark):
    rng = np.random.default_rng(2)
    clean = [" ".join(rng.choice(WORDS, 60)) for _ in range(200)]
    rows = verdicts(spark, clean + [noise(rng, 3_000)] * 20 + [noise(rng, 60_000)])
    for i in range(200, 221):
        assert not rows[i].base_failed and not rows[i].kept and rows[i].log10_perplexity > rows[i].high
    assert sum(rows[i].kept for i in range(200)) >= 0.95 * sum(not rows[i].base_failed for i in range(200))


def test_base_failed_texts_are_not_counted(spark):
    rng = np.random.default_rng(3)
    clean = [" ".join(rng.choice(WORDS, 60)) for _ in range(80)]
    junk = [noise(rng, 3_000).replace(" ", "") for _ in range(20)] + ["the house of river stone " * 50]
    alone, both = verdicts(spark, clean), verdicts(spark, clean + junk)
    assert all(both[i].base_failed for i in range(80, 101))
    assert all(abs(alone[i].log10_perplexity - both[i].log10_perplexity) < 1e-6 for i in range(80))


def test_unseen_ngrams_back_off_however_many_were_counted(spark):
    """Half a million distinct 4-grams: scores of new text equal the definition, no n-gram passes for another."""
    rng = np.random.default_rng(4)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x4E00 + 3000, 5_000))) for _ in range(100)] + ["abcdefghij"]
    model = train_model(spark.createDataFrame([("zh", t) for t in texts], "lang string, text string"))
    p = plain_kneser_ney(texts)
    s = symbols_of("".join(map(chr, rng.integers(0x4E00, 0x4E00 + 3000, 5_000))))
    want = sum(math.log10(p(tuple(s.tolist()[i:i + ORDER]))) for i in range(len(s) - ORDER + 1))
    assert model.log10("zh", [s])[0] == pytest.approx(want, rel=1e-4)
