import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from scorewatch.llm.quality import (END, ORDER, START, base_counts, keep_good, quality_verdicts, symbols_of, train_model)
from scorewatch.llm.queries import QUERIES

from .helpers import SF, WORD, empty, messy, messy_rows


def plain_base(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts():
    texts = ["", " ", "a", "a b c d e a b c d e", "x x x x x x", "é b 中文 \x1c\n\n#%\n#%\n # \n", "one\r\none\r\n", "a b c d e f a b c d e f g",
             "\x0b\x0cz|z<>*$&\t"] + [r[1] or "" for r in messy_rows()]
    for t in texts:
        assert base_counts(t.encode()) == plain_base(t)


def plain_kneser_ney(texts):
    """Interpolated modified Kneser-Ney over symbol tuples, from its definition."""
    count = {ORDER: Counter()}
    for t in texts:
        s = symbols_of(t).tolist()
        count[ORDER].update(tuple(s[i:i + ORDER]) for i in range(len(s) - ORDER + 1))
    for n in range(ORDER - 1, 0, -1):
        count[n] = Counter(g[1:] for g in count[n + 1])
    discount, total, kinds = {}, {}, {}
    for n, c in count.items():
        of = Counter(c.values())
        y = of[1] / (of[1] + 2 * of[2])
        ds = []
        for k in (1, 2, 3):
            d = k - (k + 1) * y * of[k + 1] / of[k] if of[k] else None
            ds.append(d if d is not None and 0 < d < k else 0.5)
        discount[n] = ds
        total[n], kinds[n] = Counter(), defaultdict(float)
        for g, v in c.items():
            total[n][g[:-1]] += v
            kinds[n][g[:-1]] += ds[min(v, 3) - 1]

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / (len(count[1]) + 1)
        ctx, v = g[:-1], count[n][g]
        if not total[n][ctx]:
            return p(g[1:])
        d = discount[n][min(v, 3) - 1] if v else 0
        return (v - d) / total[n][ctx] + kinds[n][ctx] / total[n][ctx] * p(g[1:])

    return p


def test_model_equals_the_definition(spark, monkeypatch):
    texts = ["the cat sat on the mat", "the cat ran", "a dog sat on a log", "the the the", "zebra"] * 2 + ["cats and dogs and cats"]
    df = spark.createDataFrame([("en", t) for t in texts] + [(None, "un chat noir"), ("de", None), ("de", "")], "lang string, text string")
    model = train_model(df)
    p = plain_kneser_ney(texts)
    for t in [*texts, "the dog ran on", "Unseen \U0001f600 text!", "q"]:
        s = symbols_of(t)
        want = sum(math.log10(p(tuple(s.tolist()[i:i + ORDER]))) for i in range(len(s) - ORDER + 1))
        assert model.log10("en", [s])[0] == pytest.approx(want, rel=1e-4)
    assert np.isnan(model.log10("de", [symbols_of("x")])[0])
    known = sorted({c for t in texts for c in symbols_of(t)[ORDER - 1:].tolist()})
    for context in ((START,) * 3, tuple(map(ord, "the")), tuple(map(ord, " th"))):
        assert sum(p((*context, c)) for c in known) + p((*context, 0xD7FF)) == pytest.approx(1)
    assert END in known


def test_messy_rows(spark):
    rows = quality_verdicts(messy(spark)).collect()
    given = messy_rows()
    assert len(rows) == len(given)
    want = sorted((str(r[0]),) + plain_base(r[1] or "") for r in given)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    docs = messy(spark)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)


def test_empty_table(spark):
    assert quality_verdicts(empty(spark)).collect() == [] and keep_good(empty(spark)).collect() == []


def test_query_keeps_clean_documents_and_bands_reject_noise(spark):
    rows = {r.doc_id: r for r in QUERIES["op1_perplexity_rules"](spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(rows) == set(docs)
    good = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()]
    sound = [d for d in good if not rows[d].base_failed]
    assert sum(rows[d].kept for d in sound) >= 0.97 * len(sound)
    assert all(r.kept == (not r.base_failed and r.low <= r.log10_perplexity <= r.high) for r in rows.values() if r.low is not None and r.n_words)


def test_bands_reject_both_sides(spark):
    rng = np.random.default_rng(1)
    words = ["the", "house", "of", "river", "stone", "green", "and", "walks", "under", "light"]
    clean = [" ".join(rng.choice(words, 60)) for _ in range(200)]
    noise = "".join(chr(int(c)) if i % 9 else " " for i, c in enumerate(rng.integers(0x21, 0x7E, 600)))
    # 12 different words whose letters repeat one pair: far more predictable than the rest.
    dull = " ".join("th" * k for k in range(1, 40))
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*clean, noise, dull])], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in quality_verdicts(df).collect()}
    assert not rows[200].kept and not rows[200].base_failed and rows[200].log10_perplexity > rows[200].high
    assert not rows[201].kept and not rows[201].base_failed and rows[201].log10_perplexity < rows[201].low
    assert sum(rows[i].kept for i in range(200) if not rows[i].base_failed) >= 198
