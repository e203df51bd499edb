import random

import numpy as np
import pytest

from scorewatch.llm.graph import components
from scorewatch.llm.jaccard import CountTree, Routing, keep_one, near_duplicates, needed, shingle_sets
from scorewatch.llm.queries import QUERIES

from .helpers import SF, empty, messy, messy_rows, words_of


def plain_set(text, width):
    w = words_of(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def plain_components(rows, width, num, den):
    """{row number: (n, component)} by comparing all pairs; rows of one id are one document."""
    sets = [plain_set(t, width) for _, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, _) in enumerate(rows):
        for j in range(i):
            e = rows[j][0]
            if d is None or e is None or not sets[i] or not sets[j]:
                continue
            c = len(sets[i] & sets[j])
            if den * c >= num * len(sets[i] | sets[j]):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return sorted((str(d), len(s), str(None if d is None else find(d))) for (d, _), s in zip(rows, sets))


def varied(seed, n=160):
    """Templates with copies and edits of any strength, a passage that many share, short texts, chains."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    rows, doc = [], 0
    while len(rows) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 8, 20, 60, 150, 400]))]
        chain = rng.random() < 0.3
        for _ in range(rng.choice([1, 1, 2, 6, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if chain:
                base = words
            text = " ".join(words) + (" " + passage if rng.random() < 0.4 else "")
            rows.append((doc, text.upper() if rng.random() < 0.1 else text))
            doc += rng.randint(1, 3)
    rng.shuffle(rows)
    return rows


def got(found):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found.collect())


@pytest.mark.parametrize(("seed", "width", "num"), [(1, 3, 90), (2, 5, 80), (3, 1, 50)])
def test_components_equal_all_pairs(spark, seed, width, num):
    rows = varied(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(near_duplicates(df, width, num, 100)) == plain_components(rows, width, num, 100)


def test_blocks_and_frequent_elements_change_nothing(spark, monkeypatch):
    from scorewatch.llm import jaccard
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = varied(9, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicates(df, 3, 80, 100)) == plain_components(rows, 3, 80, 100)


@pytest.mark.parametrize(("num", "common"), [(90, 0.0), (80, 0.0), (80, 0.5), (90, 0.97), (60, 0.2)])
def test_every_linked_pair_shares_a_key(num, common):
    rng = np.random.default_rng(num)
    universe = rng.integers(0, 1 << 63, 6000).astype(np.uint64)
    routing = Routing(num, 100, np.sort(universe[: int(common * len(universe))]))
    met = 0
    for _ in range(1500):
        n = int(rng.choice([1, 2, 3, 5, 9, 17, 40, 90, 200, 700]))
        a = rng.choice(universe, n, replace=False)
        gone = int(rng.integers(0, max(1, int(n * (100 - num) / 100) + 1) + 1))
        new = rng.integers(0, 1 << 63, int(rng.integers(0, gone + 1))).astype(np.uint64)
        b = np.unique(np.concatenate((rng.permutation(a)[gone:], new)))
        a = np.unique(a)
        common_n = len(np.intersect1d(a, b))
        if len(b) and 100 * common_n >= num * (len(a) + len(b) - common_n):
            met += 1
            assert np.intersect1d(routing.keys(a), routing.keys(b)).size
    assert met > 300


def test_tree_finds_all_that_the_bound_allows():
    rng = np.random.default_rng(4)
    points = rng.poisson(3, (500, 64)).astype(np.int64)
    points[250:] = points[:250] + (rng.random((250, 64)) < 0.05)
    sizes, labels = points.sum(axis=1), rng.integers(0, 400, 500)
    tree = CountTree(points, sizes, labels, 90, 100)
    for q in range(0, 500, 7):
        bound = np.minimum(points, points[q]).sum(axis=1)
        fits = (np.minimum(sizes, sizes[q]) * 100 >= 90 * np.maximum(sizes, sizes[q])) & (bound >= needed(sizes[q], sizes, 90, 100))
        want = np.flatnonzero(fits & (labels != labels[q]))
        assert sorted(tree.search(points[q], int(sizes[q]), int(labels[q])).tolist()) == want.tolist()


def test_shingles_are_told_apart_as_word_runs():
    texts = ["a b c d", "A B\tC\nD", "a b", "ab", "", " ", "a b c", "xÉ y z", "xé y z", "a a a a a"]
    sets = shingle_sets([t.encode() for t in texts], 3)
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            assert (set(sets[i].tolist()) == set(sets[j].tolist())) == (plain_set(x, 3) == plain_set(y, 3))
        assert len(sets[i]) == len(plain_set(x, 3))


def test_messy_rows_and_empty_table(spark):
    assert got(near_duplicates(messy(spark))) == plain_components([(r[0], r[1]) for r in messy_rows()], 3, 90, 100)
    assert near_duplicates(empty(spark)).collect() == []
    assert keep_one(empty(spark)).collect() == []


def kept_by_texts(rows, width, num, den):
    """Ids that stay, by comparing the texts of all rows; rows of one id are different documents."""
    numbered = [(i, t) for i, (d, t) in enumerate(rows) if d is not None]
    comp = {int(i): c for i, _, c in plain_components(numbered, width, num, den)}
    groups, stay = {}, []
    for i, (d, t) in enumerate(rows):
        if d is None or not plain_set(t, width):
            stay.append(d)
        else:
            groups.setdefault(comp[i], []).append(d)
    return sorted([*stay, *(min(g) for g in groups.values())], key=str)


def test_keep_one(spark):
    kept = keep_one(messy(spark), 5, 80, 100)
    assert kept.columns == messy(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == kept_by_texts([(r[0], r[1]) for r in messy_rows()], 5, 80, 100)


def test_keep_one_of_rows_that_share_an_id_and_clashing_names(spark):
    """Unlike texts under one id stay, equal ones go; columns named like the operator's own are kept."""
    base = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(6)]
    rows = [(1, base[0]), (1, base[1]), (1, base[1]), (2, base[1]), (2, base[2] + " more"), (3, base[2]), (4, ""), (4, base[3]), (4, None),
            (5, base[3]), (6, base[4]), (None, base[4]), (7, base[5]), (7, base[5] + " tail")] + [(9, base[0] + f" own{i} a{i} b{i} c{i} d{i} e{i} f{i} g{i} h{i}") for i in range(40)]
    docs = spark.createDataFrame([(d, t, i, 1, "r", 2, 3.0, 4, 5) for i, (d, t) in enumerate(rows)],
                                 "doc_id long, text string, _gone long, _again long, _row string, _id long, _toxicity double, sig long, group long")
    kept = keep_one(docs, 5, 80, 100)
    assert kept.columns == docs.columns
    got_rows = kept.collect()
    assert sorted((r.doc_id for r in got_rows), key=str) == kept_by_texts(rows, 5, 80, 100)
    assert all(rows[r._gone] == (r.doc_id, r.text) for r in got_rows) and len({r._gone for r in got_rows}) == len(got_rows)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(3000, 3001), (3001, 3002), (3002, 3000), (5, 5)]
    edges += [(2000 + rng.randrange(40), 2000 + rng.randrange(40)) for _ in range(30)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in found} == {x: r for x, r in root.items() if x != r}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op2_count_tree_join"](spark, SF)) == plain_components(docs, 3, 90, 100)
