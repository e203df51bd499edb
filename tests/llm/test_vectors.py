import hashlib
import math
import random

import numpy as np
import pytest

from scorewatch.llm.queries import QUERIES
from scorewatch.llm.vectors import Gnat, component_limit, product_codes

SF = "/root/testdata/sf0.001"


def brute(entries, queries):
    d = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    return d.min(axis=1), d.argmin(axis=1)


@pytest.mark.parametrize("spread", [3, 40, 100_000])
@pytest.mark.parametrize("n", [0, 1, 4, 5, 16, 60])
def test_gnat_finds_the_nearest_entry_and_the_lower_of_two(n, spread):
    rng = np.random.default_rng(n + spread)
    entries = rng.integers(-spread, spread + 1, (n, 8))
    if n > 4:
        entries[n - 1] = entries[1]                      # equal entries tie everywhere
    queries = np.concatenate((rng.integers(-spread, spread + 1, (500, 8)), entries))
    d, at = Gnat(entries).nearest(queries)
    if n == 0:
        assert set(at) <= {0}
        return
    want_d, want_at = brute(entries, queries)
    assert d.tolist() == want_d.tolist() and at.tolist() == want_at.tolist()


def test_gnat_leaves_out_far_subtrees():
    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (8, 8))
    entries = np.repeat(centres, 8, axis=0) + rng.integers(-50, 50, (64, 8))
    queries = entries[rng.integers(0, 64, 300)] + rng.integers(-50, 50, (300, 8))
    tree = Gnat(entries)
    d, at = tree.nearest(queries)
    assert at.tolist() == brute(entries, queries)[1].tolist()
    assert tree.visited < 0.5 * 64 * 300


def test_ties_at_the_very_radius_survive():
    """Entries on a lattice circle around the queries: every distance is the same."""
    entries = np.array([[5, 0], [-5, 0], [0, 5], [0, -5], [3, 4], [4, 3], [-3, 4], [3, -4], [-4, -3]])
    for order in range(20):
        mixed = np.random.default_rng(order).permutation(entries)
        d, at = Gnat(mixed, degree=2).nearest(np.zeros((1, 2), np.int64))
        assert d[0] == 25 and at[0] == 0


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """id, label, vector -> the contract's rows, by plain Python integers."""
    kept = [(i, lab, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    n = len(kept[0][2])
    w = n // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * w:(p + 1) * w] for r in first] for p in range(parts)]

    def assign(v):
        out = []
        for p in range(parts):
            ds = [sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], e, strict=True)) for e in books[p]]
            out.append((ds.index(min(ds)), min(ds)))
        return out

    for _ in range(rounds):
        held = {}
        for _, _, v in kept:
            for p, (e, _) in enumerate(assign(v)):
                held.setdefault((p, e), []).append(v[p * w:(p + 1) * w])
        for (p, e), vs in held.items():
            books[p][e] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    coded = [(i, lab, a) for i, lab, v in kept for a in [assign(v)]]
    total = {}
    for _, lab, a in coded:
        total[lab] = total.get(lab, 0) + sum(d for _, d in a)
    return sorted(((i, "".join(f"{e:02x}" for e, _ in a), sum(d for _, d in a), total[lab], digest) for i, lab, a in coded), key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, id long, v int, _label int, length int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 1, 2, 3, 4, 5) for i, lab, v in rows], SCHEMA)


def messy(n=150, dim=16, seed=2):
    rng = random.Random(seed)
    rows = [(i if rng.random() < 0.95 else None, rng.choice([0, 0, 0, 1, None]), [rng.choice([-1.0, 0.0, 0.5, rng.uniform(-2, 2)]) for _ in range(dim)]) for i in range(n)]
    rows += [rows[5], rows[5], (7, 1, rows[9][2])]                                     # repeated rows, one id twice
    rows += [(500, 1, None), (501, None, [None] + [0.0] * (dim - 1)), (502, 1, [float("nan")] * dim), (503, 2, [float("-inf")] + [1.0] * (dim - 1))]
    return rows


@pytest.mark.parametrize("n", [150, 9, 1])
def test_codes_equal_the_plain_version(spark, n):
    rows = messy(n) if n > 9 else messy(20)[:n]
    got = sorted((tuple(r) for r in product_codes(frame(spark, rows)).collect()), key=repr)
    assert got == plain_codes(rows)


def test_vectors_that_cannot_be_coded(spark):
    rows = messy(40)
    odd = [(900, 1, [1.0] * 8), (901, 1, []), (902, 1, [1e30] * 16), (903, 1, [float(component_limit(16)) / 4096 * 2] * 16)]
    got = {r[0]: tuple(r) for r in product_codes(frame(spark, rows + odd)).collect() if r[0] is not None}
    want = {r[0]: r for r in plain_codes(rows) if r[0] is not None}
    assert {k: v for k, v in got.items() if k < 900} == want
    assert all(got[k][1:4] == (None, None, None) for k in (900, 901, 902, 903))
    assert product_codes(frame(spark, [])).collect() == []
    assert [tuple(r)[:4] for r in product_codes(frame(spark, [(1, 1, [1.0] * 9)])).collect()] == [(1, None, None, None)]
    assert [tuple(r)[:4] for r in product_codes(frame(spark, [(1, 1, [])])).collect()] == [(1, "00" * 8, 0, 0)]


def test_query_columns(spark):
    df = QUERIES["op11_gnat_codes"](spark, SF)
    assert df.dtypes == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]
