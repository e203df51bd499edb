import math
import random
import re

import numpy as np
import pytest

from scorewatch.llm.ranked import Shard, build_index, index_shard, rank_shard, search, terms_of

from .helpers import LOWER, empty, messy, messy_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_rank(docs, items, top=20):
    """(item id, rank, doc_id, score) by scoring every document."""
    counted = []
    for i, text in docs:
        tf = {}
        for t in plain_terms(text):
            tf[t] = tf.get(t, 0) + 1
        counted.append((i, tf, sum(tf.values())))
    big_n, big_l = sum(n > 0 for _, _, n in counted), sum(n for _, _, n in counted)
    df = {}
    for _, tf, _ in counted:
        for t in tf:
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        rows = []
        for i, tf, n in counted:
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * (75 + 25 * n * big_n // big_l)))
                        for t in plain_terms(text) if t in tf)
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(rows, key=lambda r: r[:3])[:top], 1)]
    return out


def test_terms():
    for _, text, *_ in messy_rows():
        assert [t.decode() for t in terms_of((text or "").encode())] == plain_terms(text)
    assert terms_of("A_b-c9É　x\x7f{Z".encode()) == ["a".encode(), b"b", "c9É　x".encode(), b"z"]


def corpus(n=400, seed=1):
    """Skewed words, so some lists have many blocks; a third of the texts are copies of one; some very long."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(n // 3)]
    rows += [(5000, " ".join(rng.choices(words, weights, k=20_000))), (5001, "w1 " * 70_000), (5002, ""), (5003, None), (None, rows[4][1]), (7, rows[7][1])]
    items = [(q, " ".join(rng.choices(words, k=rng.randrange(1, 25)))) for q in range(30)]
    items += [(100, None), (101, ""), (102, "absent words only"), (103, "w0"), (104, "w5 w5 W5 w299"), (104, "w5 w5 W5 w299"), (None, "w8 w9"), (105, "w0 " * 500)]
    return rows, items


def key(r):
    return repr(r)


@pytest.mark.parametrize("shard_bytes", [1, 3_000, 8 << 20])
def test_search_equals_the_plain_version(spark, shard_bytes):
    docs, items = corpus()
    frame = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, score int, term string").repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id long")
    got = search(build_index(frame, shard_bytes=shard_bytes), asked, query_bytes=2_000)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain_rank(docs, items), key=key)


def test_messy_and_empty_tables(spark):
    asked = spark.createDataFrame([(1, "alpha3 beta4 one"), (2, "naïve é 中文"), (3, None)], "item_id long, text string")
    rows = [(r[0], r[1]) for r in messy_rows()]
    got = search(build_index(messy(spark)), asked)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain_rank(rows, [(1, "alpha3 beta4 one"), (2, "naïve é 中文"), (3, None)]), key=key)
    assert search(build_index(empty(spark)), asked).collect() == []
    assert search(build_index(messy(spark)), asked.limit(0)).collect() == []


def test_blocks_are_left_unread():
    """Block bounds reject blocks of the common term's list; the result stays that of full scoring."""
    rng = random.Random(4)
    texts = [("common " + ("common " * 5 if i // 500 == 3 else "") + ("rare " if i % 997 == 0 else "") + "pad " * rng.randrange(5, 40)).encode() for i in range(20_000)]
    row = index_shard(list(range(len(texts))), texts)
    total = row["n_terms"]
    shard = Shard(row, row["n_docs"], total)
    query = {b"rare": 9000, b"common": 40}
    at, score = rank_shard(shard, query, np.zeros(0, np.int64), top=5)
    blocks = len(shard.blocks_of(shard.term[b"common"]))
    assert blocks > 100 and shard.decompressed < blocks / 4
    full = Shard(row, row["n_docs"], total)
    every = np.zeros(len(texts), np.int64)
    for t, w in query.items():
        for b in full.blocks_of(full.term[t]):
            doc, value = full.block(b)
            every[doc] += w * value
    want = sorted(range(len(texts)), key=lambda d: (-every[d], d))[:5]
    assert sorted(at[np.lexsort((at, -score))][:5].tolist()) == sorted(want)
    assert [every[d] for d in want] == sorted(score.tolist(), reverse=True)[:5]


def test_block_bounds_are_the_largest_parts():
    rng = random.Random(6)
    texts = [("a " * rng.randrange(1, 6) + "b " * rng.randrange(0, 300)).encode() for _ in range(1500)]
    row = index_shard(list(range(1500)), texts)
    shard = Shard(row, row["n_docs"], row["n_terms"])
    for b in range(len(shard.block_last)):
        doc, value = shard.block(b)
        assert shard.block_bound[b] == value.max() and shard.block_last[b] == doc[-1]
