import zlib

import numpy as np
import pytest

from scorewatch.llm.queries import QUERIES
from scorewatch.llm.sharding import feistel, feistel_shards, half_bits, permute, round_keys

from .helpers import SF, empty, messy, messy_rows


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 100, 1000, 4097, 70_000])
def test_permutation_is_onto(n):
    assert sorted(permute(np.arange(n), n, 7).tolist()) == list(range(n))


def test_plain_walk_gives_the_same_places():
    n, keys = 1000, round_keys(7)
    h = half_bits(n)

    def one(x):
        while True:
            left, right = x >> h, x & ((1 << h) - 1)
            for m, a in keys:
                t = right * m + a
                t = ((t ^ (t >> 15)) & 0x7FFFFFFF) * m
                left, right = right, left ^ ((t >> 11) & ((1 << h) - 1))
            x = (left << h) | right
            if x < n:
                return x

    assert permute(np.arange(n), n, 7).tolist() == [one(i) for i in range(n)]
    assert feistel(np.array([(1 << 62) - 1]), 31, keys)[0] >= 0          # no product overflows


def test_rows_law_on_messy_rows(spark):
    rows = feistel_shards(messy(spark), shards=5).collect()
    given = messy_rows()
    assert len(rows) == len(given)
    expected = sorted((r[0] is not None, r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in given
                      if r[0] is not None)
    assert sorted((True, r.doc_id, r["size"], r.text_crc32) for r in rows if r.doc_id is not None) == expected
    shards = [sorted(r.slot for r in rows if r.shard == s) for s in range(5)]
    assert all(s == list(range(len(s))) for s in shards) and max(map(len, shards)) - min(map(len, shards)) <= 1
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.row_no)][:2] == [None, None]


def test_empty_table(spark):
    assert feistel_shards(empty(spark), shards=24).collect() == []


def test_query_is_the_same_each_time(spark):
    once, again = (sorted(map(tuple, QUERIES["op7_feistel_sharding"](spark, SF).collect())) for _ in range(2))
    assert once == again and {r[3] for r in once} == {"rows"} and {r[6] for r in once} == {None}
