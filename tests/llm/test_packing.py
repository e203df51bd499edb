import random
import struct
import zlib

import numpy as np
import pytest

import public_tokenizers
from scorewatch.llm.packing import ByteBpe, best_fit_decreasing, pack_documents
from scorewatch.llm.queries import QUERIES

from .helpers import SF, empty, messy, messy_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH, public_tokenizers.PATTERN)


def library_ids(bpe, text):
    return bpe.library.encode(text or "", add_special_tokens=False).ids


def plain_best_fit(lengths, window):
    """Remaining room per window, longest first, tightest fit by a plain scan."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(window - n)
    return sorted(room)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_against_a_plain_scan(seed):
    rng = random.Random(seed)
    window = rng.choice([7, 64, 100, 2048])
    lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 300))]
    sequence, offset = best_fit_decreasing(lengths, window)
    room = {}
    for s, o, n in sorted(zip(sequence, offset, lengths)):
        assert o == room.get(s, 0)
        room[s] = o + n
    assert sorted(window - r for r in room.values()) == plain_best_fit(lengths, window)


def test_ids_equal_the_library(bpe):
    assert bpe.ranked is not None
    rng = random.Random(1)
    parts = [" ", "  ", "a", "er", "\n", "\t", "é", "　", "\xa0", "\x85", "\x1c", "1", "'s", "!", "中", "\U0001f600", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}  {chr(c)}" for c in range(0, 0xD800, 7)]
    want = [e.ids for e in bpe.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(bpe.encode(t), "<u4").tolist() for t in texts] == want


def check(rows, texts, bpe, window=2048):
    """Every id in exactly one piece, offsets gapless, nothing over the window. ``texts``: (id, text) of every row."""
    want = sorted((str(d), len(ids), s, zlib.crc32(struct.pack(f"<{len(ids[s:s + window])}I", *ids[s:s + window])))
                  for d, t in texts for ids in [library_ids(bpe, t) + [1]] for s in range(0, len(ids), window))
    assert sorted((str(r.doc_id), r.doc_tokens, r.start, r.ids_crc32) for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert not ends or max(ends.values()) <= window
    return ends


def test_messy_rows(spark, bpe):
    rows = pack_documents(messy(spark), PATH, public_tokenizers.PATTERN, group_rows=10).collect()
    check(rows, [(r[0], r[1]) for r in messy_rows()], bpe)


def test_empty_table(spark):
    assert pack_documents(empty(spark), PATH, public_tokenizers.PATTERN).collect() == []


def test_query_packs_tightly(spark, bpe):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ends = check(QUERIES["op8_best_fit_packing"](spark, SF).collect(), [tuple(d) for d in docs], bpe)
    assert len(ends) <= 1.02 * -(-sum(ends.values()) // 2048) + 1
