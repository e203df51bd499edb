import hashlib
import random

import pytest

import public_tokenizers
from scorewatch.llm.pieces import PieceCodec, encode_digests, encode_texts
from scorewatch.llm.queries import QUERIES

from .helpers import SF, empty, messy, messy_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(PATH)


def digest(codec, text):
    ids = codec.model.encode(text or "") + [2]
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(codec.model.decode(ids).encode()).hexdigest())


def test_chunks_equal_the_whole_text(codec):
    rng = random.Random(3)
    parts = [" ", "  ", "   ", "▁", "a", "th", "ing", "\n", "\t", "\r\n", "é", "　", "\xa0", "1", "中文", "\U0001f600", "\x00",
             "<s>", "</s>", "<unk>", "<0x41>", "#"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 16))) for _ in range(20_000)]
    assert codec.cuttable and codec.encode(texts) == codec.model.encode(texts)


def test_a_full_table_changes_nothing():
    small = PieceCodec(PATH, entries=3)
    texts = [["one two three", "four five"], ["one six", "", "seven eight nine"]]
    assert [small.encode(t) for t in texts] == [small.model.encode(t) for t in texts]


def test_messy_rows(spark, codec):
    rows = encode_digests(messy(spark), PATH, slice_chars=1000).collect()
    want = sorted((str(r[0]),) + digest(codec, r[1]) for r in messy_rows())
    assert sorted((str(r[0]),) + tuple(r[1:]) for r in rows) == want


def test_texts_and_ids(spark, codec):
    for r in encode_texts(messy(spark), PATH).join(messy(spark).select("doc_id", "text").where("doc_id < 7"), "doc_id").collect():
        assert r.ids == codec.model.encode(r.text) + [2] and r.decoded == r.text


def test_empty_table(spark):
    assert encode_digests(empty(spark), PATH).collect() == []


def test_query(spark, codec):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_piece_codec"](spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == {d: digest(codec, t) for d, t in docs.items()}
