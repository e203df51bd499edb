import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from scorewatch.llm.queries import ORACLE_SQL, QUERIES
from scorewatch.llm.warc import fixity_audit, manifest, numbered, tree_levels, warc_record

from .helpers import SF

SCHEMA = "page_id long, url string, html string, row_no long, digest string, node long, copy long"


def records(spark, rows):
    df = spark.createDataFrame([(*r, 1, "d", 2, 3) for r in rows], SCHEMA)
    return df.withColumn("record", warc_record("page_id", "url", "html"))


def record(page_id, url, html):
    body = html or ""
    return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\nWARC-Target-URI: {url or ''}\r\n"
            f"Content-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n").encode()


ROWS = [(i, f"http://h/{i}", "é" * (i % 5) + str(i)) for i in range(70)] + [
    (None, None, None), (None, "u", ""), (200, None, "x" * 100_000), (201, "u", None), (5, "http://h/5", "é" * 0 + "5"), (6, "other", "another body")]


def plain_audit(ours, theirs):
    """Status by (record_id, digest) as a multiset: equal digests of an id match, the rest is paired in digest order."""
    out = collections.Counter()
    for i in {r[0] for r in (*ours, *theirs)}:
        a, b = (collections.Counter(hashlib.sha256(record(*r)).hexdigest() for r in rows if r[0] == i) for rows in (ours, theirs))
        left, right = sorted((a - b).elements()), sorted((b - a).elements())
        out.update((i, d, "ok") for d in (a & b).elements())
        out.update((i, d, "corrupt" if k < len(right) else "missing") for k, d in enumerate(left))
        out.update((i, d, "extra") for d in right[len(left):])
    return out


@pytest.mark.parametrize("fanout", [4, 32])
def test_audit_equals_a_plain_one(spark, fanout):
    damaged = [(i, u, h + "!" if i == 13 else h) for i, u, h in ROWS if i not in (40, 66)]
    damaged.remove((None, "u", ""))
    damaged += [(999, "extra", "only here"), (7, "http://h/7", ROWS[7][2]), (-(1 << 62), "far", "away"), (None, "n", "more"), (None, "n", "most")]
    found = fixity_audit(records(spark, ROWS), records(spark, damaged[::-1]), "page_id", "record", fanout=fanout).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(record(*r)).hexdigest()))
    offset = 0
    for r, given in zip(sorted((r for r in found if r.status != "extra"), key=lambda r: r.row_no), order, strict=True):
        raw = record(*given)
        assert (r.record_id, r.record_offset, r.record_length, r.digest) == (given[0], offset, len(raw), hashlib.sha256(raw).hexdigest())
        offset += len(raw)
    assert collections.Counter((r.record_id, r.digest, r.status) for r in found) == plain_audit(ROWS, damaged)
    assert all(r.row_no is None and r.record_offset is None for r in found if r.status == "extra")


@pytest.mark.parametrize("which", [0, 2])
def test_one_damaged_copy_flags_one_row(spark, which):
    rows = [(i, "u", f"{i}-{c}") for i in (4, 5, 6) for c in range(3)] + [(5, "u", "5-0")] * 2
    damaged = list(rows)
    damaged[3 + which] = (5, "u", "damaged")
    found = fixity_audit(records(spark, rows), records(spark, damaged), "page_id", "record", fanout=4).collect()
    flagged = [(r.record_id, r.digest, r.status) for r in found if r.status != "ok"]
    assert flagged == [(5, hashlib.sha256(record(*rows[3 + which])).hexdigest(), "corrupt")]


def test_a_hot_id_of_many_records(spark):
    """One id holds nearly all records; a few are damaged, lost, added or swapped with another id's."""
    rows = [(1, "u", str(k % 900)) for k in range(1500)] + [(k, "u", "x") for k in range(2, 40)]
    damaged = [(1, "u", f"bad{k}" if k in (3, 700) else str(k % 900)) for k in range(1500) if k not in (11, 911)] + [
        (k, "u", "x") for k in range(2, 40)] + [(1, "u", "new")]
    found = fixity_audit(records(spark, rows), records(spark, damaged), "page_id", "record").collect()
    assert collections.Counter((r.record_id, r.digest, r.status) for r in found) == plain_audit(rows, damaged)


def test_records_swapped_between_ids_of_one_leaf(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, body string")
    swapped = spark.createDataFrame([(2, "a"), (1, "b"), (3, "c")], "k long, body string")
    assert {r.record_id: r.status for r in fixity_audit(df, swapped, "k", "body").collect()} == {1: "corrupt", 2: "corrupt", 3: "ok"}


def test_ids_that_are_no_integers(spark):
    df = spark.createDataFrame([("x", "a"), ("y", "b"), (None, "c")], "k string, body string")
    other = spark.createDataFrame([("x", "a"), (None, "c"), ("z", "b")], "k string, body string")
    assert {(r.record_id, r.status) for r in fixity_audit(df, other, "k", "body").collect()} == {
        ("x", "ok"), (None, "ok"), ("y", "missing"), ("z", "extra")}


def test_equal_replicas_and_empty_table(spark):
    same = fixity_audit(records(spark, ROWS), records(spark, ROWS[::-1]), "page_id", "record", fanout=8)
    assert {r.status for r in same.collect()} == {"ok"} and same.count() == len(ROWS)
    assert fixity_audit(records(spark, []), records(spark, ROWS), "page_id", "record").count() == len(ROWS)
    assert fixity_audit(records(spark, []), records(spark, []), "page_id", "record").collect() == []
    assert {r.status for r in fixity_audit(records(spark, ROWS), records(spark, []), "page_id", "record").collect()} == {"missing"}


def test_tree_equals_a_plain_one(spark):
    leaves = numbered(manifest(records(spark, ROWS), "page_id", "record")).select(
        F.col("row_no").alias("node"), F.col("digest").alias("hash"), F.col("row_offset").alias("first_byte"),
        (F.col("row_offset") + F.col("length")).alias("end_byte"))
    now = [(r["hash"], r.first_byte, r.end_byte) for r in sorted(leaves.collect(), key=lambda r: r.node)]
    for level in tree_levels(leaves, 4, 4)[1:]:
        groups = [now[i:i + 4] for i in range(0, len(now), 4)]
        now = [(hashlib.sha256("|".join(f"{k}:{h}" for k, (h, _, _) in enumerate(g)).encode()).hexdigest(), g[0][1], g[-1][2]) for g in groups]
        assert [(r["hash"], r.first_byte, r.end_byte) for r in sorted(level.collect(), key=lambda r: r.node)] == now
    assert len(now) == 1 and now[0][1:] == (0, sum(len(record(*r)) for r in ROWS))


def test_query_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    rows = con.execute(ORACLE_SQL["op6_merkle_fixity"]).fetchall()
    got = QUERIES["op6_merkle_fixity"](spark, SF).select("page_id", "row_no", "record_offset", "record_length", "digest", "status").collect()
    assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)
    assert {r.status for r in got} >= {"ok", "extra"}


def test_small_levels_take_one_file_each(spark):
    leaves = numbered(manifest(records(spark, ROWS), "page_id", "record")).select(
        F.col("row_no").alias("node"), F.col("digest").alias("hash"), F.col("row_offset").alias("first_byte"),
        (F.col("row_offset") + F.col("length")).alias("end_byte")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert [len(level.inputFiles()) for level in tree_levels(leaves, 4, 4)[1:]] == [1, 1, 1, 1]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
