"""Merkle fixity audit of two replicas of a WARC-style record store (operator 6).

Records are hashed (SHA-256) and laid out in id order, so each has a byte
offset. Each replica builds its own tree from its own records: a leaf is a
fixed range of ids (so also a range of offsets) and hashes the multiset of
its records, every level above hashes ``fanout`` neighbours in order. Roots
are compared first, then only children of nodes that differ; the records of
the two replicas meet inside differing leaves only. A lost, extra or shortened
record changes its own leaf and shifts no neighbour.

A leaf adds up the words of its records' hashes, which combines map-side, so
an id that holds a third of all records costs no large group. Which record of
a repeated id is which is settled by counts: equal digests of an id are
matched first (as many as both replicas hold), then what is left of the id on
both sides is paired in digest order.

Defined cases: a null url or body is empty text; a null id comes first and
ids that are no integers share its leaf; a paired record is ``corrupt`` if its
digest has no partner, a record without a pair is ``missing`` (primary) or
``extra`` (replica; ``row_no`` and ``record_offset`` are null); of equal records
of one id the first are the matched ones; very long bodies are hashed whole;
an empty primary gives the replica's records as ``extra``, two empty tables an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import number_rows, table

FANOUT = 32
REACH = 16


def warc_record(id_col: str, url_col: str, body_col: str):
    """One response record as text: headers, blank line, body, two line ends."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(url_col), F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def manifest(records: DataFrame, id_col: str, record_col: str) -> DataFrame:
    """record_id, digest and length of every record."""
    return records.select(F.col(id_col).alias("record_id"), F.sha2(record_col, 256).alias("digest"),
                          F.octet_length(record_col).cast("long").alias("length"))


def numbered(records: DataFrame) -> DataFrame:
    """A manifest with row_no and row_offset by (id, digest)."""
    return number_rows(records, [F.col("record_id").asc_nulls_first(), "digest"], "warc-records", lengths="length")


def id_ranges(primary: DataFrame, replica: DataFrame, fanout: int) -> tuple[int, int, int]:
    """Lowest id, ids per leaf and leaf count: about ``fanout`` records a leaf where ids are usual.

    Width and ends follow the middle half of the primary's ids: stray ids, more than
    ``REACH`` of its spans away, share the first or the last leaf. So the tree's height
    follows the records, whatever single ids are. It shapes the tree, not the result.
    """
    key = F.expr("try_cast(record_id AS bigint)")
    ours = primary.agg(F.min(key), F.max(key), F.count(key), F.percentile_approx(key, [0.25, 0.75], 1000)).first()
    theirs = replica.agg(F.min(key), F.max(key)).first()
    ends = [x for x in (*ours[:2], *theirs) if x is not None]
    if not ends:
        return 0, 1, 2
    low, high = ours[3] or ends[-2:]
    span = max(fanout, high - low)
    lowest, highest = max(min(ends), low - REACH * span), min(max(ends), high + REACH * span)
    width = max(1, 2 * fanout * (high - low) // max(1, ours[2]))
    return lowest, width, (highest - lowest) // width + 2


def leaf_number(lowest: int, width: int, leaves: int):
    """Number of the id range a record falls into; 0 for null and ids that are no integers."""
    place = F.expr(f"(try_cast(record_id AS decimal(20,0)) - {lowest}BD) div {width}BD").cast("long") + 1
    return F.when(place.isNull(), F.lit(0).cast("long")).otherwise(F.least(F.greatest(place, F.lit(1)), F.lit(leaves - 1)).cast("long"))


def leaf_hashes(records: DataFrame, first_byte, end_byte) -> DataFrame:
    """(node, hash, first_byte, end_byte) of every non-empty leaf; the hash does not depend on the order of its records."""
    bound = records.withColumn("_bound", F.sha2(F.concat_ws(":", F.coalesce(F.col("record_id").cast("string"), F.lit("null")), "digest"), 256))
    words = [F.sum(F.conv(F.substring("_bound", 1 + 8 * i, 8), 16, 10).cast("long")).alias(f"_w{i}") for i in range(8)]
    summed = bound.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), *words, F.min(first_byte).alias("first_byte"),
                                       F.max(end_byte).alias("end_byte"))
    return summed.select("node", F.sha2(F.concat_ws(":", "_n", *[f"_w{i}" for i in range(8)]), 256).alias("hash"), "first_byte", "end_byte")


def tree_levels(leaves: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    """(node, hash, first_byte, end_byte) of the leaves, then of each level above up to the root."""
    levels = [leaves]
    for level in range(1, height + 1):
        child = F.struct((F.col("node") % fanout).alias("place"), "hash")
        above = levels[-1].groupBy(F.floor(F.col("node") / fanout).alias("node")).agg(
            F.array_sort(F.collect_list(child)).alias("children"),          # at most ``fanout`` entries
            F.min("first_byte").alias("first_byte"), F.max("end_byte").alias("end_byte"))
        joined = F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["place"].cast("string"), c["hash"])), "|")
        levels.append(stage(above.select("node", F.sha2(joined, 256).alias("hash"), "first_byte", "end_byte"), "warc-level",
                            rows=fanout ** (height - level)))
    return levels


def differing_leaves(primary: list[DataFrame], replica: list[DataFrame], fanout: int) -> DataFrame:
    """Leaf nodes that differ or that one side lacks, found from the root down through differing nodes only."""
    suspects = None
    for level, ours, theirs in reversed(list(zip(range(len(primary)), primary, replica, strict=True))):
        a, b = ours.select("node", "hash"), theirs.select(F.col("node").alias("_node"), F.col("hash").alias("_hash"))
        if suspects is not None:
            parents = suspects.select(F.col("node").alias("_parent"))
            a = a.join(parents, F.floor(F.col("node") / fanout) == F.col("_parent"), "left_semi")
            b = b.join(parents, F.floor(F.col("_node") / fanout) == F.col("_parent"), "left_semi")
        suspects = stage(a.join(b, F.col("node") == F.col("_node"), "full")
                         .where(~F.col("hash").eqNullSafe(F.col("_hash")))
                         .select(F.coalesce("node", "_node").alias("node")), "warc-suspects",
                         rows=fanout ** (len(primary) - 1 - level))
    return suspects


def unmatched(side: DataFrame, counts: DataFrame, own: str, other: str) -> DataFrame:
    """The records of ``side`` (record_id, digest, row_no, ...) without an equal partner, with
    ``paired``: whether a record of the other side without partner is left for them.

    ``counts`` has (record_id, digest, n_<own>, n_<other>). Ranks among what is left of
    an id come from one global running sum, so no id's records are gathered.
    """
    surplus = lambda a, b: F.greatest(F.col(f"n_{a}") - F.col(f"n_{b}"), F.lit(0))
    left = counts.where(F.col(f"n_{own}") > F.col(f"n_{other}")).withColumn("_left", surplus(own, other))
    ranked = stage(number_rows(left, [F.col("record_id").asc_nulls_first(), "digest"], "warc-left", lengths="_left")
                   .select("record_id", "digest", F.col(f"n_{other}").alias("_matched"), F.col("row_offset").alias("_rank")), "warc-ranked")
    per_id = (ranked.groupBy(F.col("record_id").alias("_id")).agg(F.min("_rank").alias("_base"))
              .join(counts.groupBy(F.col("record_id").alias("_id2")).agg(F.sum(surplus(other, own)).alias("_partners")),
                    F.col("_id").eqNullSafe(F.col("_id2")), "left").drop("_id2"))
    lines = (ranked.join(per_id, F.col("record_id").eqNullSafe(F.col("_id"))).drop("_id")
             .withColumnsRenamed({"record_id": "_id", "digest": "_digest"}))
    first = side.groupBy(F.col("record_id").alias("_fid"), F.col("digest").alias("_fdigest")).agg(F.min("row_no").alias("_first"))
    lines = (lines.join(first, F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_digest") == F.col("_fdigest")))
             .drop("_fid", "_fdigest"))
    copy = F.col("row_no") - F.col("_first")
    return (side.join(lines, F.col("record_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
            .where(copy >= F.col("_matched"))
            .withColumn("paired", F.col("_rank") - F.col("_base") + copy - F.col("_matched") < F.col("_partners"))
            .drop("_id", "_digest", "_matched", "_rank", "_base", "_partners", "_first"))


def fixity_audit(primary: DataFrame, replica: DataFrame, id_col: str, record_col: str,
                 fanout: int = FANOUT) -> DataFrame:
    """One row per primary record and per extra record of the replica: record_id, row_no,
    record_offset, record_length, digest, status (ok, corrupt, missing, extra)."""
    plain, theirs = manifest(primary, id_col, record_col), stage(manifest(replica, id_col, record_col), "warc-replica")
    ours = stage(numbered(plain), "warc-manifest")
    lowest, width, leaves = id_ranges(ours, theirs, fanout)
    ours, theirs = (side.withColumn("node", leaf_number(lowest, width, leaves)) for side in (ours, theirs))
    height = 0
    while fanout ** height < leaves:
        height += 1
    none = F.lit(None).cast("long")
    bad = differing_leaves(
        tree_levels(stage(leaf_hashes(ours, F.col("row_offset"), F.col("row_offset") + F.col("length")), "warc-leaves", rows=leaves), fanout, height),
        tree_levels(stage(leaf_hashes(theirs, none, none), "warc-leaves", rows=leaves), fanout, height), fanout)
    # Records meet here, and only those of differing leaves.
    a = stage(ours.join(bad, "node", "left_semi").select("record_id", "digest", "row_no"), "warc-doubtful")
    b = stage(numbered(theirs.join(bad, "node", "left_semi").select("record_id", "digest", "length")), "warc-doubtful")
    sides = a.select("record_id", "digest", F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select("record_id", "digest", F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    counts = stage(sides.groupBy("record_id", "digest").agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b")), "warc-counts")
    damage = unmatched(a, counts, "a", "b").select(F.col("row_no").alias("_row"),
                                                   F.when(F.col("paired"), "corrupt").otherwise("missing").alias("_status"))
    audited = ours.join(damage, F.col("row_no") == F.col("_row"), "left").select(
        "record_id", "row_no", F.col("row_offset").alias("record_offset"), F.col("length").alias("record_length"), "digest",
        F.coalesce("_status", F.lit("ok")).alias("status"))
    extra = unmatched(b, counts, "b", "a").where(~F.col("paired")).select(
        "record_id", none.alias("row_no"), none.alias("record_offset"), F.col("length").alias("record_length"), "digest",
        F.lit("extra").alias("status"))
    return audited.unionByName(extra)


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A replica of the pages' records with damage chosen by the body's md5, each kind for 1 in 256: one
    byte changed, the end cut off, the record lost, a changed copy added, an equal copy added, a copy under another id added."""
    mark = F.substring(F.md5(F.coalesce(F.col("html"), F.lit(""))), 1, 2)
    record = F.col("record")
    kept = (pages.where(mark != "2c")
            .withColumn("record", F.when(mark == "0a", F.concat(F.lit("X"), F.expr("substring(record, 2)")))
                        .when(mark == "1b", F.expr("left(record, length(record) - 3)")).otherwise(record)))
    added = (pages.where(mark.isin("3d", "4e", "5f"))
             .withColumn("page_id", F.when(mark == "5f", -1 - F.col("page_id")).otherwise(F.col("page_id")))
             .withColumn("record", F.when(mark == "3d", F.concat(record, F.lit("!"))).otherwise(record)))
    return kept.unionByName(added)


def op6_merkle_fixity(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html", warc_record("page_id", "url", "html").alias("record"))
    return fixity_audit(pages, damaged_replica(pages), "page_id", "record").withColumnRenamed("record_id", "page_id")


OP6_SQL = """
WITH r AS (SELECT page_id, coalesce(html, '') AS body,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
    || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10)
    || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages),
d AS (SELECT page_id, record, sha256(record) AS digest, CAST(strlen(record) AS BIGINT) AS record_length, left(md5(body), 2) AS mark FROM r)
SELECT page_id, row_number() OVER w - 1 AS row_no,
       CAST(sum(record_length) OVER w AS BIGINT) - record_length AS record_offset, record_length, digest,
       CASE mark WHEN '0a' THEN 'corrupt' WHEN '1b' THEN 'corrupt' WHEN '2c' THEN 'missing' ELSE 'ok' END AS status
FROM d WINDOW w AS (ORDER BY page_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING)
UNION ALL
SELECT CASE mark WHEN '5f' THEN -1 - page_id ELSE page_id END, NULL, NULL, CASE mark WHEN '3d' THEN record_length + 1 ELSE record_length END,
       CASE mark WHEN '3d' THEN sha256(record || '!') ELSE digest END, 'extra'
FROM d WHERE mark IN ('3d', '4e', '5f')"""
