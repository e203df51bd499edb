"""Document fingerprints from closed syncmers, with DataFrame functions only (operator 10).

A text is read as its sequence of words. A run of ``k`` words is an anchor
(closed syncmer) if the smallest hash among its inner runs of ``s`` words
belongs to the first or the last of them. Whether a run is an anchor depends
on its own words alone, so an edit changes anchors only where it happens, and
what two texts share has the same anchors in the same order in both. The
fingerprint is the anchors' hashes in text order (8 hex digits each), so two
fingerprints can be matched place by place; a text without anchors (fewer
than ``k`` words, or none picked) has one anchor, the hash of all its words.
The likeness of two texts is the Jaccard similarity of their distinct anchors.

The next document's text is found without a global sort in one task: ids are
cut into many buckets at approximate quantiles, each bucket also gets the
first row of the next one, and a window per bucket looks one row ahead. Texts
are shuffled once.

Defined cases: a null text is empty; a text without words has an empty
fingerprint, likeness 1 to another such text and 0 to any other; null ids
come first, repeated ids follow each other in the order of their texts'
hashes; the only document of a table is its own next; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

K_WORDS = 5
S_WORDS = 1
MAX_BUCKETS = 65_536


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a one-element transform binds it)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column, k: int = K_WORDS, s: int = S_WORDS) -> Column:
    """array<bigint>: hashes of the closed syncmers of a text, in order."""
    spaced = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    inner = k - s + 1

    def starts(m: Column, n: Column) -> Column:
        """Where a run of k words begins whose least inner hash is its first or last."""
        return F.filter(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
                        lambda i: F.least(F.get(m, i), F.get(m, i + inner - 1)) <= F.least(*[F.get(m, i + j) for j in range(1, inner - 1)], F.get(m, i)))

    def of(h: Column) -> Column:
        n = F.size(h)
        whole = F.array(F.xxhash64(h))
        if s == 1:
            at = starts(h, n)
        else:
            at = let(F.transform(F.sequence(F.lit(0), F.greatest(n - s, F.lit(0))),
                                 lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)])), lambda m: starts(m, n))
        picked = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return (F.when(n == 0, F.slice(whole, 1, 0)).when(n < k, whole)
                .otherwise(let(picked, lambda p: F.when(F.size(p) == 0, whole).otherwise(p))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def fingerprint(found: Column) -> Column:
    """The anchors' hashes in order, 8 hex digits each."""
    return F.array_join(F.transform(found, lambda a: F.right(F.hex(a), F.lit(8))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two anchor arrays' distinct hashes; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def _bucket(value: Column, cuts: list[int]) -> Column:
    """How many cuts lie below the value (binary search in a constant array); 0 for null."""
    held = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(max(1, len(cuts).bit_length())))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def halve(at: Column, _) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        right = (at["lo"] < at["hi"]) & (F.get(held, mid) < value)
        return F.struct(F.when(right, mid + 1).otherwise(at["lo"]).alias("lo"),
                        F.when(right, at["hi"]).otherwise(F.least(mid, at["hi"])).alias("hi"))

    return F.when(value.isNull(), F.lit(0)).otherwise(F.aggregate(steps, start, halve, lambda at: at["lo"]))


def with_next(docs: DataFrame, id_col: str, text_col: str, extra: dict[str, Column], rows_per_bucket: int = 500) -> DataFrame:
    """(doc_id, text, *extra) with the next row's ``next_text`` and ``next_<extra>``; last wraps to first.

    ``extra`` are columns over ``text``, computed once per row after the shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_tie"))
    total = docs.count()
    buckets = max(1, min(MAX_BUCKETS, total // rows_per_bucket))
    cuts = []
    if buckets > 1:
        at = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", at, 10 * buckets)).first()[0] or []))
    dealt = rows.withColumn("_bucket", _bucket(F.col("doc_id"), cuts))
    # The first row of each bucket, also sent to the bucket before it (at most MAX_BUCKETS lines).
    first = dealt.groupBy("_bucket").agg(F.min(F.struct("doc_id", "_tie")).alias("_first")).collect()
    first.sort(key=lambda r: r["_bucket"])
    lines = [(r["_bucket"], r["_first"]["doc_id"], r["_first"]["_tie"], first[i - 1]["_bucket"]) for i, r in enumerate(first)]
    edges = docs.sparkSession.createDataFrame(lines, "_bucket int, _id long, _t long, _before int")
    is_first = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t"))
    own, ahead = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("a")), F.struct(F.col("_before").alias("b"), F.lit(1).alias("a"))
    sent = (dealt.join(F.broadcast(edges), "_bucket")
            .withColumn("_to", F.explode(F.when(is_first, F.array(own, ahead)).otherwise(F.array(own))))
            .select("doc_id", "text", "_tie", F.col("_to.b").alias("_b"), F.col("_to.a").alias("_a")))
    wide = sent.repartition("_b").withColumns(extra)
    order = Window.partitionBy("_b").orderBy("_a", F.col("doc_id").asc_nulls_first(), "_tie")
    return (wide.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("text", *extra)})
            .where("_a = 0").drop("_a", "_b", "_tie"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form (its second half replaced by the
    start of the next document), with their likeness and that to the next document."""
    pairs = with_next(docs, id_col, text_col, {"found": anchors(F.col("text"))})
    edited = F.concat(F.expr("left(text, cast(n_chars - floor(n_chars / 2) as int))"), F.expr("left(next_text, cast(floor(n_chars / 2) as int))"))
    made = (pairs.withColumn("n_chars", F.char_length("text").cast("long"))
            .select("doc_id", "n_chars", "found", "next_found", edited.alias("edited"))
            .withColumn("edited_found", anchors(F.col("edited"))))
    return made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("found")).alias("fingerprint"), fingerprint(F.col("edited_found")).alias("edited_fingerprint"),
                       likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
                       likeness(F.col("found"), F.col("next_found")).alias("near_next"))


def op10_closed_syncmers(spark, sf_dir):
    return edited_fingerprints(table(spark, sf_dir, "documents"))
