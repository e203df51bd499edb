import bisect
import hashlib
import struct

import xxhash

from scorewatch.llm.queries import QUERIES
from scorewatch.llm.syncmers import K_WORDS, S_WORDS, edited_fingerprints

from .helpers import SF, WORD, empty, messy, messy_rows


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed)
    return signed(seed)


def plain_anchors(text, k=K_WORDS, s=S_WORDS):
    """Closed syncmers, stated plainly over the words' hashes."""
    h = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in WORD.findall(text)]
    if not h:
        return []
    found = []
    for i in range(len(h) - k + 1):
        inner = [chained(h[j:j + s]) if s > 1 else h[j] for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append(chained(h[i:i + k]))
    return found or [chained(h)]


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """{(doc_id, n_chars, ...)} with the next row by (id, hash of the text); nulls first."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), seed=42))))
    out = []
    for i, (doc, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = plain_anchors(text), plain_anchors(edited), plain_anchors(after)
        print_of = lambda x: "".join(f"{v & 0xFFFFFFFF:08X}" for v in x)
        out.append((str(doc), len(text), hashlib.sha256(edited.encode()).hexdigest(), print_of(a), print_of(b),
                    round(jaccard(a, b), 12), round(jaccard(a, c), 12)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12))
                  for r in df.collect())


def test_messy_rows(spark):
    assert got(edited_fingerprints(messy(spark))) == expected([(r[0], r[1] or "") for r in messy_rows()])


def test_one_row_and_empty_table(spark):
    one = spark.createDataFrame([(4, "a b c d e f g h")], "doc_id long, text string")
    assert got(edited_fingerprints(one)) == expected([(4, "a b c d e f g h")])
    assert edited_fingerprints(empty(spark)).collect() == []


def test_query_over_many_buckets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = expected([tuple(r) for r in docs.collect()])
    assert got(QUERIES["op10_closed_syncmers"](spark, SF)) == want
    from scorewatch.llm import syncmers
    cuts = list(range(0, 190, 9))
    at = docs.select("doc_id", syncmers._bucket(docs.doc_id, cuts).alias("b")).collect()
    assert all(r.b == bisect.bisect_left(cuts, r.doc_id) for r in at)
    many = syncmers.with_next(docs, "doc_id", "text", {}, rows_per_bucket=7).collect()
    texts = {r.doc_id: r.text for r in many}
    ids = sorted(texts)
    assert all(r.next_text == texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]] for r in many) and len(many) == len(ids)


def test_plan_has_no_python(spark):
    plan = QUERIES["op10_closed_syncmers"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
