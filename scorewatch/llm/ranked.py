"""Ranked lexical search with Block-Max MaxScore over a sharded index (operator 13).

Terms are the maximal runs of digits, letters and characters beyond ASCII,
only A-Z lower-cased. ``build_index`` cuts the documents into shards of about
``SHARD_BYTES`` of text as they lie in the input partitions (no shuffle) and
writes one row per shard: vocabulary, document lengths and, per term, the
postings in blocks of 128. A block stores the gaps of its document numbers and
its counts in the fewest whole bytes, and beside it, uncompressed, its last
document and its competitive pairs: those (count, length) that no other
posting of the block beats in both. A score's part grows with the count and
falls with the length, so a block's largest part is the largest over these
pairs, exactly, for any corpus statistics; the index can therefore be built
before the corpus statistics are known, in one pass over the texts.

``search`` adds up the corpus statistics and, for the terms of the queries, the
document frequencies in Spark, and then ranks shard by shard inside the tasks.
Per query the lists are taken in descending order of their bound (weight times
the largest block bound of the list). Lists are essential until the bounds of
all remaining ones together cannot reach the score of the twentieth best
document found so far; essential lists are read whole. A document found there
is dropped if what it has, plus the block bounds of the remaining lists at its
place, stays below that score; only blocks in which a document is left are
decompressed. The heaps of the shards that a task reads are merged on the go, so
later shards begin with the threshold of earlier ones; the tasks' heaps are
merged by Spark. Documents are left out only if their bound is strictly
smaller, so ties are whole.

Queries are streamed to the driver in blocks of at most ``QUERY_BYTES`` of
text (and one text more), each block is broadcast and searched over all
shards.

Defined cases: a null text has no terms; a document without terms is in no
list; a query without known terms has no rows; a very long text is a shard of
its own. Rows with equal ids are separate documents, as are queries; among
equal scores a null id comes last and equal ids take any order (their rows are
equal). A score is only returned above 0, so terms of weight 0 find nothing.
An empty table gives an empty result. Other columns are left out, whatever
their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import arrow_schema, bounded_batches, release_memory, table, text_bytes

BLOCK = 128
SHARD_BYTES = 8 << 20
QUERY_BYTES = 4 << 20
TOP = 20

#: Byte -> lower-cased byte where it belongs to a term, else a blank (digits, letters, bytes of characters beyond ASCII).
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order, with repeats."""
    return raw.translate(_TERM).split()


class _Numbers(dict):
    """Numbers terms as they are met."""

    def __missing__(self, term):
        self[term] = number = len(self)
        return number


INDEX = ("n_docs long, n_terms long, doc_ids binary, null_ids binary, lengths binary, vocabulary binary, df binary, list_start binary, "
         "block_last binary, block_at binary, block_width binary, pair_start binary, pair_tf binary, pair_length binary, postings binary")


def _widths(largest: np.ndarray) -> np.ndarray:
    """Whole bytes (1, 2 or 4) that hold the values up to ``largest``."""
    return np.where(largest < 256, 1, np.where(largest < 65536, 2, 4))


def _competitive(block: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of each block's (tf, length) pairs that no other pair of the block beats in both; in block order."""
    order = np.lexsort((length, -tf, block))
    b, n = block[order], length[order].astype(np.int64)
    step = np.int64(n.max(initial=0) + 1)
    reset = n - b * step                                   # a later block lies below every earlier one, so the running minimum starts anew
    least = np.minimum.accumulate(reset)
    first = np.ones(len(b), bool)
    first[1:] = (reset[1:] < least[:-1]) | (b[1:] != b[:-1])
    return order[first]


def index_shard(doc_ids: list, texts: list[bytes]) -> dict:
    """One index row for the documents given."""
    numbers = _Numbers()
    each = [np.fromiter(map(numbers.__getitem__, terms_of(t)), np.int64) for t in texts]
    lengths = np.array([len(e) for e in each], np.int64)
    names = sorted(numbers)
    rank = np.empty(len(names), np.int64)
    rank[[numbers[t] for t in names]] = np.arange(len(names))
    pairs = (rank[np.concatenate(each)] << 32) | np.repeat(np.arange(len(each)), lengths) if len(names) else np.zeros(0, np.int64)
    pairs, tf = np.unique(pairs, return_counts=True)
    term, doc = pairs >> 32, pairs & 0xFFFFFFFF
    df = np.bincount(term, minlength=len(names))
    first = np.concatenate(([0], np.cumsum(df)))[:-1]                                # first posting of each list
    place = np.arange(len(term)) - first[term]
    blocks_of = -(-df // BLOCK)
    list_start = np.concatenate(([0], np.cumsum(blocks_of)))
    block = list_start[term] + place // BLOCK
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    sizes = np.diff(np.append(starts, len(block)))
    gap = np.diff(doc, prepend=0)
    gap[starts] = doc[starts]                                                          # a block begins with its first document
    blank = np.zeros(0, np.int64)
    wide = _widths(np.maximum.reduceat(gap, starts)) if len(starts) else blank
    counted = _widths(np.maximum.reduceat(tf, starts)) if len(starts) else blank
    at = np.concatenate(([0], np.cumsum(sizes * (wide + counted))))
    postings = np.zeros(at[-1], np.uint8)
    inside = np.arange(len(block)) - starts[block] if len(block) else blank
    for values, widths, base in ((gap, wide, at[:-1]), (tf, counted, at[:-1] + sizes * wide)):
        for w in (1, 2, 4):
            rows = np.flatnonzero(widths[block] == w) if len(block) else blank
            if rows.size:
                to = (base[block[rows]] + w * inside[rows])[:, None] + np.arange(w)
                postings[to] = values[rows].astype(f"<u{w}").view(np.uint8).reshape(-1, w)
    held = _competitive(block, tf, lengths[doc]) if len(block) else blank
    return {"n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
            "doc_ids": np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes(),
            "null_ids": np.array([i is None for i in doc_ids], bool).tobytes(), "lengths": lengths.astype("<i8").tobytes(),
            "vocabulary": b" ".join(names), "df": df.astype("<i4").tobytes(), "list_start": list_start.astype("<i4").tobytes(),
            "block_last": doc[starts + sizes - 1].astype("<i4").tobytes() if len(starts) else b"",
            "block_at": np.column_stack((at[:-1], sizes)).astype("<i4").tobytes(),
            "block_width": np.column_stack((wide, counted)).astype(np.uint8).tobytes(),
            "pair_start": np.searchsorted(block[held], np.arange(len(starts) + 1)).astype("<i4").tobytes() if len(block) else b"\0\0\0\0",
            "pair_tf": tf[held].astype("<i4").tobytes(), "pair_length": lengths[doc[held]].astype("<i8").tobytes() if len(block) else b"",
            "postings": postings.tobytes()}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Index rows (``INDEX``), one per shard; built from each text once, without a shuffle. Staged."""
    bounded_batches(docs.sparkSession)
    schema = arrow_schema(INDEX)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def row():
            return pa.RecordBatch.from_pylist([index_shard(ids, texts)], schema)

        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                if texts and size + len(raw) > shard_bytes:
                    yield row()
                    ids, texts, size = [], [], 0
                    release_memory()
                ids.append(i)
                texts.append(raw)
                size += len(raw) + 16
        if texts:
            yield row()
        release_memory()

    return stage(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(shards, INDEX), "search-index")


class Shard:
    """An index row opened for search; ``mean`` is (N, L) of the whole corpus."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        whole = lambda name, kind: np.frombuffer(row[name], kind)
        self.doc_ids, self.null_ids, lengths = whole("doc_ids", "<i8"), whole("null_ids", bool), whole("lengths", "<i8")
        self.m = 75 + (25 * lengths * n_docs) // n_terms
        self.term = {t: i for i, t in enumerate(row["vocabulary"].split(b" "))} if row["vocabulary"] else {}
        self.list_start, self.block_last = whole("list_start", "<i4"), whole("block_last", "<i4")
        self.block_at, self.block_width = whole("block_at", "<i4").reshape(-1, 2), whole("block_width", np.uint8).reshape(-1, 2)
        self.postings = row["postings"]
        pair_m = 75 + (25 * whole("pair_length", "<i8") * n_docs) // n_terms
        pair_start = whole("pair_start", "<i4")
        self.block_bound = np.maximum.reduceat(part(whole("pair_tf", "<i4"), pair_m), pair_start[:-1]) if len(pair_start) > 1 else np.zeros(0, np.int64)
        self._read: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.decompressed = 0                              # blocks

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and parts of a block (kept while the shard is searched; a shard's postings are bounded)."""
        if b not in self._read:
            (at, size), (wide, counted) = self.block_at[b].tolist(), self.block_width[b].tolist()
            doc = np.cumsum(np.frombuffer(self.postings, f"<u{wide}", size, at), dtype=np.int64)
            tf = np.frombuffer(self.postings, f"<u{counted}", size, at + size * wide)
            self._read[b] = doc, part(tf, self.m[doc])
            self.decompressed += 1
        return self._read[b]

    def blocks_of(self, term: int) -> range:
        return range(self.list_start[term], self.list_start[term + 1])


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count adds to a score, before the term's weight."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def rank_shard(shard: Shard, query: dict[bytes, int], found: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the shard (places, scores) that may be among the ``top`` of it and of ``found`` (scores so far).

    ``query``: term -> its weight times its repeats. Scores returned are whole.
    """
    lists = [(shard.term[t], w) for t, w in query.items() if w > 0 and t in shard.term]
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spans = [(shard.list_start[t], shard.list_start[t + 1]) for t, _ in lists]
    bound = np.array([w * shard.block_bound[a:z].max() for (_, w), (a, z) in zip(lists, spans, strict=True)])
    order = np.argsort(-bound, kind="stable")
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)                            # bound of this list and all after it
    score = np.zeros(len(shard.m), np.int64)

    def threshold() -> int:
        """A score that ``top`` documents reach already; what lies strictly below cannot enter."""
        best = np.concatenate((found, score[score > 0]))
        return max(1, int(np.partition(best, len(best) - top)[len(best) - top])) if len(best) >= top else 1

    limit, i = threshold(), 0
    while i < len(order) and rest[i] >= limit:                                          # essential lists
        term, weight = lists[order[i]]
        for b in shard.blocks_of(term):
            doc, value = shard.block(b)
            score[doc] += weight * value
        limit, i = threshold(), i + 1
    left = np.flatnonzero((score > 0) & (score + rest[i] >= limit))
    others = []                                                                         # per remaining list: block and its bound at each document left
    for k in order[i:]:
        (a, z), weight = spans[k], lists[k][1]
        at = a + np.searchsorted(shard.block_last[a:z], left)
        inside = at < z
        others.append((np.where(inside, at, -1), np.where(inside, weight * shard.block_bound[np.minimum(at, z - 1)], 0)))
    ahead = np.sum([o[1] for o in others], axis=0) if others else np.zeros(len(left), np.int64)
    for (at, most), k in zip(others, order[i:], strict=True):
        may = score[left] + ahead >= limit                                              # judged by block bounds, before a block is read
        for b in np.unique(at[may & (at >= 0)]):
            doc, value = shard.block(b)
            wanted = left[may & (at == b)]
            place = np.minimum(np.searchsorted(doc, wanted), len(doc) - 1)
            hit = doc[place] == wanted
            score[wanted[hit]] += lists[k][1] * value[place[hit]]
        ahead = ahead - most
        limit = threshold()
        score[left[~may]] = 0                                                           # given up: no whole score
    left = left[score[left] >= limit]
    return left, score[left]


def _best(rows: list[tuple], top: int) -> list[tuple]:
    """The ``top`` of (score, id is null, id) rows, highest score first, then ascending ids."""
    return sorted(rows, key=lambda r: (-r[0], r[1], r[2]))[:top]


def query_blocks(items: DataFrame, id_col: str, text_col: str, most: int = QUERY_BYTES) -> Iterator[list[tuple]]:
    """(item id, terms with repeats) in blocks of bounded text size, streamed to the driver."""
    block, size = [], 0
    for r in items.select(F.col(id_col).alias("i"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("t")).toLocalIterator():
        raw = bytes(r.t)
        block.append((r.i, terms_of(raw)))
        size += len(raw) + 64
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def document_frequencies(index: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """Documents that hold each of the ``wanted`` terms (those of one query block)."""
    held = index.sparkSession.sparkContext.broadcast(wanted)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                df = np.frombuffer(df, "<i4").tolist()
                rows = [(t, n) for t, n in zip(names.split(b" "), df, strict=False) if t in held.value]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], ["term", "df"])

    rows = (index.select("vocabulary", "df").mapInArrow(frequencies, "term binary, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).collect())                    # at most the block's terms
    held.destroy()
    return {bytes(r.term): r.df for r in rows}


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", top: int = TOP,
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item id, rank, doc_id and score of the ``top`` documents of every item."""
    spark = index.sparkSession
    bounded_batches(spark)
    kind = items.schema[item_col].dataType.simpleString()
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    out = None
    for block in query_blocks(items, item_col, text_col, query_bytes) if n_terms else ():
        df = document_frequencies(index, {t for _, terms in block for t in terms})
        queries = []
        for _, terms in block:
            query: dict[bytes, int] = {}
            for t in terms:
                if t in df:
                    query[t] = query.get(t, 0) + weight(df[t], n_docs)
            queries.append(query)
        held = spark.sparkContext.broadcast(queries)

        def best(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            heaps: list[list[tuple]] = [[] for _ in held.value]
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = Shard(batch.slice(i, 1).to_pylist()[0], n_docs, n_terms)
                    for q, query in enumerate(held.value):
                        at, score = rank_shard(shard, query, np.array([r[0] for r in heaps[q]], np.int64), top)
                        if len(at):
                            heaps[q] = _best([*heaps[q], *zip(score.tolist(), shard.null_ids[at].tolist(), shard.doc_ids[at].tolist(), strict=True)], top)
                    del shard
                    release_memory()
            rows = [(q, None if null else i, s) for q, heap in enumerate(heaps) for s, null, i in heap]
            yield pa.RecordBatch.from_pylist([dict(zip(("query", "doc_id", "score"), r, strict=True)) for r in rows], arrow_schema("query int, doc_id long, score long"))

        tops = index.mapInArrow(best, "query int, doc_id long, score long")
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
        ranked = stage(tops.withColumn("rank", rank).where(F.col("rank") <= top), "search-ranks")
        held.destroy()
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"query int, item {kind}")
        part_out = ranked.join(F.broadcast(names), "query").select(F.col("item").alias(item_col), "rank", "doc_id", "score")    # one line per query of the block
        out = part_out if out is None else out.unionByName(part_out)
    if out is None:
        return spark.createDataFrame([], f"{item_col} {kind}, rank int, doc_id long, score long")
    return out


def op13_block_max_search(spark, sf_dir):
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, row_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS row_id FROM documents)),
counts AS MATERIALIZED (SELECT row_id, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row_id, term),
docs AS (SELECT row_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row_id),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
sized AS (SELECT row_id, 75 + (25 * n * big_n) // big_l AS m FROM docs CROSS JOIN corpus),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts CROSS JOIN corpus GROUP BY term),
asked AS (SELECT item_row, any_value(item_id) AS item_id, term, count(*) AS c FROM
  (SELECT item_id, item_row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
   FROM (SELECT item_id, text, row_number() OVER () AS item_row FROM benchmark)) GROUP BY item_row, term),
scores AS (SELECT item_row, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sized USING (row_id) GROUP BY item_row, row_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""
