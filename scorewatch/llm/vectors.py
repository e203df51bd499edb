"""Product codes of integer vectors, nearest entries found by GNAT (operator 11).

Each component x becomes the integer floor(4096 * x); a vector is cut into
equal consecutive parts and every part position has a codebook of at most 16
integer entries, trained by rounds of assigning all parts and replacing every
entry by the floored mean of its parts. A round is one Spark job over the
staged integer vectors: each task adds up its parts by (part, entry,
position), and only those sums, whose number is entries times dimension, are
shuffled and brought back.

The nearest entry is searched in a geometric near-neighbour access tree over
the part's entries (``Gnat``). A node holds split points; every other entry
goes to its nearest split, and for each pair (split, subtree) the smallest
and largest distance from the split to the subtree's entries are kept. Once a
query's distance to a split is known, every subtree whose range lies strictly
outside that distance plus or minus the best distance so far is left out. The
ranges and distances compared there are rounded outwards, so an entry at
exactly the best distance is never left out; distances that decide are exact
integers and ties go to the lower index.

Defined cases: a vector that is null or holds a null, NaN or infinite
component is dropped. Vectors must have the commonest length among those kept
(the longer of two equally common), which must be a multiple of the number of
parts, and components within ``component_limit`` (2^27 for 64 components, so
that squared distances stay in 64 bits): other vectors are returned with null
code and errors and train nothing. Null ids come after all others among the
first 16, equal ids are ordered by their components, and with fewer vectors
there are fewer entries. Null labels form one group; a label's error beyond
64 bits is null. An empty table gives an empty result. Other columns are left
out, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import bounded_batches, table

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Relative outward rounding of distances that decide what is left out.
SLACK = 1e-9


class Gnat:
    """Search tree over integer entries (rows of a matrix), by squared Euclidean distance."""

    def __init__(self, entries: np.ndarray, degree: int = 4):
        self.entries = entries.astype(np.int64)
        self.degree = degree
        self.visited = 0                                  # distances computed so far, over all queries
        self.root = self._build(list(range(len(entries))))

    def _squared(self, a: np.ndarray, entry: int) -> np.ndarray:
        return ((a - self.entries[entry]) ** 2).sum(axis=1)

    def _build(self, members: list[int]):
        """A list of members (leaf), or (splits, children, low, high)."""
        if len(members) <= self.degree:
            return members
        points = self.entries[members]
        splits, nearest = [members[0]], self._squared(points, members[0])
        while len(splits) < self.degree:                  # each next split is the member farthest from those chosen
            order = [i for i in np.argsort(-nearest, kind="stable") if members[i] not in splits]
            splits.append(members[order[0]])
            nearest = np.minimum(nearest, self._squared(points, splits[-1]))
        to_split = np.stack([self._squared(points, s) for s in splits])
        owner = to_split.argmin(axis=0)
        children, low, high = [], np.full((self.degree,) * 2, np.inf), np.full((self.degree,) * 2, -np.inf)
        for j in range(self.degree):
            rest = [i for i, m in enumerate(members) if owner[i] == j and m not in splits]
            children.append(self._build([members[i] for i in rest]))
            for i in range(self.degree):                  # the subtree holds its own split, which only split j itself has visited
                held = rest if i == j else [*rest, members.index(splits[j])]
                if held:
                    reach = np.sqrt(to_split[i, held].astype(float))
                    low[i, j], high[i, j] = reach.min() * (1 - SLACK), reach.max() * (1 + SLACK)
        return splits, children, low, high

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance and index of the nearest entry of every query row, ties to the lower index."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        found = np.full(len(queries), len(self.entries))
        self._search(self.root, queries.astype(np.int64), np.arange(len(queries)), best, found)
        return best, found

    def _visit(self, entry, queries, rows, best, found) -> np.ndarray:
        squared = self._squared(queries[rows], entry)
        self.visited += len(rows)
        better = (squared < best[rows]) | ((squared == best[rows]) & (entry < found[rows]))
        best[rows[better]], found[rows[better]] = squared[better], entry
        return squared

    def _search(self, node, queries, rows, best, found) -> None:
        if isinstance(node, list):
            for entry in node:
                self._visit(entry, queries, rows, best, found)
            return
        splits, children, low, high = node
        alive = np.ones((len(rows), len(splits)), bool)
        for i, entry in enumerate(splits):
            at = np.flatnonzero(alive[:, i])
            if not at.size:
                continue
            away = np.sqrt(self._visit(entry, queries, rows[at], best, found).astype(float))[:, None]
            radius = np.sqrt(best[rows[at]].astype(float))[:, None] * (1 + SLACK)
            alive[at] &= ~((away * (1 - SLACK) - high[i] > radius) | (low[i] - away * (1 + SLACK) > radius))
        for j, child in enumerate(children):
            left = rows[alive[:, j]]
            if child and left.size:
                self._search(child, queries, left, best, found)


def component_limit(length: int) -> int:
    """Largest component size for which a vector's squared distances stay below 2^62."""
    return min(1 << 30, int(math.isqrt((1 << 62) // max(1, length)) // 2))


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label and integer components ``v`` of every vector without null or non-finite components;
    ``v`` is null where a component is beyond 2^30. Staged."""
    x = F.col(vector_col)
    whole = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    small = F.forall(x, lambda c: F.abs(c.cast("double")) < (1 << 30) / SCALE)
    rows = vectors.where(whole).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.size(x).alias("length"),
        F.when(small, F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("int"))).alias("v"))
    return stage(rows.withColumn("top", F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0))), "vectors")


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def train_codebooks(usable: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Integer codebooks (parts, entries, length / parts) after ``rounds`` rounds over all rows of ``usable``."""
    width = length // parts
    first = usable.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    books = np.array([r.v for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    for _ in range(rounds if len(first) and width else 0):
        trees = [Gnat(b) for b in books]

        def sums(batches: Iterator[pa.RecordBatch], trees=trees, shape=books.shape) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
            for batch in batches:
                q = _matrix(batch.column(0), length).astype(np.int64).reshape(batch.num_rows, parts, width)
                for p, tree in enumerate(trees):
                    _, entry = tree.nearest(q[:, p])
                    np.add.at(total[p], entry, q[:, p])
                    count[p] += np.bincount(entry, minlength=shape[1])[:, None]
            p, e, at = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (p, e, at, count[p, e, at], total[p, e, at])], ["part", "entry", "at", "n", "total"])

        held = (usable.select("v").mapInArrow(sums, "part long, entry long, at long, n long, total long")
                .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())    # entries times length lines
        books = books.copy()
        for r in held:
            books[r.part, r.entry, r.at] = r.total // r.n
    return books


def encode(spark, books: np.ndarray, length: int):
    """Column of (code, error) of integer vectors of ``length`` components; null vectors give null."""
    trees, parts = [Gnat(b) for b in books], len(books)

    @F.arrow_udf("code string, error long")
    def coded(v: pa.Array) -> pa.Array:
        held = v.is_valid()
        given = v.filter(held)
        q = _matrix(given, length).astype(np.int64).reshape(len(given), parts, length // parts)
        each = [t.nearest(q[:, p]) for p, t in enumerate(trees)]
        index = np.stack([e[1] for e in each], axis=1).astype(np.uint8)
        code, error = np.full(len(v), None, object), np.zeros(len(v), np.int64)
        at = np.flatnonzero(held.to_numpy(zero_copy_only=False))
        code[at] = [row.tobytes().hex() for row in index]
        error[at] = sum(e[0] for e in each)
        return pa.StructArray.from_arrays([pa.array(code, pa.string()), pa.array(error, mask=~held.to_numpy(zero_copy_only=False))], ["code", "error"])

    return coded("v")


def product_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                  parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """id, code, error, label_error and codebooks_sha256 of every vector without null or non-finite components."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = integer_vectors(vectors, id_col, vector_col, label_col)
    common = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    length = common[0].length if common else 0
    fits = (F.col("length") == length) & (F.col("top") <= component_limit(length)) & F.col("v").isNotNull() & F.lit(length % parts == 0)
    books = train_codebooks(rows.where(fits), length if length % parts == 0 else 0, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    if books.shape[1] == 0:
        coded = rows.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    else:
        coded = stage(rows.select("id", "label", F.when(fits, F.col("v")).alias("v"))
                      .select("id", "label", encode(spark, books, length).alias("_c")).select("id", "label", "_c.code", "_c.error"), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))     # joined under Spark's size check
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left")
            .select(F.col("id").alias(id_col), "code", "error", F.when(F.col("code").isNotNull(), F.col("label_error")).alias("label_error"),
                    F.lit(digest).alias("codebooks_sha256")))


def op11_gnat_codes(spark, sf_dir):
    return product_codes(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same codes by plain distances to every entry, a chain of steps for each round."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
             f"""cells AS MATERIALIZED (SELECT vec_id, i // (n // {PARTS}) AS part, i % (n // {PARTS}) AS place, v[i + 1] AS x
  FROM (SELECT vec_id, v, len(v) AS n, unnest(range(len(v))) AS i FROM kept))""",
             f"""firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES})""",
             "book0 AS MATERIALIZED (SELECT part, entry, place, x AS c FROM firsts JOIN cells USING (vec_id))"]
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT vec_id, part, entry, d FROM
  (SELECT vec_id, part, entry, sum((x - c) * (x - c)) AS d FROM cells JOIN book{r} USING (part, place) GROUP BY vec_id, part, entry)
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)""")
        if r < ROUNDS:
            steps.append(f"""book{r + 1} AS MATERIALIZED (SELECT part, entry, place, coalesce(m, c) AS c FROM book{r} LEFT JOIN
  (SELECT part, entry, place, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM
    (SELECT part, entry, place, sum(x) AS s, count(*) AS n FROM near{r} JOIN cells USING (vec_id, part) GROUP BY part, entry, place)) USING (part, entry, place))""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS h FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id) CROSS JOIN digest"""


OP11_SQL = _sql()
