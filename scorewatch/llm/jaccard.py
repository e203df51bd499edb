"""Near-duplicate join on word shingles through a count-vector R-tree (operator 2).

Documents whose sets of word shingles have Jaccard similarity >= num/den are
linked; the result is each document's component of links. Equal sets are one
class from the start, so copies cost one row each and nothing more.

Routing (exact). Two sets that link differ in at most d = hi*(den-num)/num
elements, where hi bounds the smaller set's size. Elements are hashed into
m > d groups, so at least m - d groups have equal content in both sets. Sizes
fall into levels with their own m; a set gives a key (level, group, content)
for each group that is not empty, also for the level below if a partner there
can be large enough. Only where m - d or more of its groups are empty could
all equal groups of a pair be empty ones; such a set also gives the keys of
prefix filtering (its first n - need(n) + 1 elements in one fixed order), which
two linked sets share. Classes that share a key form a bucket; buckets with
the same classes are kept once. No pair that links is missed.

Elements that a bounded sample of classes shows to be frequent (a passage in
many documents) count as absent in group contents and come last in the prefix
order. Any such list leaves the guarantee as it is; it keeps unrelated
documents out of common buckets.

Index. In a bucket each class is a point: the counts of its elements in
GROUPS hash groups. The overlap of two sets is at most the sum of the
coordinate minima of their points, and of a point and all points under an
R-tree node at most that with the node's upper corner. Points that reach the
overlap a link needs survive and are verified on the exact sets.

Links without all pairs. First, each bucket's members are only tried with
its centre (the point nearest to the coordinate medians), which joins a
group of near copies with one test each. Then buckets that still hold
different components search the R-tree, skipping nodes of the searching
point's own component, so what is already joined is not paired again, and
all pairs that could join two components are verified. Buckets over
BLOCK rows are searched by pairs of blocks, each in its own task.

Defined cases: a null or empty text, or one without words, has the empty set
and is linked with nothing (its own component); with fewer words than a
shingle the whole sequence is the one element; rows with the same id count
as one document when components are joined; a null id has a null component
and links nothing; an empty table gives an empty result; other columns are
ignored (``keep_one`` returns them all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import arrow_schema, bounded_batches, mix64, release_memory, slices, table, text_bytes, word_hashes
from .graph import components

GROUPS = 64                 # coordinates of a point
BLOCK = 512                 # rows that a task searches at once
BITMAP_BITS = 26            # of the broadcast bitmap that thins out documents before verification: 8 MB
SLICE_BYTES = 500_000

_U = np.uint64
_BASE = _U(0xD1342543DE82EF95)


# ---- sets ---------------------------------------------------------------------------------------------------------

def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    h, starts = word_hashes(b"\n".join(texts).lower())
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.searchsorted(starts, np.concatenate(([0], ends)))
    grams = mix64(h + _U(width))
    for k in range(1, width):
        grams = mix64(grams[:len(h) - k] + h[k:])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:
            whole = mix64(h[a:a + 1] + _U(b - a))
            for k in range(a + 1, b):
                whole = mix64(whole + h[k:k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, _U))
    return out


def signature(elements: np.ndarray) -> int:
    """64-bit stand-in for a whole set."""
    sums = np.array([elements.sum(dtype=_U), mix64(elements).sum(dtype=_U)])
    return int(mix64(sums[:1] + sums[1:] * _BASE).view(np.int64)[0])


class Routing:
    """Keys of a set, by which every pair that links meets in at least one bucket."""

    def __init__(self, num: int, den: int, frequent: np.ndarray):
        self.num, self.den, self.frequent = num, den, frequent
        self.low = [1]                                          # least size of each level

    def _reach(self, size: int, level: int) -> None:
        while self.low[-1] <= size or len(self.low) < level + 2:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * 3 // 2))

    def levels(self, n: int) -> list[int]:
        """The set's own level and every lower one that a partner of fewer elements can be in."""
        self._reach(n, 0)
        own = int(np.searchsorted(self.low, n, side="right")) - 1
        least = -(-self.num * n // self.den)
        return [k for k in range(own, -1, -1) if k == own or self.low[k + 1] - 1 >= least]

    def groups(self, level: int) -> tuple[int, int]:
        """Groups m of a level, and how many of them are equal in two sets that link at least."""
        self._reach(0, level)
        high = self.low[level + 1] - 1
        differ = high * (self.den - self.num) // self.num
        m = differ + 1
        for _ in range(4):                                      # room for the share of groups that are empty by chance
            m = -(-(differ + 1) // max(0.25, 1 - 1.6 * float(np.exp(-self.low[level] / m))))
        return int(m), int(m) - differ

    def keys(self, elements: np.ndarray) -> np.ndarray:
        """Keys of a sorted set (groups are ranges of the hash)."""
        n = len(elements)
        if not n:
            return np.zeros(0, np.int64)
        common = np.zeros(n, bool)
        if len(self.frequent):
            common = self.frequent[np.minimum(np.searchsorted(self.frequent, elements), len(self.frequent) - 1)] == elements
        rare = elements[~common]
        total = np.concatenate((np.zeros(1, _U), np.cumsum(mix64(rare ^ _BASE))))
        out = []
        for level in self.levels(n):
            m, equal = self.groups(level)
            edge = np.searchsorted(((rare >> _U(32)) * _U(m)) >> _U(32), np.arange(m + 1, dtype=_U))
            held = np.flatnonzero(edge[1:] > edge[:-1])
            content = total[edge[held + 1]] - total[edge[held]]
            out.append(mix64(content + mix64(held.astype(_U) + _U((level + 1) << 40))))
            if m - len(held) >= equal:
                first = np.concatenate((rare, elements[common]))[:n - -(-self.num * n // self.den) + 1]
                out.append(mix64(first + mix64(np.array([(level + 1) << 40], _U) - _U(1))))
        return np.concatenate(out).view(np.int64)


SETS = "doc_id long, n long, sig long, point binary"
USABLE = "n > 0 AND doc_id IS NOT NULL"


def sets_table(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, n, sig, point) of every row; ``sig`` stands for the set."""
    schema = arrow_schema(SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            for a, b in slices([len(t) for t in raw], SLICE_BYTES):
                sets = shingle_sets(raw[a:b], width)
                points = [np.bincount((s & _U(GROUPS - 1)).astype(np.int64), minlength=GROUPS).astype("<u4").tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([signature(s) for s in sets], pa.int64()), pa.array(points, pa.binary())], schema=schema)
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, SETS)


def frequent_elements(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int,
                      sample: int = 4_000, least: int = 8) -> np.ndarray:
    """Sorted elements that ``least`` or more of ``sample`` classes hold (at most 2**18, the most frequent ones)."""
    picked = classes.orderBy(F.xxhash64("sig"), "sig").limit(sample).select(F.col("doc_id").alias("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = text_bytes(batch.column(0))
            for a, b in slices([len(t) for t in raw], SLICE_BYTES):
                found, n = np.unique(np.concatenate([np.zeros(0, _U), *shingle_sets(raw[a:b], width)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["element", "n"])

    top = (docs.join(F.broadcast(picked), F.col(id_col).cast("long") == F.col("_id")).select(text_col)
           .mapInArrow(run, "element long, n long").groupBy("element").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
           .orderBy(F.desc("n"), "element").limit(1 << 18).toArrow())
    return np.sort(top.column("element").to_numpy().view(np.uint64))


def key_rows(docs: DataFrame, text_col: str, width: int, num: int, den: int, frequent: np.ndarray) -> DataFrame:
    """(key, sig) of every text; a task gives equal sets once."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routing, seen = Routing(num, den, held.value), set()
        for batch in batches:
            raw = text_bytes(batch.column(0))
            for a, b in slices([len(t) for t in raw], SLICE_BYTES):
                keys, sigs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                if len(seen) > 200_000:
                    seen.clear()
                for elements in shingle_sets(raw[a:b], width):
                    sig = signature(elements)
                    if sig not in seen:
                        seen.add(sig)
                        keys.append(routing.keys(elements))
                        sigs.append(np.full(len(keys[-1]), sig))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(sigs))], ["key", "sig"])
        release_memory()

    return docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(run, "key long, sig long")


# ---- the index ----------------------------------------------------------------------------------------------------

def needed(n, m, num: int, den: int):
    """Least overlap with which sets of n and m elements link."""
    return -(-num * (n + m) // (num + den))


class CountTree:
    """R-tree over count vectors, packed bottom up in order of size and coordinate sums."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, num: int, den: int, fan: int = 16):
        self.num, self.den = num, den
        half = points[:, : points.shape[1] // 2].sum(axis=1)
        slab = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (fan * fan)
        self.order = np.lexsort((half, slab))
        p, n, c = points[self.order], sizes[self.order], labels[self.order]
        one = np.ones(len(n), bool)
        self.levels = [(p, n, n, c, one)]                      # upper corner, least and largest size, label, one label only
        while len(self.levels[-1][0]) > 1:
            p, low, high, c, one = self.levels[-1]
            at = np.arange(0, len(p), fan)
            first = np.minimum.reduceat(c, at)
            self.levels.append((np.maximum.reduceat(p, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), first,
                                np.logical_and.reduceat(one, at) & (first == np.maximum.reduceat(c, at))))
        self.fan = fan

    def search(self, point: np.ndarray, size: int, label: int) -> np.ndarray:
        """Points of other labels whose overlap bound reaches what a link needs."""
        at = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            p, low, high, c, one = (x[at] for x in self.levels[depth])
            fits = (high * self.den >= self.num * size) & (size * self.den >= self.num * low) & ~(one & (c == label))
            at = at[fits]
            bound = np.minimum(p[fits], point).sum(axis=1)
            at = at[bound >= needed(size, low[fits], self.num, self.den)]
            if depth:
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def _points(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, GROUPS).astype(np.int64)


def by_group(rows: DataFrame, keys: list[str], step, schema: str) -> DataFrame:
    """``step(table)`` for each group of at most a few thousand rows, many groups to a task."""
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(t: pa.Table) -> Iterator[pa.RecordBatch]:
            k = np.stack([t.column(c).to_numpy() for c in keys])
            cut = np.flatnonzero(np.concatenate(([True], (k[:, 1:] != k[:, :-1]).any(axis=0), [True])))
            made = [step(t.slice(a, b - a)) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            for m in pa.Table.from_pylist([r for rows in made for r in rows], schema=out).to_batches():
                yield m

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            t = pa.Table.from_batches(held)
            last = [t.column(c)[-1].as_py() for c in keys]
            same = np.logical_and.reduce([t.column(c).to_numpy() == v for c, v in zip(keys, last, strict=True)])
            done = int(t.num_rows - same.sum())                 # the last group may go on in the next batch
            if done:
                yield from groups(t.slice(0, done).combine_chunks())
            held = t.slice(done).combine_chunks().to_batches()
        if held:
            yield from groups(pa.Table.from_batches(held))

    return rows.repartition(*keys).sortWithinPartitions(*keys, "sig").mapInArrow(run, schema)


# ---- candidates ---------------------------------------------------------------------------------------------------

def bucket_members(keys: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, size, sig, n, point) of every bucket of two classes or more, same buckets once.

    The keys are shuffled once; what stays after the filter is small.
    """
    of_key = Window.partitionBy("key")
    shared = stage(keys.withColumns({"_a": F.min("sig").over(of_key), "_b": F.max("sig").over(of_key)})
                   .where("_a != _b").select("key", "sig").distinct(), "join-shared")
    marks = shared.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("sig").alias("a"), F.max("sig").alias("b"), F.bit_xor("sig").alias("x"))
    kept = stage(marks.groupBy("size", "a", "b", "x").agg(F.min("key").alias("bucket")).select("bucket", "size"), "join-buckets")
    members = shared.join(kept, F.col("key") == F.col("bucket")).select("bucket", "size", F.col("sig").alias("_s"))
    return stage(members.join(classes.select("sig", "n", "point"), F.col("_s") == F.col("sig")).drop("_s"), "join-members")


def centre_pairs(members: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Each bucket's centre, and the members that may link with it: (bucket, centre), (a, b)."""
    def nearest(t: pa.Table) -> list[dict]:
        p = _points(t.column("point").combine_chunks())
        far = np.abs(p - np.median(p, axis=0)).sum(axis=1)
        i = int(far.argmin())
        return [{"bucket": t.column("bucket")[i].as_py(), "far": float(far[i]), "centre": t.column("sig")[i].as_py(),
                 "cn": t.column("n")[i].as_py(), "cpoint": t.column("point")[i].as_py()}]

    dealt = members.withColumn("part", F.pmod(F.xxhash64("sig"), F.ceil(F.col("size") / BLOCK)))
    best = by_group(dealt.select("bucket", "part", "sig", "n", "point"), ["bucket", "part"], nearest,
                    "bucket long, far double, centre long, cn long, cpoint binary")
    centres = stage(best.groupBy("bucket").agg(F.min_by(F.struct("centre", "cn", "cpoint"), F.struct("far", "centre")).alias("c"))
                    .select("bucket", "c.*"), "join-centres")

    @F.arrow_udf("boolean")
    def may_link(n: pa.Array, point: pa.Array, m: pa.Array, other: pa.Array) -> pa.Array:
        n, m = n.to_numpy(zero_copy_only=False), m.to_numpy(zero_copy_only=False)
        bound = np.minimum(_points(point), _points(other)).sum(axis=1)
        return pa.array((np.minimum(n, m) * den >= num * np.maximum(n, m)) & (bound >= needed(n, m, num, den)))

    pairs = (members.join(centres, "bucket").where("sig != centre").where(may_link("n", "point", "cn", "cpoint"))
             .select(F.least("sig", "centre").alias("a"), F.greatest("sig", "centre").alias("b")).distinct())
    return centres.select("bucket", "centre"), pairs


def tree_pairs(members: DataFrame, centres: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) that may link two components: R-tree search in the buckets that hold several."""
    named = stage(members.where("size > 2").join(labels.select(F.col("node").alias("_n"), "component"), F.col("sig") == F.col("_n"), "left")
                  .withColumn("label", F.coalesce("component", "sig")).drop("_n", "component"), "join-named")
    mixed = named.groupBy(F.col("bucket").alias("_k")).agg((F.min("label") != F.max("label")).alias("_mixed")).where("_mixed")
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("sig"), blocks)
    dealt = (named.join(mixed.select("_k"), F.col("bucket") == F.col("_k"), "left_semi").join(centres, "bucket")
             .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sig", "n", "point",
                     "label", "centre"))

    def search(t: pa.Table) -> list[dict]:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sig, n, label, part = (t.column(c).to_numpy() for c in ("sig", "n", "label", "own"))
        p, centre = _points(t.column("point").combine_chunks()), t.column("centre")[0].as_py()
        inner = part == j
        names, counts = np.unique(label[inner], return_counts=True)
        if not len(names) or not (part == i).any():
            return []
        tree, base = CountTree(p[inner], n[inner], label[inner], num, den), np.flatnonzero(inner)
        # Inside one block, pairs of different labels have one side outside the most frequent label.
        asks = np.flatnonzero((part == i) & ((label != names[counts.argmax()]) if i == j else True) & (sig != centre))
        found = []
        for q in asks.tolist():
            for k in base[tree.search(p[q], int(n[q]), int(label[q]))].tolist():
                if sig[k] != centre and label[k] != label[q]:
                    found.append({"a": min(int(sig[q]), int(sig[k])), "b": max(int(sig[q]), int(sig[k]))})
        return found

    return by_group(dealt, ["bucket", "i", "j"], search, "a long, b long").distinct()


# ---- verification -------------------------------------------------------------------------------------------------

def id_bitmap(ids: DataFrame, id_col: str):
    """Boolean column function of an id column, false only where the id is not in ``ids``, and its broadcast.

    A bitmap of fixed size (BITMAP_BITS) over hashed ids is broadcast; what it
    lets through by chance goes in the join that follows it.
    """
    bit = F.xxhash64(F.col(id_col).cast("long")).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = (ids.select(bit.alias("bit")).select(F.shiftright("bit", 5).alias("word"), F.expr("shiftleft(1L, cast(bit & 31 as int))").alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    bitmap[words.column("word").to_numpy()] = words.column("mask").to_numpy().astype(np.uint32)
    held = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def may_hold(h: pa.Array) -> pa.Array:
        at = h.to_numpy(zero_copy_only=False) & ((1 << BITMAP_BITS) - 1)
        return pa.array(((held.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1).astype(bool))

    return (lambda column: may_hold(F.xxhash64(column.cast("long")))), held


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose exact sets link."""
    pairs = stage(pairs, "join-pairs")
    sigs = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    named = stage(sigs.join(classes.select(F.col("sig").alias("_s"), F.col("doc_id").alias("id")), F.col("sig") == F.col("_s")).drop("_s"), "join-ids")
    whole = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    may_hold, held = id_bitmap(named, "id")
    # Staged, so that no task runs two Python functions, each with a worker of its own.
    texts = stage(whole.where(may_hold(F.col("_id"))).join(named, F.col("_id") == F.col("id")).select("sig", F.col("_text").alias("text")), "join-candidates")
    held.destroy()
    # An id may stand for rows of several classes: keep the text of the class itself.
    own = stage(texts.where(set_hash("text", width) == F.col("sig")).dropDuplicates(["sig"]), "join-texts")
    a, b = own.select(F.col("sig").alias("a"), F.col("text").alias("ta")), own.select(F.col("sig").alias("b"), F.col("text").alias("tb"))

    @F.arrow_udf("boolean")
    def links(x: pa.Array, y: pa.Array) -> pa.Array:
        out, last, left = [], None, None
        for s, t in zip(text_bytes(x), text_bytes(y), strict=True):
            if s != last:
                last, left = s, shingle_sets([s], width)[0]
            right = shingle_sets([t], width)[0]
            common = len(np.intersect1d(left, right, assume_unique=True))
            out.append(den * common >= num * (len(left) + len(right) - common))
        return pa.array(out)

    return stage(pairs.join(b, "b").join(a, "a").where(links("ta", "tb")).select("a", "b"), "join-links")


def set_hash(text_col: str, width: int):
    """Column of the hash that stands for a text's set; null without words."""
    @F.arrow_udf("long")
    def sig(text: pa.Array) -> pa.Array:
        return pa.array([signature(s) if len(s) else None for s in shingle_sets(text_bytes(text), width)], pa.int64())

    return sig(text_col)


# ---- the join -----------------------------------------------------------------------------------------------------

def class_links(docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, classes, links): every row's set, one line per class of equal sets, and the classes (a, b) that link."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))        # other columns' names cannot clash
    sets = stage(sets_table(docs, "doc_id", "text", width), "join-sets", compression="zstd")
    classes = stage(sets.where(USABLE).groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("point").alias("point")),
                    "join-classes", compression="zstd")
    named_docs = docs.where(F.col("doc_id").isNotNull())
    frequent = frequent_elements(named_docs, classes, "doc_id", "text", width)
    members = bucket_members(key_rows(named_docs, "text", width, num, den, frequent), classes)
    centres, tried = centre_pairs(members, num, den)
    near = verified(tried, classes, docs, "doc_id", "text", width, num, den)
    more = verified(tree_pairs(members, centres, components(near, "a", "b"), num, den), classes, docs, "doc_id", "text", width, num, den)
    return sets, classes, near.union(more)


def near_duplicates(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) for every row; links: Jaccard >= num/den."""
    sets, classes, found_links = class_links(docs, width, num, den, id_col, text_col)
    usable = sets.where(USABLE)
    # Links between classes become links between documents; an id with rows in several classes joins them.
    name = classes.select("sig", F.col("doc_id").alias("id"))
    links = (found_links.join(name.select(F.col("sig").alias("a"), F.col("id").alias("u")), "a")
             .join(name.select(F.col("sig").alias("b"), F.col("id").alias("v")), "b").select("u", "v"))
    twice = usable.groupBy("doc_id").agg(F.min("sig").alias("s"), F.max("sig").alias("t")).where("s != t").select("doc_id")
    joined = (usable.join(twice, "doc_id").join(name.withColumnRenamed("id", "v"), "sig").select(F.col("doc_id").alias("u"), "v"))
    found = components(links.union(joined), "u", "v")
    named = sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("sig")).alias("sig")) \
        .join(name, "sig", "left").withColumn("class_id", F.coalesce("id", "doc_id"))
    roots = found.select(F.col("node").alias("class_id"), "component")
    return (named.join(roots, "class_id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id")).alias("component_id")))


def keep_one(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of rows whose texts link, directly or through others; all columns, whatever their names.

    The row with the smallest id stays, of its rows that differ the one with the
    smallest set hash, of rows equal in id and set the smallest in all columns.
    Rows with a null id, and rows without words, stay; rows that share an id and
    nothing else are different documents and stay too.
    """
    sets, _, links = class_links(docs, width, num, den, id_col, text_col)
    found = components(links, "a", "b")
    rows = stage(sets.where(USABLE).select("doc_id", "sig").join(found, F.col("sig") == F.col("node"), "left")
                 .select("doc_id", "sig", F.coalesce("component", "sig").alias("group")), "join-found")
    stays = rows.groupBy("group").agg(F.min(F.struct("doc_id", "sig")).alias("s"))
    lost = stage(rows.join(stays, "group").where(F.struct("doc_id", "sig") != F.col("s")).select("doc_id", "sig").distinct(), "join-gone")
    again = stage(sets.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "join-again")
    unsure = lost.select("doc_id").union(again).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).cast("long").alias("_id"),
                        F.col(text_col).alias("_text"))
    may_hold, _ = id_bitmap(unsure, "doc_id")
    marked = F.coalesce(may_hold(F.col("_id")), F.lit(False))                       # only these rows are shuffled
    left = whole.where(~marked).union(whole.where(marked).join(unsure, F.col("_id") == F.col("doc_id"), "left_anti"))
    if again.isEmpty():
        return left.select("_row.*")
    # Rows that share an id are told apart by their sets.
    shared = stage(whole.join(again, F.col("_id") == F.col("doc_id"), "left_semi"), "join-shared-ids")
    shared = stage(shared.withColumn("_sig", set_hash("_text", width)), "join-shared-sets")
    wordless = shared.where("_sig IS NULL")
    one = (shared.where("_sig IS NOT NULL").join(lost, (F.col("_id") == F.col("doc_id")) & (F.col("_sig") == F.col("sig")), "left_anti")
           .groupBy("_id", "_sig").agg(F.min("_row").alias("_row")))
    return left.select("_row").union(wordless.select("_row")).union(one.select("_row")).select("_row.*")


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])
                                        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM common JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 90 * (a.n + b.n - c)),
sym AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(u, v) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.u, b.v FROM reach r JOIN sym b ON r.v = b.u),
root AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT n.doc_id, n.n AS n_shingles, root.component_id FROM n JOIN root ON root.u = n.doc_id"""


def op2_count_tree_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
