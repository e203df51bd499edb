"""Quality rules with n-gram perplexity bands (operator 1).

Two kinds of rules judge a text. Base rules count words, symbols, repeated
lines and words in repeated 5-word windows. The perplexity rule scores every
text with an interpolated modified Kneser-Ney model of its language over
character n-grams (order 4) and rejects texts whose perplexity lies outside
the language's band: between a lower and an upper fence, set by the quartiles
over all its documents that pass the base rules (see ``bands``).

Scores are out of sample. Texts fall into FOLDS folds by the smallest hash of
their 5-word windows, so exact copies share a fold and near copies mostly do;
a text is scored by the model counted over the other folds' texts that pass
the base rules. Neither its own n-grams nor copies nor base-failed junk make
it look predictable. A text that repeats itself is judged by its own
n-grams: where these alone (``own_log10``) predict it below the lower fence,
and twice as well as the language does, that is its perplexity.

Counting: each task counts the 4-grams of its texts (packed into 64 bits, 16
per character), Spark adds the counts up per language and derives
continuation counts, discounts, back-off weights and probabilities with
joins and aggregates, for all languages at once. Characters rather than
words keep the number of n-grams far below the number of words. The model
holds, per language, fold and order, the packed n-grams themselves in sorted
arrays with their probabilities, found by binary search: an n-gram is found
if and only if it was counted, whatever the corpus. The arrays take 12 bytes
for each distinct n-gram and grow with the n-grams counted.

Defined cases: a null text is empty (no words, so the base rules reject it)
and has null perplexity; a null language is a language of its own; a
language without documents that pass the base rules has no band and rejects
nothing, and a text whose language has none in the other folds has null
perplexity and is judged by the base rules alone; null and repeated ids are kept, one row each; an empty table gives
an empty result; ``keep_good`` keeps all other columns whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import arrow_schema, bounded_batches, mix64, release_memory, slices, table, text_bytes

ORDER = 4
FOLDS = 5
START, END = 0, 1              # symbols before and after a text
SLICE_CHARS = 500_000
MAX_BROADCAST_BANDS = 100_000  # languages; with more the bands are joined by a shuffle

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


# ---- base rules ---------------------------------------------------------------------------------------------------

def windows(h: np.ndarray) -> np.ndarray:
    """A hash of each run of five word hashes."""
    w = h[:-4].copy()
    for k in range(1, 5):
        w = mix64(w) + h[k:len(h) - 4 + k]
    return w


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()                       # ASCII white space, the word rule's breaks
    n = len(words)
    a = np.frombuffer(text, np.uint8)
    word_chars = sum(map(len, words)) - int(np.count_nonzero((a & 0xC0) == 0x80))   # less continuation bytes
    symbols = int(np.count_nonzero(_SYMBOL[a]))
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    repeats = 0
    if n >= 5:
        w = windows(np.fromiter(map(hash, words), np.int64, n).view(np.uint64))
        s = np.sort(w)
        twice = s[1:][s[1:] == s[:-1]]
        if twice.size:
            start = np.flatnonzero(np.isin(w, twice))
            edge = np.zeros(n + 1, np.int32)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + 5, -1)
            repeats = int(np.count_nonzero(np.cumsum(edge[:-1])))
    return n, word_chars, symbols, len(lines) - len(set(lines)), repeats


def base_fails(counts: tuple[int, int, int, int, int]) -> bool:
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def fold_of(text: bytes) -> int:
    """Below FOLDS, by the smallest hash of the text's 5-word windows (of all words if it has fewer)."""
    words = text.split()
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    w = windows(h) if len(h) >= 5 else h
    return int(mix64(w.min(keepdims=True))[0] % np.uint64(FOLDS)) if len(w) else 0


def fold_key(lang: str | None, fold: int) -> str:
    """Name of the model that scores the texts of one fold of a language."""
    return f"{fold}-" if lang is None else f"{fold}+{lang}"


# ---- n-grams ------------------------------------------------------------------------------------------------------

def symbols_of(text: str) -> np.ndarray:
    """16-bit symbols: ORDER-1 starts, the characters, one end. Characters beyond 16 bits share the private range."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.where(a > 0xFFFF, 0xE000 + a % 6400, a)
    a = np.where(a <= END, a + 2, a)
    return np.concatenate((np.full(ORDER - 1, START), a, [END])).astype(np.uint64)


def ngrams(symbols: np.ndarray, n: int) -> np.ndarray:
    """Packed n-grams that end at each character and at the end of the text."""
    first = ORDER - n
    total = len(symbols) - ORDER + 1
    g = symbols[first:first + total].copy()
    for k in range(1, n):
        g = (g << np.uint64(16)) | symbols[first + k:first + k + total]
    return g


def count_ngrams(docs: DataFrame, lang_col: str, text_col: str, crossed: bool = False) -> DataFrame:
    """(lang, gram, count) of all ORDER-grams; each task adds up its own first.

    ``crossed``: only texts that pass the base rules, under the ``fold_key`` of every other fold.
    """
    schema = arrow_schema("lang string, gram long, count long")

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, counts = merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)),
                                              pa.array(counts)], schema=schema)
        held.clear()

    def merge(parts):
        grams = np.concatenate([p[0] for p in parts])
        keys, inverse = np.unique(grams, return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if crossed:
                raw = text_bytes(batch.column(1))
                texts = [None if base_fails(base_counts(b)) else t for b, t in zip(raw, texts, strict=True)]
                langs = [x if t is None else fold_key(x, fold_of(b)) for x, b, t in zip(langs, raw, texts, strict=True)]
            for lang in set(langs):
                own = [t for x, t in zip(langs, texts, strict=True) if x == lang and t]
                for a, b in slices([len(t) for t in own], SLICE_CHARS):
                    held.setdefault(lang, []).append(
                        np.unique(np.concatenate([ngrams(symbols_of(t), ORDER) for t in own[a:b]]), return_counts=True))
                    if len(held[lang]) > 8:
                        held[lang] = [merge(held[lang])]
            if sum(len(p[0]) for parts in held.values() for p in parts) > 4_000_000:     # bounds a task's memory
                yield from flush(held)
        yield from flush(held)
        release_memory()

    counts = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
              .mapInArrow(run, "lang string, gram long, count long")
              .groupBy("lang", "gram").agg(F.sum("count").alias("count")))
    if not crossed:
        return counts
    others = F.array(*[F.lit(str(k)) for k in range(FOLDS)])         # a key begins with its fold's digit
    return (counts.withColumn("_fold", F.explode(F.filter(others, lambda k: k != F.substring("lang", 1, 1))))
            .groupBy(F.concat("_fold", F.expr("substring(lang, 2)")).alias("lang"), "gram").agg(F.sum("count").alias("count")))


# ---- modified Kneser-Ney ------------------------------------------------------------------------------------------

def _low(column: str, n: int):
    """The last ``n`` symbols of a packed gram."""
    return F.col(column).bitwiseAND(F.lit((1 << (16 * n)) - 1 if n else 0))


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def kneser_ney(counts: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """Grams (lang, gram, value = log10 p) of orders 0..ORDER and contexts
    (lang, gram, value = log10 back-off weight) of orders 1..ORDER.

    Interpolated: p(w | context) = (c - D(c)) / c(context) + backoff(context) * p(w | shorter context),
    down to a uniform share for each character and one unknown. Orders below the
    highest count the distinct symbols before a gram; D(1), D(2), D(3 and more)
    come from the counts of counts of each language and order.
    """
    levels = {ORDER: stage(counts, "kn-counts")}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = stage(levels[n + 1].groupBy("lang", _low("gram", n).alias("gram")).agg(F.count(F.lit(1)).alias("count")), "kn-counts")
    grams: dict[int, DataFrame] = {}
    contexts: dict[int, DataFrame] = {}
    for n in range(1, ORDER + 1):
        own = levels[n]
        of = own.groupBy(F.col("lang").alias("_l")).agg(
            F.count(F.lit(1)).alias("types"), *[F.count(F.when(F.col("count") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)])
        y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
        discounts = {}
        for k in (1, 2, 3):       # half a count where the counts of counts give no usable discount
            d = F.try_subtract(F.lit(float(k)), F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}")))
            discounts[f"d{k}"] = F.when((d > 0) & (d < k), d).otherwise(F.lit(0.5))
        of = of.select("_l", "types", *[d.alias(name) for name, d in discounts.items()])
        cut = F.when(F.col("count") == 1, F.col("d1")).when(F.col("count") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = own.join(of, _same("lang", "_l")).drop("_l").withColumns(
            {"_cut": cut, "_ctx": F.shiftrightunsigned("gram", 16) if n > 1 else F.lit(0).cast("long")})
        heads = rows.groupBy(F.col("lang").alias("_cl"), F.col("_ctx").alias("_c")).agg(
            F.sum("count").alias("_total"), F.max("types").alias("_types"), (F.sum("_cut") / F.sum("count")).alias("_back"))
        heads = stage(heads, "kn-contexts")
        contexts[n] = heads.select(F.col("_cl").alias("lang"), F.col("_c").alias("gram"), F.log10("_back").alias("value"))
        if n == 1:
            grams[0] = heads.select(F.col("_cl").alias("lang"), F.col("_c").alias("gram"),
                                    F.log10(1 / (F.col("_types") + 1)).alias("value"))
        shorter = grams[n - 1].select(F.col("lang").alias("_bl"), F.col("gram").alias("_b"), F.col("value").alias("_below"))
        p = (F.col("count") - F.col("_cut")) / F.col("_total") + F.col("_back") * F.pow(F.lit(10.0), F.col("_below"))
        grams[n] = stage(rows.join(heads, _same("lang", "_cl") & (F.col("_ctx") == F.col("_c")))
                         .withColumn("_suffix", _low("gram", n - 1))
                         .join(shorter, _same("lang", "_bl") & (F.col("_suffix") == F.col("_b")))
                         .select("lang", "gram", F.log10(p).alias("value")), "kn-grams")
    return grams, contexts


class SortedGramModel:
    """By order and language the sorted packed n-grams with a value each: grams of orders 0..ORDER, contexts of orders 1..ORDER."""

    def __init__(self, grams: dict[int, dict], contexts: dict[int, dict]):
        self.grams, self.contexts = grams, contexts

    @staticmethod
    def _find(held: dict, lang: str | None, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if lang not in held:
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.float32)
        keys, values = held[lang]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, values[at]

    def log10(self, lang: str | None, symbols: list[np.ndarray]) -> list[float]:
        """Log10 probability of each text (symbol arrays); NaN if the language has no model."""
        known, uniform = self._find(self.grams[0], lang, np.zeros(1, np.uint64))
        if not known[0]:
            return [float("nan")] * len(symbols)
        ends = np.cumsum([len(s) - ORDER + 1 for s in symbols])
        grams, place = np.unique(np.concatenate([ngrams(s, ORDER) for s in symbols]), return_inverse=True)
        found, value = self._find(self.grams[ORDER], lang, grams)
        total = value.astype(float)
        left = np.flatnonzero(~found)                      # only n-grams that the model has not seen
        total[left] = 0
        grams = grams[left]
        for n in range(ORDER, 0, -1):
            if not left.size:
                break
            context = grams >> np.uint64(16) if n > 1 else np.zeros(len(grams), np.uint64)
            held, back = self._find(self.contexts[n], lang, context)
            total[left] += np.where(held, back, 0)
            if n == 1:
                total[left] += uniform[0]
                break
            grams = grams & np.uint64((1 << (16 * (n - 1))) - 1)
            found, value = self._find(self.grams[n - 1], lang, grams)
            total[left[found]] += value[found]
            left, grams = left[~found], grams[~found]
        return np.add.reduceat(total[place], np.concatenate(([0], ends[:-1]))).tolist()


def own_log10(symbols: np.ndarray) -> float:
    """Log10 probability of a text by its own earlier n-grams alone.

    After each context the next symbol has the share it had there so far, and one unit is spread over all
    16-bit symbols. The product over the text depends on the counts only, not on their order.
    """
    g = ngrams(symbols, ORDER)
    g, c = np.unique(g, return_counts=True)
    at = np.flatnonzero(np.concatenate(([True], g[1:] >> np.uint64(16) != g[:-1] >> np.uint64(16))))
    return float((_log_rising(2.0 ** -16, c).sum() - _log_rising(1.0, np.add.reduceat(c, at)).sum()) / np.log(10))


def _log_rising(a: float, n: np.ndarray) -> np.ndarray:
    """log(a (a + 1) ... (a + n - 1)) for n of at least 1."""
    x = a + n
    shifted = x + 7                     # Stirling's series, exact to 1e-9 from 7 on
    log_gamma = ((shifted - 0.5) * np.log(shifted) - shifted + 0.5 * np.log(2 * np.pi) + 1 / (12 * shifted) - 1 / (360 * shifted ** 3)
                 - np.log(x * (x + 1) * (x + 2) * (x + 3)) - np.log((x + 4) * (x + 5) * (x + 6)))
    return log_gamma - lgamma(a)


def train_model(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", crossed: bool = False) -> SortedGramModel:
    """Count every text of ``docs`` (``crossed``: see ``count_ngrams``), and bring the sorted arrays together."""
    bounded_batches(docs.sparkSession)
    grams, contexts = kneser_ney(count_ngrams(docs, lang_col, text_col, crossed))

    def arrays(rows: DataFrame) -> dict[str | None, tuple[np.ndarray, np.ndarray]]:
        held = rows.select("lang", "gram", F.col("value").cast("float")).toArrow()
        if not held.num_rows:
            return {}
        lang = held.column("lang").combine_chunks().dictionary_encode(null_encoding="encode")
        code = lang.indices.to_numpy()
        keys, values = held.column("gram").to_numpy().view(np.uint64), held.column("value").to_numpy()
        order = np.lexsort((keys, code))
        cut = np.searchsorted(code[order], np.arange(len(lang.dictionary) + 1))
        return {x: (keys[order[a:b]], values[order[a:b]]) for x, a, b in zip(lang.dictionary.to_pylist(), cut, cut[1:])}

    return SortedGramModel({n: arrays(d) for n, d in grams.items()}, {n: arrays(d) for n, d in contexts.items()})


# ---- scores and verdicts ------------------------------------------------------------------------------------------

SCORES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, n_symbols_scored long, log10_perplexity double, own_log10 double")


def quality_column(spark, model: SortedGramModel, lang_col: str = "lang", text_col: str = "text"):
    """Struct column of SCORES for every row; ``model`` is a crossed one, or its broadcast."""
    held = model if isinstance(model, Broadcast) else spark.sparkContext.broadcast(model)
    ddl = "struct<" + ",".join(f"{n}:{t}" for n, t in (f.split() for f in SCORES.replace("long", "bigint").split(", "))) + ">"

    @F.arrow_udf(ddl)
    def score(lang: pa.Array, text: pa.Array) -> pa.Array:
        langs, raw = lang.to_pylist(), text_bytes(text)
        base = [base_counts(t) for t in raw]
        perplexity: list[float | None] = [None] * len(raw)
        alone: list[float | None] = [None] * len(raw)
        length = [0] * len(raw)
        keys = [fold_key(x, fold_of(t)) for x, t in zip(langs, raw, strict=True)]
        for x in set(keys):
            own = [i for i, y in enumerate(keys) if y == x and raw[i]]
            for a, b in slices([len(raw[i]) for i in own], SLICE_CHARS):
                run = own[a:b]
                symbols = [symbols_of(raw[i].decode()) for i in run]
                for i, s, lp in zip(run, symbols, held.value.log10(x, symbols), strict=True):
                    length[i] = len(s) - ORDER + 1
                    perplexity[i] = None if np.isnan(lp) else -lp / length[i]
                    alone[i] = -own_log10(s) / length[i]
        failed = [base_fails(b) for b in base]
        columns = [pa.array([b[k] for b in base], pa.int64()) for k in range(5)]
        release_memory()
        return pa.StructArray.from_arrays([*columns, pa.array(failed, pa.bool_()), pa.array(length, pa.int64()),
                                           pa.array(perplexity, pa.float64()), pa.array(alone, pa.float64())], [f.split()[0] for f in SCORES.split(", ")])

    return score(lang_col, text_col)


def _quantiles(rows: DataFrame, keys: list[str], value, probs: list[float], name: str) -> DataFrame:
    """Exact quantiles of ``value`` to four decimals: counted per distinct value first, so they do
    not depend on the order in which tasks end."""
    counted = rows.groupBy(*keys, F.round(value, 4).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    listed = ", ".join(str(p) for p in probs)
    return counted.groupBy(*keys).agg(F.expr(f"percentile(_v, array({listed}), _n)").alias(name))


def bands(scores: DataFrame, spread: float = 2.0, settled: int = 10_000) -> DataFrame:
    """(band_lang, middle, below, above) per language, over rows that pass the base rules.

    A text's log perplexity is a mean over its n symbols, so its distance from
    the language's median is measured in units of sqrt(1/n + 1/settled): it
    scatters less the longer the text, up to ``settled`` symbols. The fences
    lie ``spread`` interquartile ranges outside the quartiles of that distance.
    """
    good = scores.where("NOT base_failed AND log10_perplexity IS NOT NULL")
    middle = _quantiles(good, ["lang"], F.col("log10_perplexity"), [0.5], "m").select(F.col("lang").alias("_ml"), F.col("m")[0].alias("middle"))
    unit = F.sqrt(1 / F.col("n_symbols_scored") + 1 / F.lit(settled))
    apart = (F.col("log10_perplexity") - F.col("middle")) / unit
    q = _quantiles(good.join(middle, F.col("lang").eqNullSafe(F.col("_ml"))), ["lang", "middle"], apart, [0.25, 0.75], "q") \
        .withColumnRenamed("lang", "band_lang")
    iqr = F.col("q")[1] - F.col("q")[0]
    return q.select("band_lang", "middle", (F.col("q")[0] - spread * iqr).alias("below"), (F.col("q")[1] + spread * iqr).alias("above"))


def with_verdict(scores: DataFrame, limits: DataFrame, settled: int = 10_000) -> DataFrame:
    """Add the band at the row's length (low, high; null without one) and ``kept``; a text that repeats
    itself gets ``own_log10`` as its perplexity."""
    unit = F.sqrt(1 / F.greatest("n_symbols_scored", F.lit(1)) + 1 / F.lit(settled))
    limits = stage(limits, "quality-bands")
    if limits.count() <= MAX_BROADCAST_BANDS:
        limits = F.broadcast(limits)
    banded = (scores.join(limits, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
              .withColumns({"low": F.col("middle") + F.col("below") * unit, "high": F.col("middle") + F.col("above") * unit})
              .withColumn("log10_perplexity", F.when((F.col("own_log10") < F.col("low")) & (2 * F.col("own_log10") < F.col("log10_perplexity")),
                                                     F.col("own_log10")).otherwise(F.col("log10_perplexity")))
              .drop("band_lang", "middle", "below", "above", "own_log10"))
    inside = F.col("log10_perplexity").between(F.col("low"), F.col("high"))
    return banded.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """id, lang, SCORES, low, high, kept for every row of ``docs``."""
    model = train_model(docs, lang_col, text_col, crossed=True)
    scores = stage(docs.select(id_col, F.col(lang_col).alias("lang"), quality_column(docs.sparkSession, model, lang_col, text_col).alias("_q"))
                   .select(id_col, "lang", "_q.*"), "quality-scores")
    return with_verdict(scores, bands(scores))


def keep_good(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that both kinds of rules keep, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train_model(docs, lang_col, text_col, crossed=True))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    scored = stage(docs.select(whole, F.col(lang_col).alias("lang"), quality_column(docs.sparkSession, model, lang_col, text_col).alias("_q"))
                   .select("_row", "lang", "_q.*"), "quality-rows")
    model.destroy()                     # the workers' copies go too
    return with_verdict(scored, bands(scored)).where("kept").select("_row.*")


def op1_perplexity_rules(spark, sf_dir):
    out = quality_verdicts(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "lang", "log10_perplexity", "low", "high")
