"""Hidden Markov language model (operator 4).

Tokens are words (A-Z lower-cased) and one end per text. A latent state
moves as a Markov chain and emits a word class (the word's hash modulo
CLASSES; the end is a class of its own); the class emits the word by its
smoothed share of the class's training tokens. The emission tables are so of
fixed size whatever the vocabulary, while the word counts of the corpus stay
in Spark.

Counts. Texts are staged in blocks. Each block's distinct words are counted
(once for each task that reads a part of the block), the counts of a word are
added up over all of these, and every block gets
the corpus counts of its own words back (a co-group), so no table of all
words is broadcast or collected.

Training. Baum-Welch on every training text, in every pass: tasks run
forward-backward over segments of SEGMENT tokens, and Spark adds up the
expected counts of starts, moves and emissions over all partitions (a fixed
number of sums reaches the driver). The first parameters are the classes'
shares of all training tokens, varied at random by state; no text counts for
more than another. The passes read the texts' class sequences, staged once.

Scoring. The scaled forward recursion runs over each whole text and gives
its exact likelihood under the model.

Defined cases: a null text is empty (its end alone); without training texts
the parameters stay as first set; a null id counts as empty text in the fold rule;
null and repeated ids are scored row by row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import stage
from .common import arrow_schema, bounded_batches, id_remainder, mix64, release_memory, slices, table, text_bytes, word_bytes

STATES = 8
CLASSES = 1 << 14
SEGMENT = 64
BLOCK_ROWS = 4096
SMOOTH = 0.1                   # of word counts, in the base score and within a class
SLICE_BYTES = 1_000_000


@dataclass
class Hmm:
    start: np.ndarray          # (K)
    move: np.ndarray           # (K, K)
    emit: np.ndarray           # (CLASSES + 1, K): probability of a class in each state

    def forward(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log likelihood of each class sequence (none empty), by the scaled forward recursion."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        flat = np.concatenate([texts[i] for i in order])
        first = np.cumsum(lengths) - lengths
        total = np.zeros(len(texts))
        a = self.start * self.emit[flat[first]]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]) - 1, side="right")     # texts with more than t tokens
        for t in range(int(lengths[0])):
            n = active[t]
            if t:
                a = (a[:n] @ self.move) * self.emit[flat[first[:n] + t]]
            scale = a.sum(axis=1)
            total[:n] += np.log(scale)
            a /= scale[:, None]
        out = np.empty(len(texts))
        out[order] = total
        return out

    def expected(self, tokens: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts (starts, moves, emissions) of segments: padded (S, T) classes, whether
        a segment begins its text, and its length."""
        s, t_max = tokens.shape
        k = len(self.start)
        rest = np.full(k, 1 / k)
        for _ in range(50):
            rest = rest @ self.move                            # where a text is when a segment goes on
        alpha, scale = np.zeros((t_max, s, k)), np.ones((t_max, s))
        inside = np.arange(t_max)[:, None] < lengths[None, :]
        a = np.where(begins[:, None], self.start, rest) * self.emit[tokens[:, 0]]
        for t in range(t_max):
            if t:
                a = (alpha[t - 1] @ self.move) * self.emit[tokens[:, t]]
            scale[t] = np.where(inside[t], a.sum(axis=1), 1)
            alpha[t] = np.where(inside[t][:, None], a / scale[t][:, None], 0)
        moves, gamma, beta = np.zeros((k, k)), np.empty((t_max, s, k)), np.ones((s, k))
        gamma[t_max - 1] = alpha[t_max - 1]
        for t in range(t_max - 2, -1, -1):
            ahead = self.emit[tokens[:, t + 1]] * beta / scale[t + 1][:, None]
            moves += alpha[t].T @ np.where(inside[t + 1][:, None], ahead, 0)
            beta = np.where(inside[t + 1][:, None], ahead @ self.move.T, 1)
            gamma[t] = alpha[t] * beta
        moves *= self.move
        flat, weight = tokens.T[inside], gamma[inside]
        emissions = np.stack([np.bincount(flat, weight[:, j], len(self.emit)) for j in range(k)], axis=1)
        return gamma[0][begins].sum(axis=0), moves, emissions

    @staticmethod
    def of_counts(starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, share: np.ndarray) -> Hmm:
        """Parameters from expected counts; emissions are smoothed with the classes' share of all tokens."""
        k = len(starts)
        start = (starts + 1 / k) / (starts.sum() + 1)
        move = (moves + 1 / k) / (moves.sum(axis=1, keepdims=True) + 1)
        weight = 100.0
        emit = (emissions + weight * share[:, None]) / (emissions.sum(axis=0) + weight)
        return Hmm(start, move, emit)


def first_guess(share: np.ndarray, states: int, seed: int = 11) -> Hmm:
    """Sticky states whose emissions differ at random around the classes' shares."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * np.exp(0.5 * rng.standard_normal((len(share), states)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def segments(texts: list[np.ndarray], size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut class sequences into padded segments: (S, size) tokens, begins, lengths."""
    counts = np.array([-(-len(t) // size) for t in texts])
    begins = np.zeros(int(counts.sum()), bool)
    begins[np.cumsum(counts) - counts] = True
    lengths = np.full(len(begins), size)
    lengths[np.cumsum(counts) - 1] = [len(t) - (c - 1) * size for t, c in zip(texts, counts.tolist(), strict=True)]
    tokens = np.zeros((len(begins), size), np.int64)
    tokens[np.arange(size) < lengths[:, None]] = np.concatenate(texts)
    return tokens, begins, lengths


def _of_place(letters: np.ndarray, place: np.ndarray) -> np.ndarray:
    """64 mixed bits for a byte at its place in a word."""
    return mix64(mix64((place.astype(np.uint64) << np.uint64(8) | letters) + np.uint64(1)) ^ np.uint64(0x9E3779B97F4A7C15))


PLACES = 64
_LETTER = _of_place(np.tile(np.arange(256, dtype=np.uint8), PLACES), np.repeat(np.arange(PLACES), 256))


def word_keys(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key and start of every word: mixed bits of (place, byte) added up, so that no pattern of letters cancels out."""
    starts, lengths, letters, place, first = word_bytes(raw)
    if not starts.size:
        return np.zeros(0, np.uint64), starts
    bits = _LETTER[place << 8 | letters] if lengths.max() <= PLACES else _of_place(letters, place)
    return mix64(np.add.reduceat(bits, first) + lengths.astype(np.uint64)), starts


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word keys of all texts together, and where each text's words begin and end in them."""
    h, starts = word_keys(b"\n".join(texts).lower())
    return h, np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))))


def classes_of(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(CLASSES - 1)).astype(np.int64)


def class_texts(texts: list[bytes]) -> list[np.ndarray]:
    """Class sequence of each text, the end last."""
    h, at = tokens_of(texts)
    c = classes_of(h)
    return [np.append(c[a:b], CLASSES) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def block_words(texts: DataFrame) -> DataFrame:
    """(block, word, own): training count of each distinct word in what a task reads of the block (0 if only held out).

    A block that straddles row groups of the staged file may be read in parts, by several tasks.
    """
    ddl = "block long, word long, own long"
    schema = arrow_schema(ddl)

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return words, np.bincount(at, np.concatenate([p[1] for p in parts]), len(words)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def done(block: int) -> pa.RecordBatch:
            words, own = merged(held.pop(block))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(words), block)), pa.array(words.view(np.int64)), pa.array(own)], schema=schema)

        for batch in batches:
            blocks, held_out, raw = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), text_bytes(batch.column(2))
            for block in np.unique(blocks).tolist():
                for other in [b for b in held if b != block]:              # a task reads its part of a block in one go
                    yield done(other)
                for keep in (False, True):
                    own = [raw[i] for i in np.flatnonzero((blocks == block) & (held_out == (not keep)))]
                    for a, b in slices([len(t) for t in own], SLICE_BYTES):
                        words, counts = np.unique(tokens_of(own[a:b])[0], return_counts=True)
                        held.setdefault(block, []).append((words, counts * keep))
        for block in list(held):
            yield done(block)
        release_memory()

    return texts.select("block", "held_out", "text").mapInArrow(run, ddl)


def class_sequences(texts: DataFrame) -> DataFrame:
    """(classes): each training text's class sequence, as 16-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = text_bytes(batch.column(0))
            for a, b in slices([len(t) for t in raw], SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array([c.astype("<i2").tobytes() for c in class_texts(raw[a:b])], pa.binary())], ["classes"])
        release_memory()

    return texts.where(~F.col("held_out")).select("text").mapInArrow(run, "classes binary")


def baum_welch_pass(sequences: DataFrame, model: Hmm, share: np.ndarray) -> Hmm:
    """One pass over all training texts; the expected counts are added up across partitions."""
    k, n = len(model.start), len(model.emit)
    held = sequences.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k + n * k)
        for batch in batches:
            raw = batch.column(0).to_pylist()
            for a, b in slices([len(t) for t in raw], SLICE_BYTES):
                tokens, begins, lengths = segments([np.frombuffer(t, "<i2") for t in raw[a:b]])
                for at in range(0, len(begins), 4096):
                    part = slice(at, at + 4096)
                    total += np.concatenate([x.ravel() for x in held.value.expected(tokens[part], begins[part], lengths[part])])
        at = np.flatnonzero(total)
        release_memory()
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "value"])

    sums = (sequences.mapInArrow(run, "at long, value double")
            .groupBy("at").agg(F.sum("value").alias("value")).toArrow())           # at most K + K*K + K*(CLASSES+1) lines
    held.unpersist()
    total = np.zeros(k + k * k + n * k)
    total[sums.column("at").to_numpy()] = sums.column("value").to_numpy()
    return Hmm.of_counts(total[:k], total[k:k + k * k].reshape(k, k), total[k + k * k:].reshape(n, k), share)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def hmm_scores(docs: DataFrame, held_out, states: int = STATES, passes: int = 4,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SCORES for every row of ``docs``; ``held_out`` is a boolean column, learning uses the rest."""
    bounded_batches(docs.sparkSession)
    place = F.monotonically_increasing_id()
    block = F.shiftleft(F.shiftright(place, 33), 22) + F.floor(place.bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK_ROWS)
    texts = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                              held_out.alias("held_out"), block.alias("block")), "hmm-texts", compression="zstd")
    of_word = Window.partitionBy("word").orderBy("block")       # one row for each block, or for each part of it that a task reads
    every = of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = stage(block_words(texts).select("block", "word", F.sum("own").over(every).alias("count"),
                                            (F.row_number().over(of_word) == 1).alias("first")), "hmm-words")
    per_class = (words.where("first AND count > 0").groupBy(F.col("word").bitwiseAND(F.lit(CLASSES - 1)).alias("class"))
                 .agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).toArrow())     # at most CLASSES lines
    ends = texts.where(~F.col("held_out")).count()
    n_class, v_class = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    n_class[per_class.column("class").to_numpy()] = per_class.column("n").to_numpy()
    v_class[per_class.column("class").to_numpy()] = per_class.column("v").to_numpy()
    n_class[CLASSES], v_class[CLASSES] = ends, min(ends, 1)
    n_all, v_all = n_class.sum(), v_class.sum()
    share = (n_class + 0.5) / (n_class + 0.5).sum()
    model, sequences = first_guess(share, states), stage(class_sequences(texts), "hmm-classes", compression="zstd")
    for _ in range(passes if ends else 0):
        model = baum_welch_pass(sequences, model, share)
    held = docs.sparkSession.sparkContext.broadcast((model, n_class, v_class))
    schema = arrow_schema(SCORES)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        hmm, n_of, v_of = held.value
        raw = [t or b"" for t in left.column("text").cast(pa.binary()).to_pylist()]
        keys = right.column("word").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys, counts = keys[order], right.column("count").to_numpy()[order].astype(float)
        n_tokens, n_known, base, within, sequences = [], [], [], [], []
        for a, b in slices([len(t) for t in raw], SLICE_BYTES):
            h, at = tokens_of(raw[a:b])
            c = counts[np.searchsorted(keys, h)] if len(h) else np.zeros(0)
            cls = classes_of(h)
            words = np.diff(at)
            own = np.repeat(np.arange(b - a), words)                # each text's words are added up by themselves
            known, unigram, inner = (np.bincount(own, x, b - a) for x in (
                c > 0, np.log10((c + SMOOTH) / (n_all + SMOOTH * (v_all + 1))),
                np.log10((c + SMOOTH) / (n_of[cls] + SMOOTH * (v_of[cls] + 1)))))
            n_tokens.append(words + 1)
            n_known.append(known + (ends > 0))
            base.append(unigram + np.log10((ends + SMOOTH) / (n_all + SMOOTH * (v_all + 1))))
            within.append(inner)
            cls = cls.astype(np.int16)
            sequences += [np.append(cls[x:y], np.int16(CLASSES)) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        total = np.concatenate(within) + hmm.forward(sequences) / np.log(10)
        return pa.table([left.column("doc_id"), left.column("held_out"), pa.array(np.concatenate(n_tokens)),
                         pa.array(np.concatenate(n_known).astype(np.int64)), pa.array(np.full(len(raw), int(n_all))),
                         pa.array(np.concatenate(base)), pa.array(total)], schema=schema)

    return (texts.groupBy("block").cogroup(words.select("block", "word", "count").groupBy("block"))
            .applyInArrow(score, SCORES))


def op4_hmm_scores(spark, sf_dir):
    return hmm_scores(table(spark, sf_dir, "documents"), id_remainder("doc_id", 10) == 0)
