"""Hidden Markov language model, trained by Baum-Welch over partitions.

A text is the sequence of its words and one end.  Hidden states emit classes of
words, and a class its words.  A word that makes up at least an ``OWN``-th of all
tokens is a class of its own, so there are at most ``OWN`` of these; other words fall into
``SHAPES`` classes by their length and last letters, of which a word gets its share
by its count.  This makes the emissions a table of fixed size however many words
there are, while every word keeps its own probability, unseen ones included.

Baum-Welch starts from ``SEED_ROWS`` training rows (those of the smallest hash; a
bound for the starting point only), then goes ``STEPS`` times through all training rows.  Each
task runs scaled forward and backward recursions over its sequences and gives its expected
counts per class, which Spark adds up; the driver gets a row per class.  The scaled forward
recursion gives the exact likelihood of every whole text.

Counts of words: those with at least a ``KNOWN``-th of all tokens, of which there are at most
``KNOWN``, with at most ``KNOWN`` times the mean length of a word in bytes, are sent to
the tasks.  The others are joined, as rows of (text, word), so what is moved grows with
the input, and no such word makes up more than a ``KNOWN``-th of it.

NULL is the empty text, whose only token is the end.  A NULL id counts as the id ''.
Repeated rows count and are scored as often as they occur.  Without training rows
every count is 0, and the model is the starting one.  An empty table has an empty
result.  Only id and text are read, so other columns may have any name.  A task holds a
block of about ``BLOCK_TOKENS`` tokens, or one longer text, with ``STATES`` numbers for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import LOWER, SPACED, Words, coded, mix, slices, utf8, written

STATES = 8
OWN = 1 << 13
SHAPES = 1 << 12
KNOWN = 1 << 17
SEED_ROWS = 2_000
SEED_STEPS = 8
STEPS = 3
#: Tokens that the shares of the corpus add to each state.
PRIOR = 200.0
BLOCK_BYTES = 4 << 20
BLOCK_TOKENS = 1 << 20
#: Stands for the end of a text; no word has a line feed.
END = b"\n"
_SEQUENCE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("training", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
    T.StructField("counted", T.DoubleType()), T.StructField("shared", T.DoubleType()),
    T.StructField("classes", T.BinaryType()),
    T.StructField("rare", T.ArrayType(T.StructType([
        T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())])))])


# ---------------------------------------------------------------- words

def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and code of every word, and the distinct words by code."""
    found = Words(data, offsets, SPACED, LOWER, hashed=False)
    return found.doc, *coded(LOWER[data[found.inside]], found.lengths)


def shapes(words: pa.Array) -> np.ndarray:
    """Class of words by length and last three bytes, below ``SHAPES``."""
    if not len(words):
        return np.zeros(0, np.int64)
    lengths = pc.binary_length(words).to_numpy()
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
    code = np.minimum(lengths, 15).astype(np.uint64)
    for back in (1, 2, 3):
        last = data[np.maximum(ends - back, 0)].astype(np.uint64)
        code = code << np.uint64(8) | np.where(lengths >= back, last, 0).astype(np.uint64)
    return (mix(code) % np.uint64(SHAPES)).astype(np.int64)


def _counted(docs: DataFrame) -> DataFrame:
    """``word, n, c``: how often a word stands in all texts and in those for training."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            training = batch.column(1).to_numpy(zero_copy_only=False)
            for row, end, data, offsets in slices(batch.column(2), BLOCK_BYTES):
                text, code, words = words_of(data, offsets)
                own = training[row:end]
                n = np.append(np.bincount(code, minlength=len(words)), end - row)
                c = np.append(np.bincount(code[own[text]], minlength=len(words)), own.sum())
                words = pa.concat_arrays([words, pa.array([END], pa.large_binary())])
                yield pa.RecordBatch.from_arrays(
                    [words.cast(pa.binary()), pa.array(n, pa.int64()), pa.array(c, pa.int64())],
                    names=["word", "n", "c"])

    rows = docs.mapInArrow(run, "word binary, n long, c long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What tasks know of the words: counts of the usual ones, and of each class of the others."""

    words: pa.Array  # at most KNOWN
    counts: np.ndarray
    own: np.ndarray  # class of a usual word that has one of its own, else -1
    n_own: int
    tokens: int  # of training
    distinct: int
    ends: int
    shape_tokens: np.ndarray  # training tokens and distinct words of each shape
    shape_words: np.ndarray

    @property
    def n_classes(self) -> int:
        return 1 + self.n_own + SHAPES

    def class_shares(self) -> np.ndarray:
        """Share of every class in the training tokens, none zero."""
        own = np.zeros(self.n_own)
        own[self.own[self.own >= 0]] = self.counts[self.own >= 0]
        return (np.concatenate([[self.ends], own, self.shape_tokens]) + 1) / (
            self.tokens + self.n_classes)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The bounded part of the counts: usual words, and sums for the shapes."""
    total, tokens, distinct = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0)),
        F.count_if(F.col("c") > 0)).first()
    word = F.col("word") != F.lit(END)
    # At most KNOWN rows: each has a KNOWN-th of the total.
    usual = counts.where(word & (F.col("n") * KNOWN >= total)).toArrow().sort_by("word")
    ends = counts.where(~word).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    has_own = usual["n"].to_numpy() * OWN >= total
    own = np.where(has_own, np.cumsum(has_own) - 1, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, shape = batch.column(1).to_numpy(), shapes(batch.column(0))
            used = np.flatnonzero(np.bincount(shape, minlength=SHAPES))
            sums = (np.bincount(shape, w, SHAPES)[used].astype(np.int64) for w in (c, c > 0))
            yield pa.RecordBatch.from_arrays([pa.array(used), *map(pa.array, sums)],
                                             names=["shape", "tokens", "words"])

    shared = counts.where(word & (F.col("n") * OWN < total)).select("word", "c")
    sums = shared.mapInArrow(run, "shape long, tokens long, words long").groupBy("shape").agg(
        F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).toArrow()
    of_shape = np.zeros((2, SHAPES))
    of_shape[:, sums["shape"].to_numpy()] = sums["tokens"].to_numpy(), sums["words"].to_numpy()
    return Vocabulary(usual["word"].combine_chunks().cast(pa.large_binary()), usual["c"].to_numpy(),
                      own, int(has_own.sum()), tokens, distinct, ends, *of_shape)


def _sequences(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Classes of every text, sums over its usual words, and its other words."""
    log_count = np.log10(known.counts + 1.0)
    log_shape = np.log10(known.shape_tokens + known.shape_words + 1)

    def block(data: np.ndarray, offsets: np.ndarray, ids: pa.Array, training: pa.Array) -> pa.RecordBatch:
        size = len(offsets) - 1
        text, code, words = words_of(data, offsets)
        at = pc.fill_null(pc.index_in(words, value_set=known.words), -1).to_numpy().astype(np.int64)
        usual = at >= 0
        own = np.where(usual, np.append(known.own, -1)[at], -1)
        shape = shapes(words)
        of_word = np.where(own >= 0, 1 + own, 1 + known.n_own + shape).astype("<u2")
        # What a token adds: log of its count, whether it is known, minus the log of its shape.
        counted = np.where(usual, np.append(log_count, 0)[at], 0)
        is_known = np.where(usual, np.append(known.counts, 0)[at] > 0, False)
        # A word of a shape has its count's share in the shape; the log of usual counts is added here.
        shared = np.where(own >= 0, 0, np.where(usual, counted, 0) - log_shape[shape])
        n_words = np.bincount(text, minlength=size)
        borders = np.concatenate([[0], np.cumsum(n_words + 1)])
        classes = np.zeros(borders[-1], "<u2")
        classes[np.arange(len(code)) + text] = of_word[code]
        sums = [np.bincount(text, v[code], size) for v in (counted, is_known, shared)]
        other = ~usual[code]
        m = max(len(words), 1)
        once, times = np.unique(text[other] * m + code[other], return_counts=True)
        rare = pa.StructArray.from_arrays(
            [words.take(pa.array(once % m)).cast(pa.binary()), pa.array(times)], ["word", "times"])
        rare_at = np.searchsorted(once // m, np.arange(size + 1))
        binary = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), size, [None, pa.py_buffer(2 * borders), pa.py_buffer(classes)])
        return pa.RecordBatch.from_arrays(
            [ids, training, pa.array(n_words + 1),
             pa.array(sums[1].astype(np.int64) + (known.ends > 0)),
             pa.array(sums[0] + np.log10(known.ends + 1.0)), pa.array(sums[2]),
             binary.cast(pa.binary()), pa.ListArray.from_arrays(pa.array(rare_at, pa.int32()), rare)],
            names=_SEQUENCE.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(2), BLOCK_BYTES):
                yield block(data, offsets, *(c.slice(row, end - row) for c in batch.columns[:2]))

    return docs.mapInArrow(run, _SEQUENCE)


# ---------------------------------------------------------------- model

@dataclass
class Packed:
    """Sequences side by side: the first of all, then the second of those that have one, ..."""

    classes: np.ndarray
    at: np.ndarray  # where each place begins, and the end
    order: np.ndarray  # sequences by falling length

    @classmethod
    def of(cls, classes: np.ndarray, offsets: np.ndarray) -> "Packed":
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], lengths)
        at = np.concatenate([[0], np.cumsum(np.bincount(place))])
        packed = np.empty(len(classes), classes.dtype)
        packed[at[place] + np.repeat(rank, lengths)] = classes
        return cls(packed, at, order)


@dataclass
class Model:
    """Start, transition and (class by state) emission probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def first(cls, shares: np.ndarray, states: int) -> "Model":
        """Shares of the corpus, differently bent for each state by fixed draws."""
        codes = np.arange(len(shares) * states, dtype=np.uint64) + np.uint64(1)
        draws = (mix(codes) >> np.uint64(11)).astype(float) / 2.0 ** 53
        emit = shares[:, None] * (0.5 + draws.reshape(len(shares), states))
        move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    def log10(self, classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Likelihood of every sequence by the scaled forward recursion."""
        packed = Packed.of(classes, offsets)
        total = np.zeros(len(packed.order))
        state = None
        for low, high in zip(packed.at, packed.at[1:]):
            size = high - low
            seen = self.emit[packed.classes[low:high]]
            state = (self.start if state is None else state[:size] @ self.move) * seen
            scale = state.sum(1)
            state /= scale[:, None]
            total[:size] += np.log10(scale)
        found = np.empty(len(total))
        found[packed.order] = total
        return found

    def expect(self, classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Expected counts: of starts, of moves from each state, of emissions by class."""
        packed, n = Packed.of(classes, offsets), len(self.start)
        start, move, emit = (x.astype(np.float32) for x in (self.start, self.move, self.emit))
        seen = emit[packed.classes]
        alpha = np.empty_like(seen)
        scale = np.empty(len(seen), np.float32)
        spans = list(zip(packed.at.tolist(), packed.at[1:].tolist()))
        state = None
        for low, high in spans:
            state = (start if state is None else state[:high - low] @ move) * seen[low:high]
            sums = state.sum(1)
            state /= sums[:, None]
            alpha[low:high], scale[low:high] = state, sums
        moves = np.zeros((n, n))
        ahead = np.ones((0, n), np.float32)
        back = np.ascontiguousarray(move.T)
        for low, high in reversed(spans):
            beta = np.ones((high - low, n), np.float32)
            beta[:len(ahead)] = ahead @ back
            moves += alpha[low:low + len(ahead)].T @ ahead
            ahead = seen[low:high] * beta
            ahead /= scale[low:high, None]
            np.multiply(alpha[low:high], beta, out=seen[low:high])
        n_classes = len(emit)
        emitted = np.stack([np.bincount(packed.classes, seen[:, k], n_classes) for k in range(n)], 1)
        return np.concatenate([seen[:len(packed.order)].sum(0, dtype=float)[None],
                               moves * self.move, emitted])

    def update(self, counts: np.ndarray, shares: np.ndarray) -> "Model":
        """The model that makes the counts likeliest, with a part of the corpus' shares."""
        n = len(self.start)
        start, move, emit = counts[0] + 1 / n, counts[1:1 + n] + 1 / n, counts[1 + n:]
        emit = emit + PRIOR * shares[:, None]
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _blocks(batches: Iterator[pa.RecordBatch], column: int
            ) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row, end, data, offsets in slices(batch.column(column), 2 * BLOCK_TOKENS):
            yield batch, row, end, data.view("<u2"), offsets // 2


def step(sequences: DataFrame, model: Model, shares: np.ndarray) -> Model:
    """One round of Baum-Welch over all given sequences."""
    states, size = len(model.start), 1 + len(model.start) + len(shares)
    columns = [f"s{k}" for k in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((size, states))
        for _, _, _, classes, offsets in _blocks(batches, 0):
            counts += model.expect(classes, offsets)
        used = np.flatnonzero(counts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(c) for c in counts[used].T)],
                                         names=["place", *columns])

    schema = "place long, " + ", ".join(f"{c} double" for c in columns)
    sums = sequences.select("classes").mapInArrow(run, schema).groupBy("place").agg(
        *(F.sum(c).alias(c) for c in columns))
    # A row per class: 1 + STATES + OWN + SHAPES at most.
    found = written(sums, "hmm-counts").toArrow()
    counts = np.zeros((size, states))
    counts[found["place"].to_numpy()] = np.stack([found[c].to_numpy() for c in columns], 1)
    return model.update(counts, shares)


def train(sequences: DataFrame, shares: np.ndarray, states: int = STATES) -> Model:
    """Baum-Welch over the training rows of ``row, training, classes``."""
    rows = sequences.where("training").select("row", "classes")
    draw = rows.select(F.xxhash64("classes", "row").alias("draw"), "row")
    chosen = [r.row for r in draw.orderBy("draw", "row").limit(SEED_ROWS).collect()]
    model = Model.first(shares, states)
    if not chosen:
        return model
    seed = written(rows.where(F.col("row").isin(chosen)).repartition(8, "row"), "hmm-seed")
    for _ in range(SEED_STEPS):
        model = step(seed, model, shares)
    for _ in range(STEPS):
        model = step(rows, model, shares)
    return model


# ---------------------------------------------------------------- scores

def scores(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text",
           states: int = STATES) -> DataFrame:
    """Likelihood of every text by a model of the rows that ``training`` chooses, and by counts alone.

    ``base_score`` is the log10 likelihood of independent tokens with one added to every
    count; ``n_known`` counts tokens that the training rows have.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(training, F.lit(False)).alias("t"),
                       utf8(F.col(f"`{text}`")).alias("bytes"))
    rows = rows.withColumn("id", F.col("id").cast("bigint"))
    counts = written(_counted(rows), "hmm-words")
    known = vocabulary(counts)
    sequences = written(_sequences(rows, known).withColumn("row", F.monotonically_increasing_id()),
                        "hmm-sequences")
    model = train(sequences, known.class_shares(), states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, end, classes, offsets in _blocks(batches, 7):
            yield pa.RecordBatch.from_arrays(
                [c.slice(row, end - row) for c in batch.columns[:7]]
                + [pa.array(model.log10(classes, offsets))], names=scored.names)

    scored = T.StructType([T.StructField("row", T.LongType()), *_SEQUENCE.fields[:6],
                           T.StructField("likelihood", T.DoubleType())])
    likely = sequences.select("row", *_SEQUENCE.names[:7]).mapInArrow(run, scored)
    rest = sequences.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    log_count = F.col("times") * F.log10(F.col("c") + F.lit(1.0))
    sums = (rest.join(counts.select("word", "c"), "word").groupBy("row")
            .agg(F.sum(log_count).alias("rare_counted"),
                 F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known")))
    every = F.lit(float(np.log10(known.tokens + (known.distinct + 1))))
    rare = F.coalesce("rare_counted", F.lit(0.0))
    return likely.join(sums, "row", "left").select(
        F.col("id").alias(doc_id), F.col("training"), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("counted") + rare - F.col("n_tokens") * every).alias("base_score"),
        (F.col("likelihood") + F.col("shared") + rare).alias("score"))
