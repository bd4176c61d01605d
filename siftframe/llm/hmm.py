"""A hidden Markov language model of words.

States emit classes: each frequent word is a class of its own, all other words
fall into classes by their ending, and a word's probability inside its class is
its smoothed share of the class's count. That factor does not depend on the
state path, so the likelihood of a text is the scaled forward recursion over
its classes times one factor per rare word, which is joined in by word. Nothing
that grows with the vocabulary is sent to every task.

Training is Baum-Welch: tasks add up expected counts of their sequences, the
counts are summed by class, and the next model is the table of ``CLASSES``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import fold, pieces, texts_of
from siftframe.session import stage

STATES = 6
ROUNDS = 5
HEAD = 30_000  # words that are classes of their own, at most
ENDINGS = 512  # classes of all other words
SEGMENT = 512  # tokens of a training sequence; longer texts are cut, none is left out
CHUNK = 200_000  # tokens handled together
SMOOTHING = 500.0  # tokens by which each state leans to the corpus's own class rates
END = b"\n"  # the end token; no word holds white space
COUNTED = 200_000  # words counted before the counts are passed on
PIECE = 1 << 22


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, ending, c) over all texts, the end token among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            words = list(found)
            columns = [
                pa.array(words, pa.binary()),
                pa.array(list(map(ending, words)), pa.int32()),
                pa.array(list(found.values()), pa.int64()),
            ]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "ending", "n"])

        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                for text in texts_of(batch, "text"):
                    found.update(fold(text).split())
                    found[END] += 1
                    if len(found) > COUNTED:
                        yield passed_on()
        yield passed_on()

    counts = texts.mapInArrow(run, "word binary, ending int, n long")
    return counts.groupBy("word", "ending").agg(F.sum("n").alias("c"))


def _head(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, ``most`` at most: all from a count upwards that
    a histogram of counts gives. The end token is always among them."""
    steps = F.floor(F.log(F.col("c").cast("double")) * 16).alias("step")
    histogram = sorted(((r["step"], r["count"]) for r in counts.groupBy(steps).count().collect()), reverse=True)
    total, least = 0, math.inf
    for step, n in histogram:
        total += n
        if total > most:
            break
        least = step
    frequent = F.floor(F.log(F.col("c").cast("double")) * 16) >= (least if least < math.inf else 1 << 30)
    rows = counts.where(frequent | (F.col("word") == F.lit(END))).select("word", "c").collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def _sequences(docs: DataFrame, classes) -> DataFrame:
    """``docs`` (doc, held_out, text) as class numbers, with the rare words.
    ``classes``: the numbers of the head words; ``ENDINGS`` classes follow them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = classes.value
        head = len(numbers)
        last = numbers[END]
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                sequences, rare, often = [], [], []
                for text in texts_of(batch, "text"):
                    words = fold(text).split()
                    found = [numbers.get(w, -1) for w in words]
                    others = Counter(w for w, k in zip(words, found, strict=True) if k < 0)
                    if others:
                        by_ending = {w: head + ending(w) for w in others}
                        found = [by_ending[w] if k < 0 else k for w, k in zip(words, found, strict=True)]
                    found.append(last)
                    sequences.append(np.array(found, np.uint16).tobytes())
                    rare.append(list(others))
                    often.append(list(others.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc"),
                        batch.column("held_out"),
                        pa.array(sequences, pa.binary()),
                        pa.array(rare, pa.list_(pa.binary())),
                        pa.array(often, pa.list_(pa.int64())),
                    ],
                    names=["doc", "held_out", "sequence", "rare", "often"],
                )

    schema = "doc long, held_out boolean, sequence binary, rare array<binary>, often array<long>"
    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # states
    moves: np.ndarray  # states x states
    emits: np.ndarray  # classes x states


class Lattice:
    """Sequences laid out by step, longest first, so that a step of all of them
    is one slice."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        lengths = np.array([len(sequences[i]) for i in self.order], np.int64)
        steps = int(lengths[0])
        self.active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.starts = np.concatenate([[0], np.cumsum(self.active)])
        flat = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = self.starts[step] + row
        self.seen = np.empty_like(flat)
        self.seen[place] = flat
        self.row = np.empty_like(row)
        self.row[place] = row

    def forward(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Emissions, scaled forward variables and scales, by place."""
        emits = model.emits[self.seen]
        alpha, scale = np.empty_like(emits), np.empty(len(emits))
        before = None
        for t, n in enumerate(self.active):
            at = slice(self.starts[t], self.starts[t] + n)
            now = (before[:n] @ model.moves if t else model.start) * emits[at]
            total = now.sum(axis=1)
            now /= total[:, None]
            alpha[at], scale[at], before = now, total, now
        return emits, alpha, scale

    def log_likelihoods(self, model: Model) -> np.ndarray:
        """log10 of each sequence's probability, in the order given."""
        scale = self.forward(model)[2]
        found = np.empty(len(self.order))
        found[self.order] = np.bincount(self.row, np.log10(scale), len(self.order))
        return found

    def expected(self, model: Model, begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves, and class emissions of all sequences. Only
        those with ``begins`` start a text (all, without it); the others go on."""
        emits, alpha, scale = self.forward(model)
        states = len(model.start)
        beta = np.ones_like(emits)
        back = model.moves.T.copy()
        for t in range(len(self.active) - 2, -1, -1):
            n, at = self.active[t + 1], self.starts[t + 1]
            ahead = emits[at : at + n] * beta[at : at + n]
            ahead /= scale[at : at + n, None]
            beta[self.starts[t] : self.starts[t] + n] = ahead @ back
        gamma = alpha * beta
        first = self.active[0]
        step = np.repeat(np.arange(len(self.active)), self.active)[first:]
        earlier = self.starts[step - 1] + self.row[first:]
        moves = alpha[earlier].T @ (emits[first:] * beta[first:] / scale[first:, None]) * model.moves
        emitted = np.stack(
            [np.bincount(self.seen, gamma[:, k], len(model.emits)) for k in range(states)], axis=1
        )
        start = gamma[:first] if begins is None else gamma[:first][np.asarray(begins)[self.order]]
        return start.sum(axis=0), moves, emitted


def chunked(sequences: list[np.ndarray], tokens: int = CHUNK) -> Iterator[list[int]]:
    """Numbers of sequences, of like length together, about ``tokens`` at a time."""
    some, size = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        some.append(i)
        size += len(sequences[i])
        if size >= tokens:
            yield some
            some, size = [], 0
    if some:
        yield some


def first_model(rates: np.ndarray, states: int = STATES) -> Model:
    """States that keep to themselves and prefer different classes slightly."""
    tilt = np.random.default_rng(7).uniform(0.5, 1.5, (len(rates), states)) * rates[:, None]
    moves = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(moves, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), moves, tilt / tilt.sum(axis=0))


def improved(start: np.ndarray, moves: np.ndarray, emitted: np.ndarray, rates: np.ndarray) -> Model:
    emits = emitted + SMOOTHING * rates[:, None]
    moves = moves + 1.0
    start = start + 1.0
    return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def train(sequences: DataFrame, rates: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over a column ``sequence`` of packed classes."""
    names = [f"s{k}" for k in range(states)]
    model = first_model(rates, states)
    for _ in range(rounds):
        # Plain arrays: executors need not have this module to read a broadcast.
        shared = sequences.sparkSession.sparkContext.broadcast((model.start, model.moves, model.emits))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now, sums = Model(*shared.value), None
            for batch in batches:
                texts = [np.frombuffer(s, np.uint16) for s in batch.column("sequence").to_pylist()]
                cut = [x[i : i + SEGMENT] for x in texts for i in range(0, len(x), SEGMENT)]
                begins = np.array([i == 0 for x in texts for i in range(0, len(x), SEGMENT)])
                for some in chunked(cut):
                    found = Lattice([cut[i] for i in some]).expected(now, begins[some])
                    sums = found if sums is None else tuple(a + b for a, b in zip(sums, found, strict=True))
            if sums is not None:
                table = np.concatenate([sums[0][None, :], sums[1], sums[2]])
                some = np.nonzero(table.sum(axis=1))[0]
                columns = [pa.array(some, pa.int32()), *[pa.array(table[some, k]) for k in range(len(names))]]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *names])

        counts = sequences.mapInArrow(run, T.StructType([T.StructField("row", T.IntegerType()), *[T.StructField(n, T.DoubleType()) for n in names]]))
        # One row per class, start and state: a bounded table.
        found = counts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
        table = np.zeros((1 + states + len(rates), states))
        table[found["row"].to_numpy(np.int64)] = found[names].to_numpy()
        model = improved(table[0], table[1 : 1 + states], table[1 + states :], rates)
        shared.destroy()
    return model


def score(docs: DataFrame, held_out: str, key: str = "doc_id", text: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: the key, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10), learnt from the rows where the boolean column
    ``held_out`` is false.

    Null and empty texts have one token, the end. Rows with a null ``held_out``
    are training rows. Without training rows every score is that of a uniform
    unknown. Repeated rows are scored, and learnt from, each time. Texts of any
    length are scored whole. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("doc"),
        F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    counts = stage(word_counts(rows.where("not held_out").select("text")), "counts")
    known = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = known["n"] or 0, known["v"]
    head = _head(counts, HEAD) or [(END, 0)]
    numbers = {w: i for i, (w, _) in enumerate(head)}
    by_ending = counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    n_words, n_distinct = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in by_ending:
        n_words[r["ending"]], n_distinct[r["ending"]] = r["c"], r["v"]
    for word, c in head:
        n_words[ending(word)] -= c
        n_distinct[ending(word)] -= c > 0
    class_counts = np.concatenate([[c for _, c in head], n_words])
    rates = (class_counts + 1) / (class_counts.sum() + len(class_counts))
    classes = spark.sparkContext.broadcast(numbers)

    sequences = _sequences(rows, classes).withColumn("uid", F.monotonically_increasing_id())
    sequences = stage(sequences, "sequences")
    training = sequences.where("not held_out").select("sequence")
    model = train(training, rates, states, rounds if total else 0)

    # Rare words: their counts, joined by word, and their share of their class.
    sizes = F.create_map(*[F.lit(x) for i in range(ENDINGS) for x in (i, float(n_words[i] + n_distinct[i] + 1))])
    rare = sequences.select("uid", F.explode(F.arrays_zip("rare", "often")).alias("r")).select(
        "uid", F.col("r.rare").alias("word"), F.col("r.often").alias("n")
    )
    rare = rare.join(counts.select("word", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    group = (F.crc32(F.substring("word", -3, 3)) % ENDINGS).cast("int")
    rare = rare.groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_base"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * (F.log10(F.col("c") + 1.0) - F.log10(sizes[group]))).alias("rare_share"),
    )

    shared = spark.sparkContext.broadcast((model.start, model.moves, model.emits))
    weights = np.concatenate([np.log10([c + 1 for _, c in head]), np.zeros(ENDINGS)])
    is_known = np.concatenate([[float(c > 0) for _, c in head], np.zeros(ENDINGS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Model(*shared.value)
        for batch in batches:
            texts = [np.frombuffer(s, np.uint16) for s in batch.column("sequence").to_pylist()]
            found = np.zeros(len(texts))
            for some in chunked(texts):
                found[some] = Lattice([texts[i] for i in some]).log_likelihoods(now)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid"),
                    batch.column("doc"),
                    batch.column("held_out"),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([int(is_known[x].sum()) for x in texts], pa.int64()),
                    pa.array([float(weights[x].sum()) for x in texts], pa.float64()),
                    pa.array(found, pa.float64()),
                ],
                names=["uid", "doc", "held_out", "n_tokens", "head_known", "head_base", "path"],
            )

    schema = "uid long, doc long, held_out boolean, n_tokens long, head_known long, head_base double, path double"
    scored = sequences.select("uid", "doc", "held_out", "sequence").mapInArrow(run, schema).join(rare, "uid", "left")
    unit = math.log10(total + distinct + 1)
    return scored.select(
        F.col("doc").alias(key),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("path") + F.coalesce("rare_share", F.lit(0.0))).alias("score"),
    )
