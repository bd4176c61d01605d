"""Toxic passages as maximum-scoring segments.

Tokens score by the log-odds of toxic against clean training text, smoothed by
a Dirichlet prior at the corpus's own rates. One linear pass over a text finds
all maximal segments; because scores are log-likelihood ratios, a segment's
significance follows extreme-value statistics: in n tokens of clean text,
segments of score S or more are expected ``K n exp(-lambda S)`` times. A
document's evidence is what its significant segments exceed that by, put on a
0 to 1 scale by a logistic curve fitted on documents whose words were held out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import append_column, fold, fresh, pieces, texts_of, with_outputs
from siftframe.session import stage

# Labelled documents of each class a model is fitted on at most, chosen by hash.
MOST_LABELLED = 10_000
PRIOR = 10.0  # pseudo-documents per word of the Dirichlet prior, dealt to the classes by size
RATIO = 4.0  # words at least so many times likelier in toxic text have a score of their own
EVIDENCE = 20.0  # and at least this likelihood-ratio statistic (about p < 1e-5)
CERTAIN = 12.0  # evidence (natural log) beyond which more says nothing new
EDGES = b".,;:!?\"'()[]{}<>*_-"
THRESHOLD = 0.7
PIECE = 1 << 22  # bytes of text handled at a time


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words without punctuation at their ends."""
    return [w.strip(EDGES) for w in fold(text).split()]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time: each
    candidate remembers the nearest earlier one that starts from a lower sum."""
    found: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, start, end, earlier
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        left, start, total = total, i, total + s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= total:
                found.append((left, total, start, i + 1, j))
                break
            left, start = found[j][0], found[j][2]
            del found[j:]
    return [(start, end, right - left) for left, right, start, end, _ in found]


@dataclass(frozen=True)
class Model:
    """Word scores, the score of all other words, and the calibration."""

    scores: dict[bytes, float]
    other: float
    scale: float = 1.0  # lambda
    density: float = 1.0  # K
    slope: float = 1.0
    offset: float = 0.0

    def segments(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        known = self.scores
        scores = [known.get(w, self.other) for w in words]
        return maximal_segments(scores)

    def bits(self, score: float, n: int) -> float:
        """How far a segment exceeds what n clean tokens hold by chance."""
        return self.scale * score - math.log(self.density * n + 1)

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        each = [self.bits(s, n) for _, _, s in found]
        significant = [b for b in each if b > 0]
        total = sum(significant) if significant else max(each, default=-math.log(self.density * n + 1))
        return min(total, CERTAIN)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * evidence + self.offset))))


def _plain(model: Model) -> tuple:
    """The fields of ``model``: executors need not have this module to read them."""
    return model.scores, model.other, model.scale, model.density, model.slope, model.offset


def _log_odds(
    rows: list[tuple[bytes, int, int]], toxic: int, clean: int, odds: float = 1.0
) -> tuple[dict[bytes, float], float]:
    """Scores of (word, toxic documents, clean documents), and of all other
    words: the log-odds of the mass that remains. A toxic document stands for
    ``odds`` times as many labelled ones as a clean document: the prior follows
    their true share. Whether a word's counts are chance is asked of the
    documents counted, so by their share."""
    share = toxic * odds / max(1, toxic * odds + clean)
    counted = toxic / max(1, toxic + clean)
    spent = [0.0, 0.0]
    scores = {}
    for word, t, c in rows:
        p = (t + PRIOR * share) / (toxic + PRIOR * share)
        q = (c + PRIOR * (1 - share)) / (clean + PRIOR * (1 - share))
        if p < RATIO * q or _surprise(t, c, counted) < EVIDENCE:
            continue
        scores[word] = math.log(p / q)
        spent[0] += p
        spent[1] += q
    other = math.log(max(1e-3, 1 - spent[0]) / max(1e-3, 1 - spent[1]))
    return scores, min(other, -1e-3)


def _surprise(t: int, c: int, share: float) -> float:
    """Likelihood-ratio statistic of t toxic among t + c documents against ``share``."""
    found = 0.0
    for k, expected in ((t, (t + c) * share), (c, (t + c) * (1 - share))):
        found += 2 * k * math.log(k / expected) if k else 0.0
    return found


def _scale(rows: list[tuple[bytes, int, int]], scores: dict[bytes, float], other: float, clean: int) -> float:
    """Lambda: the positive root of sum p exp(lambda s) = 1 over clean text."""
    s = np.array([scores.get(w, other) for w, _, _ in rows] + [other])
    p = np.array([c for _, _, c in rows] + [0], float)
    p[-1] = max(1.0, clean - p.sum())
    p += 1e-3
    p /= p.sum()
    if not (s > 0).any() or (p * s).sum() >= 0:
        return 1.0
    low, high = 1e-3, 1.0
    while (p * np.exp(high * s)).sum() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(middle * s)).sum() < 1 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, with a light ridge;
    a row counts ``weights`` times."""
    w = np.array([0.1, 0.0])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weights * (p - y)) + np.array([1e-2, 1e-3]) * w
        curve = design.T @ (design * (weights * p * (1 - p))[:, None]) + np.diag([1e-2, 1e-3])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def _counted(sample: DataFrame) -> DataFrame:
    """(half, toxic, word, n): documents with the word; word '' has the sum of
    all. Documents, not tokens: a word that one text repeats is one finding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                n: Counter = Counter()
                keys = zip(batch.column("half").to_pylist(), batch.column("toxic").to_pylist(), strict=True)
                for text, key in zip(texts_of(batch, "text"), keys, strict=True):
                    found = set(tokens(text))
                    n[key, b""] += len(found)
                    n.update((key, word) for word in found if word)
                rows = list(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0][0] for r in rows], pa.int32()),
                        pa.array([r[0][1] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.binary()),
                        pa.array([n[r] for r in rows], pa.int64()),
                    ],
                    names=["half", "toxic", "word", "n"],
                )

    counts = sample.mapInArrow(run, "half int, toxic int, word binary, n long")
    return counts.groupBy("half", "toxic", "word").agg(F.sum("n").alias("n"))


def _sketched(docs: DataFrame) -> DataFrame:
    """Near copies mostly share ``sketch``, the least hash of five-word windows:
    a passage that circulates must not teach its every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                least = []
                for text in texts_of(batch, "text"):
                    words = tokens(text)
                    windows = (b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
                    least.append(min(map(xxhash.xxh64_intdigest, windows)) >> 1)
                yield append_column(batch, "sketch", pa.array(least, pa.int64()))

    return docs.mapInArrow(run, with_outputs(docs.schema, [T.StructField("sketch", T.LongType(), False)]))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labelled documents. Rows with a null key or label are left
    out; a document with both labels counts as toxic. ``MOST_LABELLED`` of each
    class are used at most, and each counts for all those of its class that it
    stands for, so that scores follow the true share of toxic labels. Near
    copies with one sketch count once, by the smallest key; rows with the same
    key and text are one. Without both classes every text scores the same: the
    share of toxic labels, 0 without labels (or with an empty table)."""
    p = fresh(docs, labels)
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("toxic")).na.drop()
    known = known.groupBy("key").agg(F.max("toxic").alias("toxic"))
    labelled = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    weights = {t: max(1.0, labelled.get(t, 0) / MOST_LABELLED) for t in (0, 1)}
    order = [F.xxhash64("key"), F.col("key")]
    chosen = None
    for toxic in (0, 1):
        some = known.where(F.col("toxic") == toxic).orderBy(*order).limit(MOST_LABELLED)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most 2 x MOST_LABELLED keys: small enough for every executor.
    sample = docs.select(F.col(key).alias(p), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = sample.join(F.broadcast(chosen), F.col(p) == F.col("key"))
    sample = _sketched(sample.select("key", "toxic", "text"))
    # The row with the smallest key stays of those with one sketch, so the sample is the same each time.
    sample = sample.groupBy("toxic", "sketch").agg(F.min(F.struct("key", "text")).alias("row")).select("toxic", "row.*")
    half = F.pmod(F.xxhash64(F.lit("half"), "key"), F.lit(2)).cast("int")
    return _fitted(stage(sample.select("toxic", half.alias("half"), "text"), "sample"), weights)


def _telling(toxic: Column, clean: Column, all_toxic: int, all_clean: int, odds: float) -> Column:
    """What ``_log_odds`` asks of a word, as a condition on its counts."""
    share = all_toxic * odds / max(1, all_toxic * odds + all_clean)
    counted = all_toxic / max(1, all_toxic + all_clean)
    p = (toxic + PRIOR * share) / (all_toxic + PRIOR * share)
    q = (clean + PRIOR * (1 - share)) / (all_clean + PRIOR * (1 - share))
    both = toxic + clean
    surprise = F.lit(0.0)
    for k, part in ((toxic, counted), (clean, 1 - counted)):
        surprise += F.when(k > 0, 2 * k * F.log(k / (both * F.lit(max(part, 1e-12))))).otherwise(0.0)
    # A little slack: the scores themselves are decided by ``_log_odds``.
    return (p * (1 + 1e-9) >= RATIO * q) & (surprise * (1 + 1e-9) >= EVIDENCE)


def _fitted(sample: DataFrame, weights: dict[int, float]) -> Model:
    """``weights``: labelled documents of each class for one in ``sample``."""
    documents = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(documents) < 2:
        share = documents.get(1, 0) / max(1, sum(documents.values()))
        return Model({}, -1.0, slope=0.0, offset=math.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    counts = _counted(sample)
    sizes = {(r["half"], r["toxic"]): r["n"] for r in counts.where("word = X''").collect()}
    cells = [
        F.sum(F.when((F.col("half") == h) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"n{h}{t}")
        for h in (0, 1)
        for t in (0, 1)
    ]
    wide = counts.where("word <> X''").groupBy("word").agg(*cells)
    # Only words that separate the classes leave the executors, by one half's
    # counts or by both: each needs several documents of the bounded sample.
    odds = weights[1] / weights[0]
    tells = F.lit(False)
    for halves in ((0,), (1,), (0, 1)):
        toxic, clean = (sum((F.col(f"n{h}{t}") for h in halves), F.lit(0)) for t in (1, 0))
        tells |= _telling(toxic, clean, *(sum(sizes.get((h, t), 0) for h in halves) for t in (1, 0)), odds)
    wide = wide.where(tells).orderBy("word")
    rows = [(bytes(r["word"]), (r["n00"], r["n01"]), (r["n10"], r["n11"])) for r in wide.collect()]

    def model(halves: tuple[int, ...]) -> Model:
        used = [(w, sum(each[h][1] for h in halves), sum(each[h][0] for h in halves)) for w, *each in rows]
        toxic, clean = (sum(sizes.get((h, t), 0) for h in halves) for t in (1, 0))
        scores, other = _log_odds(used, toxic, clean, odds)
        return Model(scores, other, scale=_scale(used, scores, other, clean))

    # Each half is scored by the words of the other one.
    crossed = {0: _plain(model((1,))), 1: _plain(model((0,)))}
    shared = sample.sparkSession.sparkContext.broadcast(crossed)

    def scaled(whole: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[int], list[list[float]]]]:
        models = {half: Model(*m) for half, m in shared.value.items()}
        for batch in pieces(whole, "text", PIECE):
            n, found = [], []
            for text, half in zip(texts_of(batch, "text"), batch.column("half").to_pylist(), strict=True):
                words = tokens(text)
                n.append(len(words))
                found.append([models[half].scale * s for _, _, s in models[half].segments(words)])
            yield batch, n, found

    def greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, n, found in scaled(whole):
                best = [max(s, default=0.0) for s in found]
                columns = [batch.column("toxic"), pa.array(n, pa.int32()), pa.array(best, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["toxic", "n", "best"])

    # By chance n clean tokens hold n exp(-s) segments of score s or more, times the density.
    calm = sample.where("toxic = 0").mapInArrow(greatest, "toxic int, n int, best double")
    calm = calm.agg(F.count("*").alias("n"), F.sum(F.col("n") * F.exp(-F.least("best", F.lit(700.0)))).alias("expected")).first()
    density = calm["n"] / calm["expected"] if calm["expected"] else 1.0
    density = min(max(density, 1e-4), 1.0)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = Model({}, 0.0, scale=1.0, density=density)
        for whole in batches:
            for batch, n, found in scaled(whole):
                x = [plain.evidence([(0, 0, s) for s in each], k) for each, k in zip(found, n, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.float64())], names=["toxic", "x"])

    # Two numbers per document of the bounded sample.
    seen = sample.mapInArrow(evidence, "toxic int, x double").orderBy("toxic", "x").collect()
    x, y = np.array([r["x"] for r in seen]), np.array([r["toxic"] for r in seen], float)
    slope, offset = _logistic(x, y, np.where(y == 1, weights[1], weights[0]))
    final = model((0, 1))
    return Model(final.scores, final.other, final.scale, density, slope, offset)


PASSAGE = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("e_value", T.DoubleType()),
    ]
)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``passages``: the significant
    segments (e-value below 1) as word ranges with score and e-value.

    Null and empty texts score like any text without passages. Rows are scored
    one by one and whole; columns named score or passages are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_plain(model))
    outputs = [T.StructField("score", T.DoubleType(), False), T.StructField("passages", T.ArrayType(PASSAGE), False)]
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        positive = {w for w, s in m.scores.items() if s > 0}
        for whole in batches:
            for batch in pieces(whole, text, PIECE):
                scores, passages = [], []
                for one in texts_of(batch, text):
                    words = tokens(one)
                    found = [] if positive.isdisjoint(words) else m.segments(words)
                    scores.append(m.probability(m.evidence(found, len(words))))
                    marked = [(a, b, s, m.bits(s, len(words))) for a, b, s in found]
                    passages.append(
                        [{"start": a, "end": b, "score": s, "e_value": math.exp(-x)} for a, b, s, x in marked if x > 0]
                    )
                out = append_column(batch, "score", pa.array(scores, pa.float64()))
                yield append_column(out, "passages", pa.array(passages, kind))

    return docs.mapInArrow(run, with_outputs(docs.schema, outputs))
