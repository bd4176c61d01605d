"""Mixing documents to target shares of tokens.

Iterative proportional fitting: the tokens of every combination of source,
language and topic are rescaled to one list of target shares after the other
until all hold at once; what results is an inclusion probability per
combination, by which documents are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import append_column, fold, fresh, pieces, texts_of, with_outputs
from siftframe.llm.hashing import Words
from siftframe.session import BROADCAST_ROWS, fits_broadcast, stage

TOPICS = 8
ROUNDS = 500
MOST_VALUES = 200  # values of a Target, at most; Smoothed has no limit
LOCAL_ROWS = 10_000  # values of a Smoothed up to which the driver fits; beyond, executors do
STAGED_ROUNDS = 20  # rounds that executors repeat at most before probabilities are written
OTHER = -1  # code of values without a target, and of null


@dataclass(frozen=True)
class Target:
    """Shares of tokens by value of one column. What they leave of 1 is for all
    other values together."""

    column: str
    shares: dict[str, float]

    def __post_init__(self) -> None:
        if len(self.shares) > MOST_VALUES:
            raise ValueError(f"{self.column}: more than {MOST_VALUES} targets")
        if any(s < 0 for s in self.shares.values()) or sum(self.shares.values()) > 1 + 1e-9:
            raise ValueError(f"{self.column}: shares must be 0 or more and sum to 1 at most")

    def code(self) -> Column:
        """The value's number; ``OTHER`` without one."""
        if not self.shares:
            return F.lit(OTHER)
        numbers = F.create_map(*[F.lit(x) for i, v in enumerate(self.shares) for x in (v, i)])
        return F.coalesce(F.try_element_at(numbers, F.col(self.column).cast("string")), F.lit(OTHER))

    def totals(self, tokens: float) -> dict[int, float]:
        found = {i: s * tokens for i, s in enumerate(self.shares.values())}
        return found | {OTHER: max(0.0, tokens - sum(found.values()))}


@dataclass(frozen=True)
class Smoothed:
    """A target for every value of one column, null too, in proportion to
    tokens^power; any number of values."""

    column: str
    power: float = 0.5


def _rescaled(p: np.ndarray, tokens: np.ndarray, at: np.ndarray, goals: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Cells rescaled to ``goals`` of their values ``at``, which hold ``held``."""
    factors = np.divide(goals, held, out=np.ones(len(goals)), where=held > 0)
    return np.minimum(1.0, p * factors[at])


def raked(codes: np.ndarray, tokens: np.ndarray, targets: list[Target], budget: float) -> np.ndarray:
    """Inclusion probabilities of cells (rows of ``codes``) such that the
    expected tokens meet every target, as far as the cells hold them: no
    probability exceeds 1, and a target without tokens is left unmet."""
    goals = [_goals(target, budget) for target in targets]
    return _fitted(codes + 1, tokens, goals, budget)


def _goals(target: Target, budget: float) -> np.ndarray:
    """Tokens of ``OTHER`` and of every value of ``target``."""
    totals = target.totals(budget)
    return np.array([totals[code] for code in range(OTHER, len(target.shares))])


def _fitted(at: np.ndarray, tokens: np.ndarray, goals: list[np.ndarray], budget: float) -> np.ndarray:
    p = np.full(len(tokens), min(1.0, budget / max(1.0, tokens.sum())))
    for _ in range(ROUNDS):
        before = p
        for d, goal in enumerate(goals):
            held = np.bincount(at[:, d], tokens * p, len(goal))
            p = _rescaled(p, tokens, at[:, d], goal, held)
        # Cells without tokens have no goal to settle at.
        if np.abs(p - before)[tokens > 0].max(initial=0.0) < 1e-10:
            break
    return p


@dataclass(frozen=True)
class _Rounds:
    """Cells in blocks, one per value of a ``Smoothed``: columns k (numbers of
    cells), n (tokens), p (probabilities) and goal. The value's own sums lie in
    its block; sums of the other dimensions are gathered from all blocks, a few
    numbers a time, and come back as ``steps``: (dimension, held)."""

    at: np.ndarray  # values of every cell number in every other dimension
    goals: list[np.ndarray]

    def advanced(self, batch: pa.RecordBatch, steps: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Cell numbers, tokens, probabilities after ``steps``, and how far the
        last whole round moved any of them (infinite if it is not among them)."""
        k, n, p = (pa.compute.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("k", "n", "p"))
        lengths = pa.compute.list_value_length(batch.column("k")).to_numpy(zero_copy_only=False)
        block = np.repeat(np.arange(len(lengths)), lengths)
        goal = batch.column("goal").to_numpy(zero_copy_only=False)
        before, moved = None, np.inf
        for d, held in steps:
            if d is None:
                moved = np.inf if before is None else np.abs(p - before)[n > 0].max(initial=0.0)
                before = p
                p = _rescaled(p, n, block, goal, np.bincount(block, n * p, len(goal)))
            else:
                p = _rescaled(p, n, self.at[k, d], self.goals[d], held)
        return k, n, p, moved

    def held(self, blocks: DataFrame, steps: list, d: int) -> tuple[np.ndarray, float]:
        size = len(self.goals[d])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, most = np.zeros(size), 0.0
            for batch in batches:
                k, n, p, moved = self.advanced(batch, steps)
                total += np.bincount(self.at[k, d], n * p, size)
                most = max(most, moved)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([most])], names=["held", "moved"])

        found = blocks.mapInArrow(run, "held array<double>, moved double").collect()
        return np.sum([r["held"] for r in found], axis=0), max(r["moved"] for r in found)

    def moved_on(self, blocks: DataFrame, steps: list) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = self.advanced(batch, steps)[2]
                lengths = pa.compute.list_value_length(batch.column("k")).to_numpy(zero_copy_only=False)
                ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(p, pa.float64()))
                yield append_column(batch, "p", lists).select(batch.schema.names)

        return stage(blocks.mapInArrow(run, blocks.schema), "rates")

    def fitted(self, blocks: DataFrame) -> DataFrame:
        steps: list = []
        for i in range(ROUNDS):
            ended = len(steps)
            steps.append((None, None))
            for d in range(len(self.goals)):
                held, moved = self.held(blocks, steps, d)
                if d == 0 and moved < 1e-10:
                    return self.moved_on(blocks, steps[:ended])
                steps.append((d, held))
            if i % STAGED_ROUNDS == STAGED_ROUNDS - 1:
                blocks, steps = self.moved_on(blocks, steps), []
        return self.moved_on(blocks, steps) if steps else blocks


def _rates(cells: DataFrame, targets: list[Target], power: float, share: float) -> DataFrame:
    """(value, k, p) of ``cells`` (value, k, n): the probabilities of all cells.
    Up to ``LOCAL_ROWS`` values the driver computes them, beyond it every
    executor those of its values, by the same steps."""
    at = np.array(list(product(*[range(len(t.shares) + 1) for t in targets])), np.int64)
    blocks = cells.groupBy("value").agg(F.sum("n").alias("whole"), F.sort_array(F.collect_list(F.struct("k", "n"))).alias("c"))
    smooth = F.when(F.col("whole") > 0, F.pow(F.col("whole").cast("double"), F.lit(power))).otherwise(0.0)
    blocks = blocks.select("value", F.col("c.k").alias("k"), F.col("c.n").cast("array<double>").alias("n"), "whole", smooth.alias("goal"))
    blocks = stage(blocks, "cells")
    sums = blocks.agg(F.sum("whole").alias("whole"), F.sum("goal").alias("goal")).first()
    whole = float(sums["whole"] or 0)
    budget = share * whole
    goals = [_goals(t, budget) for t in targets]
    scaled = F.col("goal") * F.lit(budget / (sums["goal"] or 1.0))
    start = F.lit(min(1.0, budget / max(1.0, whole)))
    blocks = blocks.select("value", "k", "n", scaled.alias("goal"), F.transform("n", lambda _: start).alias("p"))
    if fits_broadcast(blocks, LOCAL_ROWS):
        rows = sorted(blocks.select("value", "k", "n", "goal").collect(), key=lambda r: (r["value"] is not None, r["value"] or ""))
        own = np.repeat(np.arange(len(rows)), [len(r["k"]) for r in rows])
        k = np.array([x for r in rows for x in r["k"]], np.int64)
        n = np.array([x for r in rows for x in r["n"]], float)
        p = _fitted(np.column_stack([own, at[k]]), n, [np.array([r["goal"] for r in rows], float), *goals], budget)
        found = [(rows[i]["value"], int(c), float(x)) for i, c, x in zip(own, k, p, strict=True)]
        return cells.sparkSession.createDataFrame(found, "value string, k int, p double")
    done = _Rounds(at, goals).fitted(blocks)
    pairs = done.select("value", F.explode(F.arrays_zip("k", "p")).alias("c"))
    return pairs.select("value", "c.k", "c.p")


def mixed(
    docs: DataFrame,
    targets: list[Target],
    tokens: str,
    share: float,
    key: str = "doc_id",
    seed: int = 11,
    every: Smoothed | None = None,
) -> DataFrame:
    """A sample of ``docs`` with about ``share`` of all tokens (long column
    ``tokens``), dealt to the targets and to ``every`` value of a column of any
    number of values. Column ``probability`` is each row's chance of having been
    drawn.

    A row is drawn by a hash of its key: the same rows in every run, and rows
    that share a key stay or go together within a cell. Null keys are drawn by
    the hash of their other columns' text. Null values of a dimension count as
    values without a target; null tokens as none. An empty table stays empty.
    A column named probability is replaced.
    """
    p = fresh(docs)
    number = F.lit(0)
    for t in targets:
        number = number * (len(t.shares) + 1) + t.code() + 1
    value = F.col(f"`{every.column}`").cast("string") if every else F.lit(None).cast("string")
    coded = docs.withColumns({p + "k": number.cast("int"), p + "v": value})
    cells = coded.groupBy(F.col(p + "v").alias("value"), F.col(p + "k").alias("k"))
    cells = cells.agg(F.sum(F.coalesce(F.col(tokens), F.lit(0))).cast("long").alias("n"))
    if every:
        table = _rates(cells, targets, every.power, share)
    else:
        # At most the product of the target lists' lengths.
        rows = cells.collect()
        digits = np.array(list(product(*[range(OTHER, len(t.shares)) for t in targets])), np.int64)
        sizes = np.array([r["n"] for r in rows], float)
        chance = raked(digits[np.array([r["k"] for r in rows], np.int64)], sizes, targets, share * sizes.sum())
        found = [(None, r["k"], float(x)) for r, x in zip(rows, chance, strict=True)]
        table = docs.sparkSession.createDataFrame(found, "value string, k int, p double")
    table = table.toDF(p + "w", p + "c", p + "p")
    if not every or fits_broadcast(table, BROADCAST_ROWS):
        table = F.broadcast(table)
    found = coded.join(table, F.col(p + "v").eqNullSafe(F.col(p + "w")) & (F.col(p + "k") == F.col(p + "c")), "left")
    others = [F.col(f"`{c}`").cast("string") for c, kind in docs.dtypes if c != key and not kind.startswith(("map", "variant"))]
    drawn = F.coalesce(F.xxhash64(F.lit(seed), F.when(F.col(key).isNotNull(), F.col(key))), F.lit(0).cast("long"))
    drawn = F.when(F.col(key).isNotNull(), drawn).otherwise(F.xxhash64(F.lit(seed), *others))
    uniform = F.shiftrightunsigned(drawn, 11).cast("double") / float(1 << 53)
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "probability"]
    return found.where(uniform < F.col(p + "p")).select(*keep, F.col(p + "p").alias("probability"))


def smoothed(docs: DataFrame, column: str, tokens: str, power: float = 0.5) -> Target:
    """A target for each value, in proportion to tokens^power; null counts as
    one too. For at most ``MOST_VALUES`` values; ``Smoothed`` takes any number."""
    held = docs.groupBy(F.col(column).cast("string").alias("value")).agg(F.sum(tokens).alias("n"))
    found = held.where("n > 0").limit(MOST_VALUES + 2).collect()
    total = sum(r["n"] ** power for r in found)
    return Target(column, {r["value"]: r["n"] ** power / total for r in found if r["value"] is not None})


def beside_others(docs: DataFrame, target: Target, tokens: str) -> Target:
    """``target`` scaled so that values without a share of their own, and null,
    keep together the share of tokens that they have in ``docs``."""
    known = F.coalesce(F.col(f"`{target.column}`").cast("string").isin(list(target.shares)), F.lit(False))
    sums = docs.agg(F.sum(tokens).alias("whole"), F.sum(F.when(~known, F.col(tokens))).alias("others")).first()
    left = 1 - (sums["others"] or 0) / max(1, sums["whole"] or 0)
    return Target(target.column, {v: s * left for v, s in target.shares.items()})


def with_topics(docs: DataFrame, text: str = "text", tokens: str = "n_tokens", topic: str = "topic") -> DataFrame:
    """``docs`` with its number of words and a topic, written once.

    Topics are ``TOPICS`` groups of words by hash; a text's topic is the group
    it uses most beyond the corpus's own rate, measured in standard deviations
    over all documents. Texts without words have topic ``none``.
    """
    p = fresh(docs)
    outputs = [T.StructField(tokens, T.LongType(), False), T.StructField(p, T.ArrayType(T.LongType()), False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        for whole in batches:
            for batch in pieces(whole, text, 1 << 23):
                n, groups = [], []
                for one in texts_of(batch, text):
                    words = fold(one).split()
                    n.append(len(words))
                    groups.append(np.bincount((cache.hashes(words) >> np.uint64(40)).astype(np.int64) % TOPICS, minlength=TOPICS))
                batch = append_column(batch, tokens, pa.array(n, pa.int64()))
                yield append_column(batch, p, pa.array(groups, pa.list_(pa.int64())))

    counted = stage(docs.mapInArrow(run, with_outputs(docs.schema, outputs)), "topics")
    sums = counted.agg(*[F.sum(F.col(p)[i]).alias(str(i)) for i in range(TOPICS)]).first()
    total = max(1, sum(x or 0 for x in sums))
    beyond = []
    for i in range(TOPICS):
        rate = max((sums[i] or 0) / total, 1e-12)
        expected = F.col(tokens) * rate
        beyond.append(F.struct(((F.col(p)[i] - expected) / F.sqrt(expected)).alias("z"), F.lit(f"topic{i}").alias("name")))
    best = F.when(F.col(tokens) > 0, F.array_max(F.array(*beyond))["name"]).otherwise("none")
    keep = [F.col(f"`{c}`") for c in counted.columns if c.lower() != topic.lower() and c != p]
    return counted.select(*keep, best.alias(topic))
