"""Hard negatives of anchors, by score bounds along spanning trees of anchors.

Anchors are dealt to chunks of similar ones, and a minimum spanning tree is
laid through each chunk. Candidates pass the tree from its root: a score at the
parent, plus or minus the length of the edge times the candidate's norm, bounds
the score at the child. Only candidates whose bounds reach what the child still
looks for are scored again, all others hand their bounds on.

Candidates are never shuffled: chunks of anchors, up to ``ROUND_BYTES`` at a
time, go to all tasks, and what leaves a task is a short list per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftframe.session import stage

CHUNK = 512  # anchors of a tree at most
ROUND_BYTES = 16 << 20  # anchors that go to all tasks at once
SLICE = 1 << 20  # numbers of a block of candidates
LARGEST = float(1 << 27)  # a greater component counts as not finite: scores stay whole numbers in a long


def _rows(table: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """(id, label, v): rows that take part, with whole-number components."""
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST))
    part = F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite & (F.size(vector) > 0), F.lit(False))
    return table.where(part).select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of the vectors ``v``, in slices."""
    values = batch.column("v")
    sizes = pa.compute.list_value_length(values).to_numpy(zero_copy_only=False)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for dim in np.unique(sizes):
        rows = np.nonzero(sizes == dim)[0]
        for at in range(0, len(rows), max(1, SLICE // int(dim))):
            some = rows[at : at + max(1, SLICE // int(dim))]
            yield some, flat[(ends[some] - dim)[:, None] + np.arange(dim)]


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree by Euclidean distance:
    the points from the root on, the place of each one's parent in that order
    (-1 for the root) and the length of the edge to it."""
    n = len(points)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    nearest, place = np.full(n, np.inf), np.full(n, -1, np.int64)
    left = np.ones(n, bool)
    now = 0
    for i in range(n):
        order[i], parent[i], edge[i] = now, place[now], 0.0 if i == 0 else nearest[now]
        left[now] = False
        far = np.sqrt(((points - points[now]) ** 2).sum(axis=1))
        closer = left & (far < nearest)
        nearest[closer], place[closer] = far[closer], i
        if i + 1 < n:
            now = int(np.where(left, nearest, np.inf).argmin())
    return order, parent, edge


_TREES = "dim int, ids binary, labels binary, points binary, parent binary, edge binary"


def _trees(anchors: DataFrame) -> DataFrame:
    """One row per chunk of up to ``CHUNK`` anchors, in the order of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def chunk(dim: int) -> pa.RecordBatch:
            ids, labels, points = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            order, parent, edge = spanning_tree(points)
            columns = [ids[order], labels[order], points[order], parent, edge]
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32())] + [pa.array([c.tobytes()], pa.binary()) for c in columns],
                names=["dim", "ids", "labels", "points", "parent", "edge"],
            )

        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            for rows, points in matrices(batch):
                dim = points.shape[1]
                for at in range(0, len(rows), CHUNK):
                    some = slice(at, at + CHUNK)
                    if dim in held and sum(len(h[0]) for h in held[dim]) + len(rows[some]) > CHUNK:
                        yield chunk(dim)
                    held.setdefault(dim, []).append((ids[rows[some]], labels[rows[some]], points[some]))
        for dim in list(held):
            yield chunk(dim)

    return anchors.mapInArrow(run, _TREES)


def scored(points: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers: through doubles where these are exact."""
    most = np.abs(points).max(initial=0) * np.abs(c).max(initial=0) * len(points)
    if most < 2**53:
        return np.rint(c @ points).astype(np.int64)
    return c.astype(np.int64) @ points.astype(np.int64)


class Tree:
    """The anchors of one chunk, unpacked."""

    def __init__(self, row: tuple) -> None:
        dim, ids, labels, points, parent, edge = row
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.points = np.frombuffer(points, np.float64).reshape(-1, dim)
        self.parent, self.edge = np.frombuffer(parent, np.int64).tolist(), np.frombuffer(edge, np.float64)
        self.dim = dim

    def walk(self, c: np.ndarray, ids: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, candidates, scores) from the root on. ``wanted(anchor, low,
        high)`` says which candidates may matter, by bounds of their scores;
        only these are scored at the anchor (at the root all are)."""
        norm = np.sqrt((c * c).sum(axis=1))
        low, high = np.empty((len(self.ids), len(c))), np.empty((len(self.ids), len(c)))
        for i, up in enumerate(self.parent):
            if up < 0:
                s = scored(self.points[i], c)
                low[i] = high[i] = s
                some = np.nonzero(wanted(i, low[i], high[i]) & (ids != self.ids[i]))[0]
                s = s[some]
            else:
                # Slack for the rounding of distances, norms and large scores.
                reach = self.edge[i] * norm * (1 + 1e-9) + 1e-9 * np.maximum(np.abs(low[up]), np.abs(high[up])) + 1
                low[i], high[i] = low[up] - reach, high[up] + reach
                some = np.nonzero(wanted(i, low[i], high[i]) & (ids != self.ids[i]))[0]
                s = scored(self.points[i], c[some])
                low[i, some] = high[i, some] = s
            if len(some):
                yield i, some, s


class Best:
    """The highest (score, then smallest id) of what was offered, ``k`` at most."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = -np.inf  # below this nothing enters

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(scores) > 4 * self.k:
            enough = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[enough], ids[enough]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = self.scores[-1]


def _positives(rows: DataFrame, chunks, k: int) -> DataFrame:
    """(chunk, anchor, id, score): each task's best ``k`` of an anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(row) for row in chunks.value]
        best = [[Best(k) for _ in t.ids] for t in trees]
        for batch in batches:
            all_ids, all_labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            for some, c in matrices(batch):
                ids, labels = all_ids[some], all_labels[some]
                for tree, mine in zip(trees, best, strict=True):
                    if tree.dim != c.shape[1]:
                        continue

                    def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                        return (labels == tree.labels[i]) & (high >= mine[i].least)  # noqa: B023

                    for i, found, s in tree.walk(c, ids, wanted):
                        mine[i].offer(s, ids[found])
        out = [(n, i, b.ids, b.scores) for n, mine in enumerate(best) for i, b in enumerate(mine) if len(b.ids)]
        if out:
            counts = [len(o[2]) for o in out]
            columns = [np.repeat([o[0] for o in out], counts), np.repeat([o[1] for o in out], counts)]
            columns += [np.concatenate([o[j] for o in out]) for j in (2, 3)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["chunk", "anchor", "id", "score"])

    return rows.mapInArrow(run, "chunk long, anchor long, id long, score long")


_FOUND = ["chunk", "anchor", "nth", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]


def _negatives(rows: DataFrame, chunks, positives, k: int, low_share: int, high_share: int) -> DataFrame:
    """Each task's best ``k`` negatives in the window of every positive.
    ``positives`` holds {anchor: [(id, score), ...]} for each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(row) for row in chunks.value]
        windows, best = [], []
        for mine in positives.value:
            windows.append({i: [(-(-low_share * s // 100), high_share * s // 100) for _, s in found] for i, found in mine.items()})
            best.append({i: [Best(k) for _ in found] for i, found in mine.items()})
        for batch in batches:
            all_ids, all_labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            for some, c in matrices(batch):
                ids, labels = all_ids[some], all_labels[some]
                for tree, spans, mine in zip(trees, windows, best, strict=True):
                    if tree.dim != c.shape[1]:
                        continue

                    def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                        hit = np.zeros(len(low), bool)
                        for (least, most), b in zip(spans.get(i, ()), mine.get(i, ()), strict=True):  # noqa: B023
                            if least <= most:
                                hit |= (high >= max(least, b.least)) & (low <= most)
                        return hit & (labels != tree.labels[i])  # noqa: B023

                    for i, found, s in tree.walk(c, ids, wanted):
                        for (least, most), b in zip(spans.get(i, ()), mine.get(i, ()), strict=True):
                            inside = (s >= max(least, b.least)) & (s <= most)
                            if inside.any():
                                b.offer(s[inside], ids[found[inside]])
        out: list[list] = [[] for _ in _FOUND]
        for n, (tree, mine) in enumerate(zip(trees, best, strict=True)):
            for i, lists in mine.items():
                for j, b in enumerate(lists):
                    pid, score = positives.value[n][i][j]
                    for nid, s in zip(b.ids.tolist(), b.scores.tolist(), strict=True):
                        for column, x in zip(out, (n, i, j, int(tree.ids[i]), pid, score, nid, s), strict=True):
                            column.append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=_FOUND)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in _FOUND))


def _first(found: DataFrame, by: list[str], score: str, key: str, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), key))
    return found.withColumn("rank", nth).where(F.col("rank") <= k)


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 1.0,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); scores are inner products with the
    anchor. An anchor's positives are the ``positives`` first rows of its label,
    its negatives under each positive the ``negatives`` first rows of another
    label whose score lies between ``window`` percent of the positive's score,
    edges included. Higher scores come first, ties by the smaller key. Scores
    are exact whole numbers, and no candidate is left out.

    Rows without a key, a label or a vector, with an empty vector or a null or
    non-finite component (or one of 2^27 and more after scaling) take no part.
    Rows with the anchor's own key are never its candidates. Repeated rows
    count each as candidates, and once as anchors. Only vectors of the anchor's
    length are met. Anchors without positives or negatives give no rows, nor
    does an empty table. Other columns of ``table`` are ignored.

    Every block of up to ``ROUND_BYTES`` of anchors scans the candidates twice.
    A task keeps lists of ``positives`` (then ``positives`` x ``negatives``)
    rows per anchor of the block, whatever the number of its candidates.
    """
    spark = table.sparkSession
    rows = _rows(table, key, vector, label, scale)
    anchors = stage(_rows(table.where(is_anchor), key, vector, label, scale).distinct(), "anchors")
    count = anchors.count()
    signs = F.aggregate(F.slice("v", 1, 24), F.lit(0), lambda total, x: total * 2 + (x > 0).cast("int"))
    near = anchors.repartitionByRange(-(-count // CHUNK) or 1, F.size("v"), signs, "id")
    trees = stage(_trees(near), "anchor-trees")
    found = []

    def one_round(block: list[tuple]) -> None:
        chunks = spark.sparkContext.broadcast(block)
        some = _first(_positives(rows, chunks, positives), ["chunk", "anchor"], "score", "id", positives)
        # At most ``positives`` rows per anchor of the block.
        mine: list[dict] = [{} for _ in block]
        for r in some.orderBy("chunk", "anchor", "rank").collect():
            mine[r["chunk"]].setdefault(r["anchor"], []).append((r["id"], r["score"]))
        given = spark.sparkContext.broadcast(mine)
        low, high = window
        best = _negatives(rows, chunks, given, negatives, low, high)
        best = _first(best, ["chunk", "anchor", "nth"], "negative_score", "negative_id", negatives)
        found.append(stage(best.drop("chunk", "anchor", "nth"), "negatives"))
        given.unpersist()
        chunks.unpersist()

    block: list[tuple] = []
    size = 0
    for row in trees.toLocalIterator():
        if block and size + len(row["points"]) > ROUND_BYTES:
            one_round(block)
            block, size = [], 0
        block.append(tuple(bytes(x) if isinstance(x, bytearray) else x for x in row))
        size += len(row["points"])
    if block or not found:
        one_round(block)
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    return result.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
