"""Whitening of embeddings, by an incremental eigendecomposition.

Every partition keeps the eigenpairs of the scatter of the vectors it has seen.
A new vector changes them by a rank-one update: the new eigenvalues are the
roots of a secular equation, the eigenvectors follow from these, and pairs that
the update cannot move are deflated. Before that a batch's centred vectors are
turned into at most as many rows as they have components, with the same scatter
(the triangular factor of the batch): these rows, and one for the shift of the
mean, are the updates. Partitions' spectra are combined in the same way, a few
at a time: each eigenpair of one is a rank-one update of the other.

A last pass projects the covariance of all vectors on the basis found
(Rayleigh-Ritz) and turns the basis by the small eigenproblem that results, so
the pairs are those of the whole table to double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import fresh
from siftframe.session import stage

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000  # a component c becomes floor(SCALE * c) + OFFSET
AT_ONCE = 4096  # vectors turned into updates at once
TOGETHER = 16  # summaries combined by one task
LEAST = 1e-12  # share of the greatest eigenvalue below which there is no variance
LARGEST = float(1 << 40)  # a greater component counts as not finite


def secular_roots(values: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(values) + z z', ``values`` rising and distinct, no
    component of z zero; as (number of the nearest pole, distance from it), so
    that differences to poles keep their digits."""
    n = len(values)
    z2 = z * z
    lower = np.arange(n)
    width = np.append(np.diff(values), z2.sum())  # roots lie between the poles, the last one within the sum
    middle = 1 + (z2 / (values[None, :] - values[:, None] - width[:, None] / 2)).sum(axis=1)
    pole = np.where((middle < 0) & (lower < n - 1), lower + 1, lower)
    gaps = values[None, :] - values[pole][:, None]
    below, above = gaps[lower, lower], np.append(gaps[lower[:-1], lower[1:]], np.inf)
    low = np.where(pole > lower, -width / 2, np.where(middle < 0, width / 2, 0))
    high = np.where(pole > lower, 0, np.where(middle < 0, width, width / 2))
    x = (low + high) / 2
    left = np.tril(np.ones((n, n), bool))
    closed = np.isfinite(above)
    for _ in range(100):
        d = gaps - x[:, None]
        terms = z2 / d
        f = 1 + terms.sum(axis=1)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        slopes = terms / d
        # Near x, f is like c + s / (below - y) + t / (above - y), with its value and the slopes of both sides.
        a, b = below - x, np.where(closed, above - x, 1.0)
        s = np.where(left, slopes, 0).sum(axis=1) * a * a
        t = np.where(closed, np.where(left, 0, slopes).sum(axis=1) * b * b, 0)
        c = f - s / a - t / b
        p = c * (a + b) + s + t
        root = np.sqrt(np.maximum(p * p - 4 * c * a * b * f, 0))
        q = (p + np.where(p >= 0, root, -root)) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            one, two = x + q / c, x + a * b * f / q
            y = np.where((one > low) & (one < high), one, two)
            y = np.where(closed, y, x + f * a / c)
        y = np.where(np.isfinite(y) & (y > low) & (y < high), y, (low + high) / 2)
        noise = 4e-16 * (1 + np.abs(terms).sum(axis=1))
        still = (np.abs(y - x) > 4e-16 * np.abs(x)) & (np.abs(f) > noise)
        if not still.any():
            break
        x = np.where(still & (y != 0), y, x)
    return pole, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of (vectors diag(values) vectors') + v v'; values rise."""
    z = vectors.T @ v
    size = float(np.sqrt(z @ z))
    if size == 0:
        return values, vectors
    order = np.argsort(values, kind="stable")
    values, vectors, z = values[order].copy(), vectors[:, order].copy(), z[order].copy()
    scale = max(float(np.abs(values).max(initial=0)), size * size)
    tiny = 8e-16 * scale
    # Deflation, first kind: z has no part in this direction.
    live = np.abs(z) * size > tiny
    # Second kind: equal values; a rotation moves both parts of z to one of them.
    before = -1
    for i in np.nonzero(live)[0].tolist():
        if before >= 0:
            r = np.hypot(z[before], z[i])
            c, s = z[i] / r, z[before] / r
            if abs((values[i] - values[before]) * c * s) <= tiny:
                a, b = vectors[:, before].copy(), vectors[:, i].copy()
                vectors[:, before], vectors[:, i] = c * a - s * b, s * a + c * b
                u, w = values[before], values[i]
                values[before], values[i] = c * c * u + s * s * w, s * s * u + c * c * w
                z[before], z[i], live[before] = 0.0, r, False
        before = i
    at = np.nonzero(live)[0]
    at = at[np.argsort(values[at], kind="stable")]
    # Poles that rotations have left equal to the last digit are set apart by one.
    d, w = values[at].copy(), z[at]
    for i in np.nonzero(np.diff(d) <= 0)[0].tolist():
        d[i + 1] = np.nextafter(d[i], np.inf)
    pole, x = secular_roots(d, w)
    new = d[pole] + x
    # z as these roots have it (Gu and Eisenstat), which keeps vectors orthogonal.
    gap = (d[pole][None, :] - d[:, None]) + x[None, :]  # new value j minus pole i
    poles = d[None, :] - d[:, None]
    np.fill_diagonal(poles, 1.0)
    ratio = gap / poles
    # z_i^2 = prod_j (new_j - d_i) / prod_{j != i} (d_j - d_i), paired so that no product overflows.
    own = np.diag(gap).copy()
    np.fill_diagonal(ratio, 1.0)
    hat = np.sqrt(np.abs(ratio.prod(axis=1) * own)) * np.where(w < 0, -1.0, 1.0)
    turn = hat[:, None] / -gap
    turn /= np.linalg.norm(turn, axis=0)
    values[at] = new
    vectors[:, at] = vectors[:, at] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean and eigenpairs of the scatter of the vectors seen."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(dim: int) -> Spectrum:
        return Spectrum(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, n: int, mean: np.ndarray, updates: np.ndarray) -> None:
        """Take in ``n`` vectors with this mean, whose scatter about it is the
        sum of the squares of the rows of ``updates``."""
        if self.n and n:
            shift = (mean - self.mean) * np.sqrt(self.n * n / (self.n + n))
            self.values, self.vectors = rank_one(self.values, self.vectors, shift)
        for row in updates:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self.mean = self.mean + (mean - self.mean) * (n / max(1, self.n + n))
        self.n += n

    def see(self, points: np.ndarray) -> None:
        mean = points.mean(axis=0)
        centred = points - mean
        self.add(len(points), mean, np.linalg.qr(centred, mode="r") if len(points) > points.shape[1] else centred)

    def merge(self, other: Spectrum) -> None:
        live = other.values > 0
        self.add(other.n, other.mean, (other.vectors[:, live] * np.sqrt(other.values[live])).T)

    def packed(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @staticmethod
    def unpacked(data: bytes, dim: int) -> Spectrum:
        a = np.frombuffer(data)
        vectors = a[1 + 2 * dim :].reshape(dim, dim).copy()
        return Spectrum(int(a[0]), a[1 : 1 + dim].copy(), a[1 + dim : 1 + 2 * dim].copy(), vectors)


def _matrix(batch: pa.RecordBatch, dim: int, column: str = "v") -> Iterator[np.ndarray]:
    """Blocks of the batch's vectors as rows of doubles."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    for at in range(0, len(flat), AT_ONCE):
        yield flat[at : at + AT_ONCE].astype(np.float64)


def _combined(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes:
    """One summary out of those of all tasks (one row each), combined
    ``TOGETHER`` at a time; every level is written, so rounds are logarithmic
    and no task sees more than a few."""
    parts = stage(parts, "summaries")
    while (n := parts.count()) > TOGETHER:
        groups = -(-n // TOGETHER)
        dealt = parts.withColumn("g", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(groups)))

        def one(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"summary": [merge(group["summary"].tolist())]})

        parts = stage(dealt.groupBy("g").applyInPandas(one, "summary binary"), "summaries")
    return merge([bytes(r["summary"]) for r in parts.collect()])


def spectrum(points: DataFrame, dim: int) -> Spectrum:
    """Eigenpairs of the scatter of ``points`` (v: array<double>, all of ``dim``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Spectrum.empty(dim)
        for batch in batches:
            for block in _matrix(batch, dim):
                mine.see(block)
        if mine.n:
            yield pa.RecordBatch.from_arrays([pa.array([mine.packed()], pa.binary())], names=["summary"])

    def merge(found: list[bytes]) -> bytes:
        total = Spectrum.empty(dim)
        for data in found:
            total.merge(Spectrum.unpacked(bytes(data), dim))
        return total.packed()

    return Spectrum.unpacked(_combined(points.mapInArrow(run, "summary binary"), merge), dim)


def projected_covariance(points: DataFrame, n: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance (divisor ``n``) of ``points`` about ``mean``, in ``basis``."""
    dim, k = basis.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            for block in _matrix(batch, dim):
                y = (block - mean) @ basis
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["summary"])

    def merge(found: list[bytes]) -> bytes:
        return sum((np.frombuffer(bytes(x)) for x in found), np.zeros(k * k)).tobytes()

    return np.frombuffer(_combined(points.mapInArrow(run, "summary binary"), merge)).reshape(k, k) / max(1, n)


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: ``sums`` are those of the x-vectors (exact), ``mean``
    is that of x - OFFSET."""

    n: int
    sums: tuple[int, ...]
    mean: np.ndarray
    basis: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit(points: DataFrame, dim: int, components: int) -> Whitening:
    """``points``: distinct vectors v (long, without OFFSET), all of ``dim``."""
    sums = points.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
    totals = {r["i"]: int(r["s"]) for r in sums.collect()}  # one row per dimension
    n = points.count()
    if n == 0:
        return Whitening(0, (), np.zeros(dim), np.zeros((dim, 0)), np.zeros(0), 0.0, 0.0)
    whole = [totals[i] for i in range(dim)]
    mean = np.array([s // n + (s % n) / n for s in whole])
    doubles = points.select(F.col("v").cast("array<double>").alias("v"))
    basis = spectrum(doubles, dim).vectors[:, ::-1]
    small = projected_covariance(doubles, n, mean, basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, basis = values[::-1], np.linalg.qr(basis @ turn[:, ::-1])[0]
    trace = float(values.sum())
    k = int((values[:components] > LEAST * max(values[0], 0)).sum())
    values, basis = values[:k], basis[:, :k]
    error = 0.0
    if k:
        again = projected_covariance(doubles, n, mean, basis / np.sqrt(values))
        error = float(np.abs(again - np.eye(k)).max())
    return Whitening(n, tuple(s + n * OFFSET for s in whole), mean, basis, values, trace, error)


def whitened(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per row of ``table`` and component: the key, component (from 1, by
    falling variance), n (distinct vectors fitted), deviation (exact sum of
    (n x - S)^2 over the dimensions; null beyond a long), whitened, explained
    (share of the variance), identity_error (one value for the table).

    x is floor(64 c) + 1,000,000. Rows with a null or empty vector or a null or
    non-finite component (or one of 2^40 and more after scaling) are dropped, so
    are vectors of another length than the most frequent one (ties: the
    smaller). Repeated rows stay; equal x-vectors are fitted once. Components
    without variance cannot be whitened and give no rows: none come from an
    empty table or from one with a single distinct vector. Rows with a null key
    stay. Other columns of ``table`` are ignored. With equal eigenvalues the
    components are some orthonormal basis of their space.

    The basis, dim x dim doubles, is all that the driver holds and sends.
    """
    p = fresh([key])
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < LARGEST))
    rows = table.where(F.coalesce(finite & (F.size(vector) > 0), F.lit(False)))
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = rows.select(F.col(key).alias(p + "k"), v.alias("v"))
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    rows = rows.where(F.size("v") == dim)
    model = fit(stage(rows.select("v").distinct(), "vectors"), dim, components)
    key_type = table.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    # Plain values, not objects of this module, go to the tasks.
    n, k, mean, error = model.n, len(model.values), model.mean, model.identity_error
    shift = [s - model.n * OFFSET for s in model.sums]
    turned = model.basis / np.sqrt(model.values) if k else model.basis
    explained = model.values / model.trace if k else model.values
    safe = int((2**62 // max(1, dim)) ** 0.5)  # an entry of n x - S below this cannot overflow a sum

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k:
                return
            for at in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(at, AT_ONCE)
                x = some.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                y = (x - mean) @ turned
                if n * (int(np.abs(x).max()) + 1) + max(map(abs, shift)) < safe:
                    d = n * x - np.array(shift, np.int64)
                    deviation = pa.array((d * d).sum(axis=1), pa.int64())
                else:
                    exact = [sum((n * a - s) ** 2 for a, s in zip(row, shift, strict=True)) for row in x.tolist()]
                    deviation = pa.array([e if e < 2**63 else None for e in exact], pa.int64())
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(p + "k").take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(rows), n), pa.int64()),
                        deviation.take(pa.array(rows)),
                        pa.array(y.ravel(), pa.float64()),
                        pa.array(np.tile(explained, len(x)), pa.float64()),
                        pa.array(np.full(len(rows), error), pa.float64()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
