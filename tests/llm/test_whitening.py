"""Whitening against numpy's eigenpairs, and the edge cases of the docstring."""

import numpy as np
import pytest

from siftframe.llm import queries, whitening
from siftframe.llm.whitening import Spectrum, rank_one

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def expected(vectors, k=16):
    x = np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = fitted - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, (x - sums / n) @ basis / np.sqrt(values), values / (centred**2).sum() * n


def compare(rows, ids, vectors, k):
    n, deviation, white, explained = expected(vectors, k)
    found = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(found) == len(rows) == len(ids) * k
    for j in range(k):
        mine = np.array([found[i, j + 1]["whitened"] for i in ids])
        side = 1 if mine @ white[:, j] > 0 else -1
        assert np.allclose(side * mine, white[:, j], atol=1e-8)
    for i, d in zip(ids, deviation, strict=True):
        assert {(found[i, j]["n"], found[i, j]["deviation"]) for j in range(1, k + 1)} == {(n, d)}
    for j in range(k):
        assert abs(found[ids[0], j + 1]["explained"] / explained[j] - 1) < 1e-9
    assert all(r["identity_error"] < 1e-9 for r in rows)


def test_the_whole_table_equals_numpy(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    compare(queries.op12_whitening(spark, folder).collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table], 16)


def test_odd_rows_copies_and_many_partitions(spark):
    draw = np.random.default_rng(5)
    good = (draw.standard_normal((60, 4)) * [8, 4, 2, 1]).astype(np.float32).tolist()
    rows = [(i, v, "x", "y") for i, v in enumerate(good)] + [(100 + i, good[0], "x", "y") for i in range(30)]
    odd = [None, [], [1.0, None, 1.0, 1.0], [float("inf")] * 4, [1.0] * 3, [1e30] * 4]
    table = spark.createDataFrame(rows + [(200 + i, v, "", "") for i, v in enumerate(odd)], SCHEMA).repartition(40)
    found = whitening.whitened(table)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(found.collect(), [r[0] for r in rows], [r[1] for r in rows], 4)


def test_no_variance_gives_no_rows(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], "", ""), (2, [1.0, 2.0], "", "")], SCHEMA)
    assert whitening.whitened(same).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 7.0], "", "") for i in range(5)] + [(None, [9.0, 7.0], "", "")], SCHEMA)
    assert sorted(r["component"] for r in whitening.whitened(flat).collect()) == [1] * 6


def test_deviation_is_exact_or_null(spark):
    rows = [(0, [0.0], "", ""), (1, [float(1 << 33)], "", ""), (2, [float(1 << 20)], "", "")]
    found = {r["vec_id"]: r["deviation"] for r in whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = [0, 64 << 33, 64 << 20]
    for i, v in enumerate(x):
        exact = (3 * v - sum(x)) ** 2
        assert found[i] == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("dim", [1, 2, 7, 20])
@pytest.mark.parametrize("kind", ["plain", "scaled", "ties", "flat"])
def test_updates_keep_eigenpairs(dim, kind):
    draw = np.random.default_rng(dim)
    points = draw.standard_normal((150, dim))
    if kind == "scaled":
        points *= 10.0 ** draw.integers(-4, 5, dim)
    if kind == "ties":
        points = np.repeat(np.eye(dim), 20, axis=0)
    if kind == "flat":
        points[:, : dim // 2] = 3.0
    one, two = Spectrum.empty(dim), Spectrum.empty(dim)
    for block in np.array_split(points[: len(points) // 3], 4):
        one.see(block)
    for block in np.array_split(points[len(points) // 3 :], 3):
        two.see(block)
    one.merge(Spectrum.unpacked(two.packed(), dim))
    centred = points - points.mean(axis=0)
    scatter = centred.T @ centred
    most = np.abs(scatter).max() + 1e-300
    assert one.n == len(points) and np.allclose(one.mean, points.mean(axis=0))
    assert np.abs(one.vectors @ np.diag(one.values) @ one.vectors.T - scatter).max() < 1e-12 * most
    assert np.abs(one.vectors.T @ one.vectors - np.eye(dim)).max() < 1e-12


def test_update_by_nothing_changes_nothing():
    values, vectors = rank_one(np.array([1.0, 2.0]), np.eye(2), np.zeros(2))
    assert values.tolist() == [1.0, 2.0] and (vectors == np.eye(2)).all()
