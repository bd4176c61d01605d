"""Links of near vectors: recall of the filters at several table sizes, and all
links of a table against brute force."""

import numpy as np
import pytest

from siftframe.llm import vectors


def near_pair(draw, cosine, dim=64):
    a, b = draw.standard_normal((2, dim))
    a /= np.linalg.norm(a)
    b -= a * (a @ b)
    b /= np.linalg.norm(b)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


@pytest.mark.parametrize(("n", "pairs", "most"), [(10**5, 1500, 0.003), (10**6, 700, 0.012), (10**8, 250, 0.04)])
def test_one_code_rarely_misses_and_all_never_do(n, pairs, most):
    draw = np.random.default_rng(n)
    code = vectors.Code.sized(64, n)
    tables = [code.tables(i) for i in range(vectors.CODES)]
    alone = together = filters = 0
    for _ in range(pairs):
        a, b = (code.filters(v, tables) for v in near_pair(draw, 0.951))
        shared = set((np.intersect1d(a, b) // code.words**vectors.BLOCKS).tolist())
        alone += vectors.CODES - len(shared)
        together += not shared
        filters += len(a)
    assert together == 0 and alone / (pairs * vectors.CODES) <= most
    assert 3 * vectors.LEAST_CAPS <= filters / pairs <= 80  # about as many at every size


def test_all_links_of_a_larger_table(spark):
    draw = np.random.default_rng(2)
    rows = []
    for i in range(700):
        a, b = near_pair(draw, float(draw.uniform(0.94, 0.96)), 24)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (3 * b).tolist())]
    rows += [(10_000 + i, rows[0][1]) for i in range(5)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, n_links string, rep int")
    units = np.array([r[1] for r in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links = (units @ units.T >= 0.95).sum(axis=1) - 1
    found = {r["vec_id"]: r for r in vectors.near_copies(table.repartition(4)).collect()}
    assert [found[r[0]]["n_links"] for r in rows] == links.tolist()
    assert found[10_004]["component_id"] == 0 and not found[10_004]["kept"]
    assert vectors.near_copies(table.where("false")).count() == 0
