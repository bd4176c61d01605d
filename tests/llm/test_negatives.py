"""Hard negatives against brute force, and the edge cases of the docstring."""

import numpy as np
from pyspark.sql import functions as F

from siftframe.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def brute(rows, every, scale, positives=5, few=3, window=(50, 95)):
    ok = [r for r in rows if None not in r[:3] and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1])]
    ok = [(r[0], np.floor(scale * np.array(r[1], np.float32).astype(np.float64)).astype(np.int64), r[2]) for r in ok]
    anchors = {(i, tuple(v.tolist()), lab) for i, v, lab in ok if i % every == 0}
    out = []
    for i, point, lab in anchors:
        rest = [(-int(v @ np.array(point)), j, other) for j, v, other in ok if j != i and len(v) == len(point)]
        rest.sort()
        for s, j, other in [x for x in rest if x[2] == lab][:positives]:
            fit = [x for x in rest if x[2] != lab and window[0] * -s <= 100 * -x[0] <= window[1] * -s][:few]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)


def test_equal_to_brute_force_with_ties_repeats_and_odd_rows(spark, monkeypatch):
    draw = np.random.default_rng(3)
    centres = draw.standard_normal((4, 6))
    rows = []
    for i in range(600):
        v = centres[i % 4] + 0.4 * draw.standard_normal(6)
        rows.append((i, np.round(v, 1).tolist(), int(draw.integers(0, 3)), "x", "y"))
    rows += [rows[10], rows[20], rows[21]]  # repeats, an anchor too
    rows += [(20, rows[5][1], 2, None, None)]  # an anchor's id with another vector
    rows += [(1000, None, 1, "", ""), (1010, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "", ""), (1020, [float("nan")] * 6, 1, "", "")]
    rows += [(1030, [], 1, "", ""), (None, [1.0] * 6, 1, "", ""), (1040, [1.0] * 6, None, "", ""), (1050, [0.0] * 6, 1, "", "")]
    rows += [(1060 + i, [float(i), 1.0], i % 2, "", "") for i in range(30)]  # another length
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(negatives, "CHUNK", 16)
    monkeypatch.setattr(negatives, "ROUND_BYTES", 2000)  # several rounds
    found = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, scale=16.0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 10, 16.0)


def test_empty_table_and_lonely_anchors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    lonely = spark.createDataFrame([(0, [1.0], 1, "", ""), (1, [1.0], 2, "", "")], SCHEMA)
    assert negatives.hard_negatives(lonely, F.col("vec_id") % 10 == 0).count() == 0


def test_spanning_tree_is_minimal_and_large_scores_are_exact():
    points = np.random.default_rng(0).standard_normal((60, 3))
    order, parent, edge = negatives.spanning_tree(points)
    assert sorted(order.tolist()) == list(range(60)) and parent[0] == -1 and all(parent[i] < i for i in range(60))
    gaps = np.linalg.norm(points[:, None] - points[None], axis=2)
    assert np.allclose(edge[1:], [gaps[order[i], order[parent[i]]] for i in range(1, 60)])
    joined, total = {0}, 0.0  # Prim, without the arrays
    while len(joined) < 60:
        least, j = min((gaps[a, b], b) for a in joined for b in range(60) if b not in joined)
        joined.add(j)
        total += least
    assert np.isclose(edge.sum(), total)
    big = np.array([2.0**27 - 1, 3.0])
    assert negatives.scored(big, big[None, :]).tolist() == [(2**27 - 1) ** 2 + 9]


def test_bounds_spare_candidates(spark):
    """Along a tree of near anchors few candidates are scored again."""
    draw = np.random.default_rng(1)
    point = draw.standard_normal(8) * 100
    points = np.round(point + draw.standard_normal((40, 8)))
    order, parent, edge = negatives.spanning_tree(points)
    tree = negatives.Tree((8, np.arange(40).tobytes(), np.zeros(40, np.int64).tobytes(), points[order].tobytes(), parent.tobytes(), edge.tobytes()))
    c = np.round(draw.standard_normal((2000, 8)) * 100)
    exact = c @ points[order].T
    least = np.sort(exact, axis=0)[-5]
    again = 0
    for i, some, s in tree.walk(c, np.full(2000, -1), lambda i, low, high: high >= least[i]):
        assert (s == exact[some, i]).all() and set(np.nonzero(exact[:, i] >= least[i])[0]) <= set(some.tolist())
        again += len(some)
    assert again < 40 * 2000 * 0.1
