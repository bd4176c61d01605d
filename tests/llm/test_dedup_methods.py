"""Near copies and repeated passages: the methods against slow versions, very
long texts, clashing columns, empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftframe.llm import minhash, substrings
from siftframe.llm.hashing import Words

DOCS = "doc_id long, text string"


def words(n, seed=0, size=400):
    return [f"w{k}" for k in np.random.default_rng(seed).integers(0, size, n)]


# --- repeated passages --------------------------------------------------------


def passages(n):
    one, two = words(60, 1), words(45, 2)
    rows = []
    for i in range(n):
        draw = np.random.default_rng(i)
        a, b = one[int(draw.integers(0, 20)) :], two[: int(draw.integers(13, 45))]
        rows.append((i, words(int(draw.integers(0, 30)), 100 + i, 3000) + a + words(5, 200 + i, 3000) + b))
    return rows


def test_factors_are_stretches_of_their_references(spark):
    rows = passages(40)
    by_id = dict(rows)
    found = substrings.without_repeats(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], DOCS).repartition(5)).collect()
    earlier, n = {}, 0
    for doc, w in rows:
        for i in range(len(w) - 12):
            earlier.setdefault(tuple(w[i : i + 13]), doc)
    for r in found:
        w, covered = by_id[r["doc_id"]], set()
        for f in r["factors"]:
            there = by_id[f["ref_doc"]]
            size = f["end"] - f["start"]
            assert f["ref_doc"] < r["doc_id"] and size >= 13
            assert w[f["start"] : f["end"]] == there[f["ref_start"] : f["ref_start"] + size]
            covered |= set(range(f["start"], f["end"]))
            n += 1
        slow = {i + o for i in range(len(w) - 12) if earlier[tuple(w[i : i + 13])] < r["doc_id"] for o in range(13)}
        assert covered == slow
    assert n >= 60


def test_a_factor_goes_on_while_its_reference_does():
    assert substrings.factors([(0, 5, 7, 10), (5, 4, 7, 15), (9, 3, 8, 40)]) == [(0, 21, 7, 10), (9, 24, 8, 40)]
    assert substrings.factors([(0, 5, 7, 10), (5, 4, 7, 16)]) == [(0, 17, 7, 10), (5, 21, 7, 16)]
    assert substrings.factors([(0, 1, 7, 0), (30, 1, 7, 30)]) == [(0, 13, 7, 0), (30, 43, 7, 30)]
    assert substrings.factors([]) == []


def test_a_gram_with_many_surroundings_and_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 1500)
    monkeypatch.setattr(substrings, "SETTLE", 3000)  # many batches
    gram = words(4, 9)
    rows = [(i, words(10, i, 9000) + gram + words(10, 500 + i, 9000)) for i in range(60)]
    rows += [(100 + i, list(rows[i][1])) for i in range(0, 60, 7)]
    rows.append((500, words(30_000, 77, 500) + rows[3][1] + words(10, 78)))
    table = spark.createDataFrame([(i, " ".join(w), "x") for i, w in rows], DOCS + ", factors string").repartition(4)
    found = {r["doc_id"]: r for r in substrings.without_repeats(table).collect()}
    for i in range(0, 60, 7):
        assert found[i]["n_removed"] == 0 and found[100 + i]["n_removed"] == 24
    assert found[500]["n_removed"] == 24 and found[500]["n_words"] == 30_034


# --- near copies --------------------------------------------------------------


def near_documents():
    rows = []
    for g in range(12):
        base = words(120 + 10 * g, g, 2000)
        for c in range(6):
            text = list(base)
            for at in np.random.default_rng(100 * g + c).integers(0, len(text), c):
                text[at] = f"changed{g}-{c}-{at}"
            rows.append((100 * g + c, " ".join(text)))
    rows += [(5000, " ".join(words(80, 999))), (5001, ""), (5002, None), (5003, "one two"), (5004, "One TWO"), (5005, rows[0][1])]
    return rows


def slow_classes(rows, idf):
    """Components of all pairs with a weighted Jaccard similarity of 0.8 or more."""
    cache, sets = Words(), {}
    for doc, text in rows:
        hashes, n = minhash.shingles(cache, (text or "").encode())
        if len(hashes):
            sets[doc] = (hashes, n * idf[minhash._counter(hashes)])
    parent = {doc: doc for doc, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and minhash.weighted_jaccard(sets[a], sets[b]) >= minhash.SIMILARITY - 1e-9:
                i, j = sorted((find(a), find(b)))
                parent[j] = i
    return {doc: find(doc) for doc in parent}


@pytest.mark.parametrize("split", [512, 3])
def test_classes_equal_those_of_all_pairs(spark, monkeypatch, split):
    monkeypatch.setattr(minhash, "SPLIT", split)
    rows = near_documents()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", kept string, node int").repartition(4)
    found = minhash.near_copies(table)
    assert found.columns == ["doc_id", "text", "node", "class_id", "kept"]
    idf = minhash.inverse_frequencies(table.where("text is not null").select("text"))
    want = slow_classes(rows, idf)
    got = {r["doc_id"]: r["class_id"] for r in found.collect()}
    assert got == want and len(set(want.values())) < 40
    assert all(r["kept"] == (r["class_id"] == r["doc_id"]) for r in found.collect())


def test_parts_of_a_crowded_band_are_joined(spark):
    """Samples that put unlike texts into one band leave no link out."""
    draw = np.random.default_rng(8)
    base = words(300, 5, 3000)
    rows = []
    for i in range(60):  # a chain: neighbours are alike, the ends are not
        text = list(base)
        for at in range(5 * i, 5 * i + 20):
            text[at % 300] = f"link{at}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(words(200, int(draw.integers(1e6)), 3000))) for i in range(20)]
    table = spark.createDataFrame(rows, DOCS)
    idf = minhash.inverse_frequencies(table)
    want = slow_classes(rows, idf)
    assert {r["doc_id"]: r["class_id"] for r in minhash.near_copies(table).collect()} == want


def test_very_long_texts_and_an_empty_table(spark):
    long = words(60_000, 3, 50_000)
    other = list(long)
    other[::400] = ["z"] * len(other[::400])
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(long[:100])), (None, " ".join(long))]
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {1: 1, 2: 1, 3: 3, None: None}
    assert minhash.near_copies(spark.createDataFrame([], DOCS)).count() == 0
    assert substrings.without_repeats(spark.createDataFrame([], DOCS)).select(F.size("factors")).count() == 0
