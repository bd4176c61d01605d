"""The stored text index: equal to what conditions and scores say of the texts."""

import random

import pytest
from pyspark.sql import functions as F

from siftframe import Collection, Field, Mapping
from siftframe.operators import index as ix
from siftframe.operators import scoring
from siftframe.operators.search import search
from siftframe.plans import conditions as q

SCHEMA = "_id string, text string"


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "alpha", "alphas", "beta", "gamma", "delta", "abcabc", "café", "x1", "electron", "electric", "selector"]
    weights = [30, 20] + [3] * (len(words) - 2)
    rows = [(f"d{i}", " ".join(rng.choices(words, weights, k=rng.randint(0, 30)))) for i in range(n)]
    return rows + [("null", None), ("empty", ""), ("long", "z" * 60 + " alpha")]


def collection(spark, rows):
    return Collection(spark.createDataFrame(rows, SCHEMA), Mapping({"text": Field("text")}))


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """An index made in two additions, with tiny blocks and parts."""
    rows = texts(120)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ix, "BLOCK", 4)
        patch.setattr(ix, "PART_ROWS", 40)
        patch.setattr(ix, "BUCKETS", 2)
        index = ix.TextIndex.build(collection(spark, rows[:80]), "text", str(tmp_path_factory.mktemp("index")))
        first = index
        index = index.added(collection(spark, rows[80:]), "text")
        yield collection(spark, rows), index, first, collection(spark, rows[:80])


CONDITIONS = [
    q.match_phrase("text", "of the"), q.match_phrase("text", "the of the"), q.match_phrase("text", "the the the"),
    q.match_phrase("text", "alpha"), q.match_phrase("text", "alpha missing"), q.match("text", "beta gamma"), q.term("text", "café"),
    q.wildcard("text", "ele*r?n"), q.wildcard("text", "*"), q.wildcard("text", "a*a?"), q.wildcard("text", "?1"),
    q.prefix("text", "el"), q.prefix("text", "e"), q.regexp("text", "s?elect.+"), q.regexp("text", "(abc)+"), q.regexp("text", "al+pha"),
    q.fuzzy("text", "alpah", 2), q.fuzzy("text", "electrn"), q.fuzzy("text", "of"), q.fuzzy("text", "z" * 59, 1), q.fuzzy("text", "lectron", 3),
]


def test_conditions_equal_those_on_texts(spark, whole):
    c, index, _, _ = whole
    for condition in CONDITIONS:
        assert ids(index.ids(condition)) == ids(search(c, condition, sort=[], size=None, source=["_id"])), condition


def test_no_text_is_read_for_a_pattern(whole):
    c, index, _, _ = whole
    plan = index.rows(c, q.regexp("text", "elect.+"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and "text" not in plan.split("RLIKE")[1].split(")")[0]
    assert plan.count("text#") <= 2  # in the rows given back, not in a condition
    phrase = index.phrase("of the")._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in phrase.replace("text-index", "").replace("bucket", "") or "LogicalRDD" not in phrase


def test_a_reader_keeps_its_version(spark, whole):
    c, index, first, part = whole
    condition = q.match_phrase("text", "of the")
    assert ids(first.ids(condition)) == ids(search(part, condition, sort=[], size=None, source=["_id"]))
    again = ix.TextIndex(spark, index.store.root, index.chain, version=1)
    assert ids(again.ids(condition)) == ids(first.ids(condition))


@pytest.mark.parametrize("k", [1, 5])
def test_best_rows_equal_the_scan_and_blocks_stay_shut(spark, whole, k, monkeypatch):
    c, index, _, _ = whole
    monkeypatch.setattr(ix, "_PROBE", 3)
    queries = spark.createDataFrame(
        [(1, "alpha the"), (2, "the of"), (3, "nothing here"), (4, "beta beta gamma of the"), (5, ""), (6, None)], "qid int, text string"
    )
    found = index.search_batch(queries, k=k)
    want = scoring.search_batch(c, "text", queries, k=k)
    mine = sorted((r["qid"], r["rank"], r["id"], round(r["_score"], 6)) for r in found.rows.collect())
    assert mine == sorted((r["qid"], r["rank"], r["_id"], round(r["_score"], 6)) for r in want.collect())
    read = found.read().first()
    assert read["opened"] < read["blocks"] and read["opened_bytes"] < read["bytes"]


def test_empty_index(spark, tmp_path):
    c = collection(spark, [])
    index = ix.TextIndex.build(c, "text", str(tmp_path / "index"))
    queries = spark.createDataFrame([(1, "alpha")], "qid int, text string")
    assert index.search_batch(queries).rows.count() == 0 and ids(index.ids(q.prefix("text", "a"))) == []
    index = index.added(collection(spark, [("1", "alpha beta")]), "text")
    assert ids(index.phrase("alpha beta").select("id")) == ["1"] and index.search_batch(queries).rows.count() == 1


def test_grams_are_in_every_fitting_word():
    import re

    words = ["electron", "elector", "abab", "ab", "aab", "b", "a-b"]
    for pattern in ["el.*or", "a+b", "a?b", "ab", "a.b", "(ab)+", "e.+n", "a*b", "a-b"]:
        for word in words:
            if re.fullmatch(pattern, word):
                assert all(g in ix.START + word + ix.END for g in ix.regexp_grams(pattern)), (pattern, word)
    assert ix.wildcard_grams("el*or") == sorted(["\x02el", "or\x03"]) and ix.wildcard_grams("*") == []


def test_neighbours_meet_at_distance_two(spark):
    pairs = [("kitten", "sittin"), ("ab", "ba"), ("abc", "abc"), ("house", "mouse"), ("a", "abc"), ("", "ab")]
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.select("a", "b", F.arrays_overlap(ix._neighbours(F.col("a")), ix._neighbours(F.col("b"))).alias("meet"))
    assert all(r["meet"] for r in df.collect())


def test_the_vocabulary_has_few_rows_per_word_and_loses_no_neighbour(spark, tmp_path):
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(300)} | {"abcabcabcabc" * 3})
    c = collection(spark, [(str(i), " ".join(words[i::4])) for i in range(4)])
    index = ix.TextIndex.build(c, "text", str(tmp_path / "index"))
    assert index.now.read("neighbours").count() == 3 * len(words)
    assert index.now.note["words"] == len(words) and index.terms().count() == len(words)
    for value, k in (("abca", 2), ("éab", 2), ("a", 2), ("abcabca", 1), ("bbbbbbbbb", 2)):
        near = spark.createDataFrame([(w,) for w in words], "term string").where(F.levenshtein("term", F.lit(value)) <= k)
        assert ids(index.terms_like(q.fuzzy("text", value, k))) == ids(near), value
