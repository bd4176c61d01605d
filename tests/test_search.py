"""Scores, highlights, sorting and paging."""

import math
import random

import pytest

from siftframe import Collection, Field, Mapping, session
from siftframe.operators import buckets as b
from siftframe.operators import metrics as m
from siftframe.operators import paging, scoring
from siftframe.operators import search as s
from siftframe.operators.sorting import SortKey, orderings, sort_keys
from siftframe.plans import conditions as q

TEXTS = ["the red fox", "red red wine", "a fox and a hound", "nothing", None, "The FOX, the red one"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(str(i), x, "even" if i % 2 == 0 else "odd") for i, x in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "_id string, text string, kind string")
    return Collection(df, Mapping({"text": Field("text"), "kind": Field("keyword")}))


def bm25(word, lists, doc):
    n = len(lists)
    df = sum(word in x for x in lists)
    avg = sum(map(len, lists)) / n
    tf = doc.count(word)
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc) / avg))


def words(text):
    return text.lower().replace(",", "").split()


def test_bm25_by_hand(texts):
    lists = [words(x) for x in TEXTS if x is not None]
    got = {r["_id"]: r["_score"] for r in s.search(texts, q.match("text", "red fox"), size=None).collect()}
    want = {}
    for i, x in enumerate(TEXTS):
        if x is not None and {"red", "fox"} & set(words(x)):
            want[str(i)] = sum(bm25(w, lists, words(x)) for w in ("red", "fox"))
    assert got == pytest.approx(want)


def test_score_parts(texts):
    score = lambda c: {r["_id"]: r["_score"] for r in s.search(texts, c, size=None).collect()}
    assert set(score(q.term("kind", "even")).values()) == {0.0}
    assert set(score(q.match_all()).values()) == {1.0}
    assert score(None) == score(q.match_all())
    idf_even = math.log(1 + (6 - 3 + 0.5) / 3.5)
    boosted = score(q.Bool(filter=(q.exists("text"),), should=(q.term("kind", "even"), q.prefix("text", "fo"))))
    assert boosted["0"] == pytest.approx(idf_even + 1)
    assert boosted["3"] == 0.0
    best = score(q.multi_match("even", "text", "kind"))
    assert best == pytest.approx({"0": idf_even, "2": idf_even, "4": idf_even})


def test_stored_tokens_give_the_same_scores(texts):
    from siftframe.sources.mapping import with_tokens

    stored = texts.with_df(with_tokens(texts.df, texts.mapping))
    for condition in (q.match("text", "red fox"), q.match_phrase("text", "red fox")):
        a = s.search(texts, condition, source=["_id"]).collect()
        assert a == s.search(stored, condition, source=["_id"]).collect()


def test_stored_statistics_give_the_same_scores(texts):
    words = scoring.term_stats(texts, "text")
    for condition in (q.match("text", "red fox zebra"), q.Bool(should=(q.match("text", "hound"), q.term("kind", "odd")))):
        plain = s.search(texts, condition, source=["_id"]).collect()
        assert plain == s.search(texts, condition, source=["_id"], term_tables={"text": words}).collect()


def test_histogram_reads_its_rows_once(spark, goods, tmp_path):
    path = str(tmp_path / "goods")
    goods.df.write.parquet(path)
    found = b.buckets(goods.with_df(spark.read.parquet(path)), b.Histogram("stock", 7), {"top": m.max_of("price")})
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_batch_equals_single(spark, texts):
    queries = spark.createDataFrame([(1, "red fox"), (2, "hound nothing"), (3, "zebra"), (4, "red red")], "qid int, text string")
    rows = scoring.search_batch(texts, "text", queries, k=3).collect()
    assert {r.qid for r in rows} == {1, 2, 4}
    for qid, text in ((1, "red fox"), (2, "hound nothing"), (4, "red red")):
        got = [(r["_id"], r["_score"]) for r in sorted(rows, key=lambda r: r["rank"]) if r.qid == qid]
        want = [(r["_id"], r["_score"]) for r in s.search(texts, q.match("text", text), size=3).collect()]
        assert [x for x, _ in got] == [x for x, _ in want]
        assert [y for _, y in got] == pytest.approx([y for _, y in want])


@pytest.mark.parametrize("probe", [1, 100])
def test_batch_is_exact_on_skewed_words(spark, monkeypatch, probe):
    """Words of very different frequency, equal rows, more rows than k."""
    monkeypatch.setattr(scoring, "_PROBE", probe)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    odds = [1 / (i + 1) for i in range(60)]
    rows = [(f"{i:04d}", " ".join(rng.choices(words, odds, k=rng.randint(1, 40)))) for i in range(500)]
    rows += [(f"copy{i}", rows[7][1]) for i in range(8)]
    c = Collection(spark.createDataFrame(rows, "_id string, text string"), Mapping({"text": Field("text")}))
    asked = [(i, " ".join(rng.choices(words, odds, k=rng.randint(1, 12)))) for i in range(25)] + [(99, "w0"), (98, "w0 w59 w58")]
    found = scoring.search_batch(c, "text", spark.createDataFrame(asked, "qid int, text string"), k=5).collect()
    lists = {i: x.split() for i, x in rows}
    n, avg = len(lists), sum(map(len, lists.values())) / len(lists)
    df = {w: sum(w in x for x in lists.values()) for w in words}
    weight = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) for w in words}
    for qid, text in asked:
        totals = {}
        for i, x in lists.items():
            parts = [
                weight[w] * x.count(w) * 2.2 / (x.count(w) + 1.2 * (0.25 + 0.75 * len(x) / avg))
                for w in text.split()
                if w in x
            ]
            if parts:
                totals[i] = round(sum(parts), 9)
        want = sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
        got = [(r["_id"], r["_score"]) for r in sorted(found, key=lambda r: r["rank"]) if r.qid == qid]
        assert [x for x, _ in got] == [x for x, _ in want]
        assert [y for _, y in got] == pytest.approx([y for _, y in want])


def test_batch_with_large_query_table(spark, texts, monkeypatch):
    queries = spark.createDataFrame([(1, "red fox"), (2, "hound nothing")], "qid int, text string")
    small = scoring.search_batch(texts, "text", queries, k=3).collect()
    monkeypatch.setattr(scoring, "fits_broadcast", lambda df: False)
    large = scoring.search_batch(texts, "text", queries, k=3).collect()
    assert sorted(small) == sorted(large)


def test_postings_count_repeats(texts):
    rows = {(r.term, r["_id"]): (r.tf, r.dl) for r in scoring.postings(texts, "text").collect()}
    assert rows[("red", "1")] == (2, 3)
    assert rows[("the", "5")] == (2, 5)
    assert sum(tf for tf, _ in rows.values()) == sum(len(words(x)) for x in TEXTS if x)


def test_min_score_and_totals(texts):
    all_scores = [r["_score"] for r in s.search(texts, q.match("text", "red fox"), size=None).collect()]
    cut = sorted(all_scores)[1]
    kept = s.search(texts, q.match("text", "red fox"), size=None, min_score=cut).collect()
    assert len(kept) == len(all_scores) - 1
    row = s.hits_total(texts, q.match("text", "red fox")).head()
    assert (row.total, row.max_score) == (4, pytest.approx(max(all_scores)))


def test_highlight_marks_whole_words(texts):
    rows = s.search(texts, q.match("text", "the re red"), size=None, highlight=["text", "kind"]).collect()
    marks = {r["_id"]: r.highlight for r in rows}
    assert marks["0"] == {"text": ["<em>the</em> <em>red</em> fox"]}
    assert marks["5"] == {"text": ["<em>The</em> FOX, <em>the</em> <em>red</em> one"]}


@pytest.fixture(scope="module")
def goods(spark):
    rows = [
        (f"{i:03d}", f"Product {i}", ("books", "toys", "food")[i % 3], None if i % 7 == 0 else float(i % 10), 100 - i,
         [i % 4, i % 5])
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "_id string, title string, category string, price double, stock int, sizes array<int>")
    return Collection(df.repartition(3), Mapping({"title": Field("text")}))


SORTS = [
    None,
    ["price"],
    [("price", "desc"), "category"],
    [SortKey("price", "asc", missing="_first"), ("stock", "desc")],
    [SortKey("price", "desc", missing="_first")],
    [SortKey("price", missing=5.0), ("category", "desc")],
    [("sizes", "desc"), SortKey("sizes", "asc", mode="avg")],
]


@pytest.mark.parametrize("sort", SORTS)
@pytest.mark.parametrize("size", [7, 20])
def test_pages_put_together_are_the_sorted_table(goods, sort, size):
    keys = sort_keys(goods, sort)
    whole = [r["_id"] for r in goods.df.orderBy(*orderings(goods, keys)).collect()]
    pager = paging.Pager(goods, None, sort=sort, size=size, source=["_id"])
    seen = []
    page = pager.first()
    while pager.has_more:
        rows = [r["_id"] for r in page.collect()]
        assert len(rows) <= size
        seen += rows
        page = pager.next()
    assert seen == whole
    with pytest.raises(RuntimeError):
        pager.next()


def test_pager_must_start(goods):
    with pytest.raises(RuntimeError):
        paging.Pager(goods).next()


def test_from_size_windows(goods, monkeypatch):
    keys = [("price", "desc")]
    whole = [r["_id"] for r in s.search(goods, sort=keys, size=60).collect()]
    assert [r["_id"] for r in s.search(goods, sort=keys, from_=15, size=10).collect()] == whole[15:25]
    monkeypatch.setattr(s, "TOP_ROWS", 20)
    deep = s.search(goods, sort=keys, from_=15, size=10).collect()
    assert sorted(r["_id"] for r in deep) == sorted(whole[15:25])


def test_scroll_is_a_partition_of_the_rows(goods):
    rows = paging.scroll_export(goods, q.term("category", "toys"), size=6).collect()
    assert sorted(r["_position"] for r in rows) == list(range(20))
    assert {r["_id"] for r in rows} == {f"{i:03d}" for i in range(60) if i % 3 == 1}
    assert all(r["_batch"] == r["_position"] // 6 for r in rows)


def test_staged_tables_can_be_dropped(goods):
    rows = paging.scroll_export(goods, size=10)
    assert rows.count() == 60
    assert session.drop_staged(goods.df.sparkSession) >= 1
    assert session.drop_staged(goods.df.sparkSession) == 0


def test_export_writes_every_row(goods, tmp_path):
    batches = paging.scroll_export(goods, size=10)
    paging.write_batches(batches, str(tmp_path / "out"), "json")
    assert goods.df.sparkSession.read.json(str(tmp_path / "out")).count() == 60


def test_mget_keeps_request_order_and_misses(goods):
    rows = s.mget(goods, ["005", "zzz", "001", "005"]).orderBy("_pos").collect()
    assert [(r["_id"], r.found) for r in rows] == [("005", True), ("zzz", False), ("001", True), ("005", True)]


def test_source_and_dotted_paths(spark):
    df = spark.createDataFrame([("1", ("Ann", ("Rome",)))], "_id string, user struct<name:string,address:struct<city:string>>")
    row = s.search(Collection(df), None, source=["user.address.city"]).head()
    assert row["user.address.city"] == "Rome"


def test_filters_reach_the_scan(spark, goods, tmp_path):
    path = str(tmp_path / "goods")
    goods.df.write.parquet(path)
    c = goods.with_df(spark.read.parquet(path))
    condition = q.all_of(q.between("price", 2, 5), ~q.between("stock", lte=50), q.term("category", "toys"))
    found = s.search(c, condition, sort=["stock"], source=["stock"])
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    for part in ("GreaterThanOrEqual(price", "LessThanOrEqual(price", "EqualTo(category", "Or(IsNull(stock)"):
        assert part in pushed
    assert "TakeOrderedAndProject" in plan
    assert "title" not in plan[plan.index("ReadSchema"):].split("\n")[0]


def test_the_long_list_query_returns_every_hit(spark, tmp_path):
    from collections import Counter

    from pyspark.sql import functions as F

    from catalog.searching import terms_long_list

    # More hits than one deep window of 100,000; keys repeat, some keys and names are null.
    name = "CASE id % 20 WHEN 0 THEN NULL WHEN 1 THEN 'blue bolt' WHEN 2 THEN 'steel' ELSE concat('big red ', id) END"
    rows = spark.range(112_000).selectExpr(
        "nullif(id % 110000, 7) AS p_partkey", f"{name} AS p_name", "'Brand#1' AS p_brand", "'PROMO' AS p_type",
        "1 AS p_size", "9.5D AS p_retailprice",
    )
    rows.write.parquet(str(tmp_path / "part.parquet"))
    wanted = rows.where("p_name <> 'blue bolt'").select(F.col("p_partkey").cast("string").alias("_id"), F.col("p_name").alias("title"))
    found = terms_long_list(spark, str(tmp_path))
    hits = Counter(map(tuple, wanted.collect()))
    assert hits.total() > 100_000 and hits[None, "big red 7"] == 1
    assert found.columns == ["_id", "title"] and Counter(map(tuple, found.collect())) == hits
