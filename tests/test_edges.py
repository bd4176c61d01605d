"""Inputs outside the usual: nulls, gaps, ties, long lists, marks in texts."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from siftframe import Collection, Field, Mapping
from siftframe.functions import analysis
from siftframe.operators import buckets, metrics, mutate, paging, pipelines
from siftframe.operators.search import search
from siftframe.plans import conditions as q
from siftframe.plans.conditions import where


def collection(spark, rows, schema, **fields):
    return Collection(spark.createDataFrame(rows, schema), Mapping({k: Field(v) for k, v in fields.items()}))


def test_children_of_a_parent_without_a_metric_keep_their_counts(spark):
    rows = [("1", "x", None, 1.0), ("2", "x", None, 25.0), ("3", "y", 2.0, 5.0)]
    c = collection(spark, rows, "_id string, k string, r double, v double", k="keyword", r="double", v="double")
    levels = [
        buckets.Level("k", buckets.Terms("k", 10), {"r": metrics.avg("r")}),
        buckets.Level("v", buckets.Histogram("v", 10)),
    ]
    found = {(r["k"], r["v"]): (r["v_count"], r["k_r"]) for r in buckets.nested_buckets(c, levels).collect()}
    assert found == {("x", 0.0): (1, None), ("x", 10.0): (0, None), ("x", 20.0): (1, None), ("y", 0.0): (1, 2.0)}


def test_sums_of_whole_lists_are_exact(spark):
    rows = [("1", [2**60, 1]), ("2", [2, None]), ("3", None)]
    c = collection(spark, rows, "_id string, n array<bigint>", n="long")
    found = metrics.aggregate(c, {"s": metrics.stats("n")}).first()
    assert (found["s_sum"], found["s_count"], found["s_max"]) == (2**60 + 3, 3, 2**60)


def test_a_metric_name_belongs_to_its_level(spark):
    rows = [("1", "x", 1.0, 4.0), ("2", "x", 3.0, 6.0)]
    c = collection(spark, rows, "_id string, k string, r double, v double", k="keyword", r="double", v="double")
    levels = [
        buckets.Level("a", buckets.Terms("k", 1, order_by="m"), {"m": metrics.avg("r"), "s": metrics.stats("v")}),
        buckets.Level("b", buckets.Terms("k", 1), {"m": metrics.max_of("v")}),
    ]
    found = buckets.nested_buckets(c, levels).first()
    assert (found["a_m"], found["b_m"], found["a_s_avg"], found["a_s_count"]) == (2.0, 6.0, 5.0, 2)


def test_parents_without_children_and_empty_ranges_stay(spark):
    rows = [("1", "x", 1.0, 5.0), ("2", "x", 31.0, 5.0), ("3", "z", None, 5.0)]
    c = collection(spark, rows, "_id string, k string, v double, w double", k="keyword", v="double", w="double")
    by_k = buckets.Level("k", buckets.Terms("k", 10))
    by_v = buckets.Level("v", buckets.Histogram("v", 10))
    bands = buckets.Level("w", buckets.ranges("w", {"key": "low", "to": 10}, {"key": "high", "from": 10}))
    rows_of = lambda *levels: sorted((tuple(r) for r in buckets.nested_buckets(c, list(levels)).collect()), key=str)
    filled = [("x", 2, 0.0, 1), ("x", 2, 10.0, 0), ("x", 2, 20.0, 0), ("x", 2, 30.0, 1), ("z", 1, None, 0)]
    assert rows_of(by_k, by_v) == filled
    assert rows_of(by_k, bands) == [("x", 2, "high", 0), ("x", 2, "low", 2), ("z", 1, "high", 0), ("z", 1, "low", 1)]
    assert rows_of(bands, by_k) == [("high", 0, None, 0), ("low", 3, "x", 2), ("low", 3, "z", 1)]
    assert rows_of(by_v, by_k) == [(0.0, 1, "x", 1), (10.0, 0, None, 0), (20.0, 0, None, 0), (30.0, 1, "x", 1)]
    deep = rows_of(by_k, by_v, bands)
    assert ("z", 1, None, 0, None, 0) in deep and ("x", 2, 10.0, 0, "low", 0) in deep and len(deep) == 9


@pytest.mark.parametrize("block", [2, 5, 65_536])
def test_sequences_over_gaps_do_not_depend_on_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(pipelines, "BLOCK", block)
    table = spark.createDataFrame([(float(k), v) for k, v in ((0, 1.0), (1, 3.0), (5, 4.0), (6, 10.0))], "key double, v double")
    spec = buckets.Histogram("x", 1)
    values = lambda df: [r["value"] for r in df.orderBy("key").collect()]
    assert values(pipelines.derivative(table, "v", spec)) == [None, 2.0, None, 6.0]
    assert values(pipelines.moving_avg(table, "v", 2, spec)) == [1.0, 2.0, 4.0, 7.0]
    assert values(pipelines.cumulative_sum(table, "v", spec)) == [1.0, 4.0, 8.0, 18.0]


def test_long_lists_of_values_on_a_list_field(spark):
    c = collection(spark, [("1", ["a", "v7"]), ("2", ["b"]), ("3", None)], "_id string, tags array<string>", tags="keyword")
    wanted = q.terms("tags", *[f"v{i}" for i in range(1500)])
    assert [r["_id"] for r in where(c.df, wanted, c.scope).collect()] == ["1"]


def test_regexp_is_about_the_whole_value(spark):
    c = collection(spark, [("1", "abc"), ("2", "abc\n"), ("3", "xabc")], "_id string, s string", s="keyword")
    assert [r["_id"] for r in where(c.df, q.regexp("s", "abc"), c.scope).collect()] == ["1"]


def test_a_tag_in_the_text_is_no_highlight(spark):
    rows = [("1", "an <em>old</em> tag with runs"), ("2", "an <em>old</em> tag")]
    c = collection(spark, rows, "_id string, t string", t="text")
    found = {r["_id"]: r["highlight"] for r in search(c, q.any_of(q.match("t", "runs"), q.match("t", "tag")), highlight=["t"]).collect()}
    assert "<em>runs</em>" in found["1"]["t"][0]
    only = search(c, q.any_of(q.match("t", "runs"), q.ids("2")), highlight=["t"])
    assert not {r["_id"]: r["highlight"] for r in only.collect()}["2"]


def test_percentiles_leave_out_nan(spark):
    c = collection(spark, [("1", 1.0), ("2", float("nan")), ("3", 3.0)], "_id string, v double", v="double")
    assert metrics.exact_percentiles(c, "v", 50.0).first()[0] == 2.0


def test_operations_without_an_id_stay_apart(spark):
    target = spark.createDataFrame([], "_id string, _version long, name string")
    ops = spark.createDataFrame(
        [(None, i, "index", ("n",), ["name"]) for i in range(2)],
        "_id string, seq long, action string, doc struct<name string>, set_fields array<string>",
    )
    found = mutate.bulk(target, ops).table.collect()
    assert len({r["_id"] for r in found}) == 2 and all(r["_version"] == 1 and r["_id"] for r in found)


def test_han_text_among_urls(spark):
    df = spark.createDataFrame([("你好 see https://a.org/x ok",)], "t string")
    assert df.select(analysis.url_email(F.col("t"))).first()[0] == ["你", "好", "see", "https://a.org/x", "ok"]


def test_a_table_of_values_stands_anywhere(spark):
    rows = [("a", 1, 1), ("b", 2, 2), (None, 3, 3), ("d", None, 4)]
    c = Collection(spark.createDataFrame(rows, "_id string, n int, _value int"), Mapping({}))
    own = q.ids(c.df.where("n = 1").select("_id"))  # from the collection itself
    listed = q.terms("n", spark.createDataFrame([(3,), (3,), (None,)], "v int"))
    left = lambda df: sorted(r["_value"] for r in df.collect())
    seen = Observation()
    assert left(mutate.delete_by_query(c, own | listed, seen)) == [2, 4]
    assert seen.get == {"total": 4, "deleted": 2}
    assert left(mutate.delete_by_query(c, q.all_of(own, listed))) == [1, 2, 3, 4]
    assert left(mutate.delete_by_query(c, ~own)) == [1]
    assert left(mutate.delete_by_query(c, q.any_of(q.terms("_value", listed.values), q.ids("a")))) == [2, 4]
    changed = mutate.update_by_query(c, own | listed, {"n": 9}).where("n = 9")
    assert left(changed) == [1, 3]
    assert left(search(c, own | q.terms("n", 2), sort=["_value"])) == [1, 2]
    assert left(search(c, q.any_of(own, q.terms("n", 2)))) == [1, 2]


def test_search_after_carries_score_and_marks(spark):
    rows = [("a", "red red fox"), ("b", "red hen"), ("c", "blue hen")]
    c = Collection(spark.createDataFrame(rows, "_id string, t string"), Mapping({"t": Field("text")}))
    options = dict(sort=[("_score", "desc")], size=1, highlight=["t"])
    first = paging.search_after(c, q.match("t", "red"), **options).first()
    after = (first["_score"], first["_id"])
    second = paging.search_after(c, q.match("t", "red"), values=after, **options).first()
    assert {first["_id"], second["_id"]} == {"a", "b"} and first["_score"] > second["_score"] > 0
    marks = {r["_id"]: r["highlight"]["t"] for r in (first, second)}
    assert marks == {"a": ["<em>red</em> <em>red</em> fox"], "b": ["<em>red</em> hen"]}
    plain = paging.search_after(c, None, sort=["t"], size=3)
    assert "_score" not in plain.columns and "highlight" not in plain.columns


OPS = "seq long, action string, _id string, doc struct<name string, o struct<x int, y int>>, set_fields array<string>"


def bulk_of(spark, rows, ops, **options):
    target = spark.createDataFrame(rows, "_id string, _version long, name string, o struct<x int, y int>")
    return mutate.bulk(target, spark.createDataFrame(ops, OPS), **options)


def test_null_objects_stay_null(spark):
    rows = [("a", 1, "n", None), ("b", 1, "n", (1, 2)), ("c", 1, "n", None), ("d", 1, "n", (None, None))]
    ops = [
        (1, "update", "a", ("new", None), ["name"]),
        (2, "update", "b", (None, None), ["o"]),
        (3, "update", "c", (None, (7, None)), ["o.x"]),
        (4, "update", "d", ("n", None), ["name"]),
        (5, "index", "e", ("n", None), None),
    ]
    found = bulk_of(spark, rows, ops)
    objects = {r["_id"]: r["o"] and tuple(r["o"]) for r in found.table.collect()}
    assert objects == {"a": None, "b": None, "c": (7, None), "d": (None, None), "e": None}
    assert {r["_id"]: r["result"] for r in found.items.collect()}["d"] == "noop"


def test_a_crowded_id_is_cut_by_count(spark):
    ops = [(i if i else 10**9, "upsert", "a", (str(i), None), ["name"]) for i in range(3000)]
    fold = mutate._Fold("_id", spark.createDataFrame(ops, OPS), 200)
    sizes = [r["count"] for r in fold.rows.groupBy("_stretch").count().collect()]
    assert fold.hot and sum(sizes) == 3000 and max(sizes) <= 400
    last = bulk_of(spark, [], ops, hot_ops=200).table.first()
    assert (last["name"], last["_version"]) == ("0", 3000)


def test_equal_seqs_give_one_order(spark):
    ops = [(1, "index", "a", (str(i), None), None) for i in range(6)]
    found = [bulk_of(spark, [], list(reversed(ops)) if k else ops, hot_ops=100 if k < 2 else 2) for k in range(3)]
    assert len({f.table.first()["name"] for f in found}) == 1
    assert {r["_version"] for r in found[0].items.collect()} == set(range(1, 7))


def test_rows_that_share_an_id_keep_their_own_tokens(spark):
    df = spark.createDataFrame([(1, ["bad"]), (1, ["well"]), (2, None)], "_id int, w array<string>")
    rules = spark.createDataFrame([("bad", "worse")], "word string, form string")
    found = analysis.expand_tokens(df, "_id", "w", rules, keep=True, out="out").collect()
    assert sorted(map(str, (r["out"] for r in found))) == ["None", "['bad', 'worse']", "['well']"]
