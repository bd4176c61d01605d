"""Metrics, buckets, nested levels and pipelines on small tables."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest

from siftframe import Collection, Field, Mapping
from siftframe.functions import dates
from siftframe.operators import buckets as b
from siftframe.operators import metrics as m
from siftframe.operators import pipelines as p
from siftframe.plans import conditions as q


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        kind = rng.choice(["a", "a", "a", "b", "c", None])
        value = None if i % 13 == 0 else round(rng.uniform(-50, 150), 2)
        day = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 24 * 120))
        tags = rng.choice([[], ["x"], ["x", "y"], ["y", "y", "z"], None])
        point = None if i % 9 == 0 else (rng.uniform(-80, 80), rng.uniform(-170, 170))
        rows.append((str(i), kind, rng.choice("pqr"), value, day, tags, point, [i % 3, i % 5]))
    schema = (
        "_id string, kind string, shop string, value double, day timestamp_ntz, tags array<string>,"
        " place struct<lat:double,lon:double>, sizes array<int>"
    )
    df = spark.createDataFrame(rows, schema)
    return Collection(df, Mapping({"place": Field("geo_point")})), rows


def test_metrics(sales):
    c, rows = sales
    values = [r[3] for r in rows if r[3] is not None]
    row = m.aggregate(c, {"v": m.extended_stats("value"), "n": m.cardinality("shop", exact=True)}).head()
    assert row.v_count == len(values) and row.n == 3
    assert row.v_sum == pytest.approx(sum(values))
    assert row.v_variance_sampling == pytest.approx(np.var(values, ddof=1))
    assert row.v_upper == pytest.approx(np.mean(values) + 2 * np.std(values))
    lists = m.aggregate(c, {"s": m.stats("sizes")}).head()
    flat = [x for r in rows for x in r[7]]
    assert (lists.s_count, lists.s_sum, lists.s_min, lists.s_max) == (len(flat), sum(flat), min(flat), max(flat))


def test_metrics_of_nothing(sales):
    c, _ = sales
    row = m.aggregate(c, {"s": m.stats("value")}, q.term("kind", "nope")).head()
    assert (row.s_count, row.s_sum, row.s_avg, row.s_min) == (0, 0, None, None)


@pytest.mark.parametrize("shape", ["spread", "one value", "heavy value", "outlier", "two", "single"])
@pytest.mark.parametrize("bracket_rows", [1_000_000, 20])
def test_exact_percentiles(spark, monkeypatch, shape, bracket_rows):
    monkeypatch.setattr(m, "BRACKET_ROWS", bracket_rows)
    rng = random.Random(5)
    values = {
        "spread": [rng.gauss(0, 1) for _ in range(3000)],
        "one value": [7.0] * 500,
        "heavy value": [1.0] * 1000 + [rng.uniform(0, 2) for _ in range(2000)],
        "outlier": [rng.random() for _ in range(999)] + [1e300],
        "two": [1.0, 2.0],
        "single": [4.5],
    }[shape]
    c = Collection(spark.createDataFrame([(v,) for v in values] + [(None,)], "v double"))
    percents = (0, 1, 10, 33.3, 50, 99, 99.9, 100)
    row = m.exact_percentiles(c, "v", *percents, accuracy=100).head()
    assert list(row) == pytest.approx([np.percentile(values, x) for x in percents])


def test_exact_percentiles_of_nothing(spark):
    c = Collection(spark.createDataFrame([(None,)], "v double"))
    assert list(m.exact_percentiles(c, "v", 50).head()) == [None]


def test_approximate_metrics_stay_near(spark):
    c = Collection(spark.range(50_000).selectExpr("id % 7919 AS v"))
    row = m.aggregate(c, {"n": m.cardinality("v", rsd=0.02), "p": m.percentiles("v", 50)}).head()
    assert abs(row.n - 7919) / 7919 < 0.08
    assert abs(row.p_50 - np.median([i % 7919 for i in range(50_000)])) < 20


def test_terms(sales):
    c, rows = sales
    counts = Counter(r[1] for r in rows if r[1] is not None)
    got = b.buckets(c, b.Terms("kind", 2), {"s": m.sum_of("value")}).collect()
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    assert [(r.key, r.doc_count) for r in got] == want[:2]
    assert got[0].sum_other_doc_count == want[2][1]
    tags = Counter(t for r in rows for t in set(r[5] or []))
    assert {(r.key, r.doc_count) for r in b.buckets(c, b.Terms("tags")).collect()} == set(tags.items())
    by_key = b.buckets(c, b.Terms("kind", 2, "_key", "desc")).collect()
    assert [r.key for r in by_key] == ["c", "b"]


def test_terms_with_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(b, "TOP_ROWS", 5)
    c = Collection(spark.range(300).selectExpr("id % 40 AS v"))
    got = b.buckets(c, b.Terms("v", 12)).collect()
    assert len(got) == 12 and {r.doc_count for r in got} == {8}
    assert {r.sum_other_doc_count for r in got} == {300 - 12 * 8}


def test_histogram_fills_gaps_also_below_zero(spark):
    c = Collection(spark.createDataFrame([(-25.0,), (-1.0,), (0.0,), (39.9,)], "v double"))
    got = {r.key: r.doc_count for r in b.buckets(c, b.Histogram("v", 10)).collect()}
    assert got == {-30.0: 1, -20.0: 0, -10.0: 1, 0.0: 1, 10.0: 0, 20.0: 0, 30.0: 1}


def test_histogram_with_a_span_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(b, "_SPINE_BLOCK", 16)
    c = Collection(spark.createDataFrame([(0.0,), (1000.0,)], "v double"))
    got = sorted(r.key for r in b.buckets(c, b.Histogram("v", 1)).collect())
    assert got == [float(i) for i in range(1001)]


@pytest.mark.parametrize(
    "interval, moment, start",
    [
        ("1m", "2024-05-17 13:45:59", "2024-05-17 13:45:00"),
        ("1h", "1969-12-31 23:10:00", "1969-12-31 23:00:00"),
        ("1d", "2024-02-29 00:00:00", "2024-02-29 00:00:00"),
        ("1w", "2024-05-19 23:59:59", "2024-05-13 00:00:00"),
        ("1w", "1969-12-30 00:00:00", "1969-12-29 00:00:00"),
        ("1M", "1968-02-29 12:00:00", "1968-02-01 00:00:00"),
        ("1q", "2024-11-30 12:00:00", "2024-10-01 00:00:00"),
        ("1y", "1901-11-30 12:00:00", "1901-01-01 00:00:00"),
    ],
)
def test_calendar_buckets(spark, interval, moment, start):
    df = spark.sql(f"SELECT timestamp_ntz'{moment}' AS t")
    spec = b.DateHistogram("t", interval)
    key = b.buckets(Collection(df), spec).head().key
    assert key == dt.datetime.fromisoformat(start)


def test_overlapping_ranges(sales):
    c, rows = sales
    spec = b.ranges("value", {"to": 0}, {"from": -10, "to": 50}, {"from": 40}, {"key": "none", "from": 1e6})
    got = {r.key: (r.doc_count, r.s) for r in b.buckets(c, spec, {"s": m.sum_of("value")}).collect()}
    values = [r[3] for r in rows if r[3] is not None]
    inside = lambda lo, hi: [v for v in values if lo <= v < hi]
    assert got["*-0"][0] == len(inside(-1e9, 0))
    assert got["-10-50"] == (len(inside(-10, 50)), pytest.approx(sum(inside(-10, 50))))
    assert got["40-*"][0] == len(inside(40, 1e9))
    assert got["none"] == (0, 0)


def test_missing_counts_empty_lists(sales):
    c, rows = sales
    assert b.missing(c, "tags").head().doc_count == sum(not r[5] for r in rows)
    assert b.missing(c, "value").head().doc_count == sum(r[3] is None for r in rows)


def test_three_levels(sales):
    c, rows = sales
    levels = [
        b.Level("kind", b.Terms("kind", 2), {"v": m.avg("value")}),
        b.Level("shop", b.Terms("shop", 2, "v", "asc"), {"v": m.avg("value")}),
        b.Level("month", b.DateHistogram("day", "1M")),
    ]
    got = b.nested_buckets(c, levels).collect()
    mean = lambda rs: float(np.mean([r[3] for r in rs if r[3] is not None]))
    kinds = Counter(r[1] for r in rows if r[1])
    assert {r.kind for r in got} == {k for k, _ in sorted(kinds.items(), key=lambda kv: (-kv[1], kv[0]))[:2]}
    for kind in {r.kind for r in got}:
        inside = [r for r in rows if r[1] == kind]
        shops = sorted({r[2] for r in inside}, key=lambda s: mean([r for r in inside if r[2] == s]))[:2]
        assert {r.shop for r in got if r.kind == kind} == set(shops)
        for shop in shops:
            cell = [r for r in inside if r[2] == shop]
            mine = [r for r in got if (r.kind, r.shop) == (kind, shop)]
            assert {(r.kind_count, r.shop_count) for r in mine} == {(len(inside), len(cell))}
            assert mine[0].kind_v == pytest.approx(mean(inside))
            assert mine[0].shop_v == pytest.approx(mean(cell))
            months = Counter(r[4].replace(day=1, hour=0) for r in cell)
            assert {r.month: r.month_count for r in mine if r.month_count} == dict(months)


def test_levels_with_lists_count_parents_once(sales):
    c, rows = sales
    levels = [b.Level("kind", b.Terms("kind")), b.Level("tag", b.Terms("tags"))]
    for r in b.nested_buckets(c, levels).collect():
        assert r.kind_count == sum(x[1] == r.kind for x in rows)
        assert r.tag_count == sum(x[1] == r.kind and r.tag in (x[5] or []) for x in rows)


def test_geo_metrics(sales):
    c, rows = sales
    row = m.aggregate(c, {"box": m.geo_bounds("place"), "mid": m.geo_centroid("place")}).head()
    points = [r[6] for r in rows if r[6]]
    assert row.box_top == max(x for x, _ in points) and row.box_left == min(y for _, y in points)
    assert row.mid_count == len(points) and row.mid_lat == pytest.approx(np.mean([x for x, _ in points]))


@pytest.mark.parametrize("block", [4, 65536])
def test_sequences_do_not_depend_on_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(p, "BLOCK", block)
    values = [None if i % 6 == 5 else float((i * 7) % 11) for i in range(40)]
    table = spark.createDataFrame([(i * 0.5, v) for i, v in enumerate(values)], "key double, v double").repartition(4)
    spec = b.Histogram("x", 0.5)

    def ordered(df):
        return [r.value for r in sorted(df.collect(), key=lambda r: r.key)]

    moving = ordered(p.moving_avg(table, "v", 5, spec))
    for i in range(40):
        seen = [v for v in values[max(0, i - 4): i + 1] if v is not None]
        assert moving[i] == pytest.approx(np.mean(seen))
    steps = ordered(p.derivative(table, "v", spec))
    for i in range(40):
        pair = None if i == 0 or None in (values[i], values[i - 1]) else values[i] - values[i - 1]
        assert steps[i] == pair
    assert ordered(p.cumulative_sum(table, "v", spec)) == list(np.cumsum([v or 0 for v in values]))


def test_extreme_buckets_give_every_tie(spark):
    table = spark.createDataFrame([("a", 3), ("b", 9), ("c", 9), ("d", None)], "key string, doc_count int")
    assert {(r.key, r.value) for r in p.max_bucket(table).collect()} == {("b", 9), ("c", 9)}
    assert {(r.key, r.value) for r in p.min_bucket(table).collect()} == {("a", 3)}
    assert p.avg_bucket(table).head().value == 7
    assert p.sum_bucket(table).head().value == 21


def test_date_expressions():
    now = dt.datetime(2024, 3, 31, 15, 30, 12)
    day = lambda text: dates.resolve_date(text, now)
    assert day("now-7d/d") == dt.datetime(2024, 3, 24)
    assert day("now-1M/M") == dt.datetime(2024, 2, 1)
    assert day("now-1M") == dt.datetime(2024, 2, 29, 15, 30, 12)
    assert day("now/w") == dt.datetime(2024, 3, 25)
    assert day("2024-01-01||+1M/d") == dt.datetime(2024, 2, 1)
    assert day("2023-05-06") == dt.datetime(2023, 5, 6)
    with pytest.raises(ValueError):
        dates.resolve_date("now-1d")
    with pytest.raises(ValueError):
        day("now*2d")


def test_gaps_are_filled_up_to_a_bound(spark, monkeypatch):
    df = spark.createDataFrame([("1", 0.0), ("2", 40.0), ("3", 41.0)], "_id string, v double")
    c = Collection(df)
    monkeypatch.setattr(b, "MAX_BUCKETS", 42)
    assert b.buckets(c, b.Histogram("v", 1)).count() == 42
    monkeypatch.setattr(b, "MAX_BUCKETS", 41)
    with pytest.raises(Exception, match="more than 41 buckets, filled up from 0 to 41"):
        b.buckets(c, b.Histogram("v", 1)).collect()


def test_discrete_percentiles_hold_no_distinct_values_in_one_task(spark, monkeypatch):
    from pyspark.sql import functions as F

    from siftframe.operators import metrics as mm

    monkeypatch.setattr(mm, "BRACKET_ROWS", 50)
    percents = (0, 0.95, 5, 50, 99.05, 100)
    literals = [f"percentile_disc({p / 100:.6f}) WITHIN GROUP (ORDER BY v)" for p in percents]
    for n, value in ((4000, "CAST(id * 7919 % 4001 AS DOUBLE)"), (4000, "CAST(id % 3 AS DOUBLE)"), (7, "IF(id < 5, NULL, IF(id = 5, DOUBLE('NaN'), 1D))"), (3, "CAST(NULL AS DOUBLE)")):
        df = spark.range(n).select(F.expr(value).alias("v"))
        found = mm.discrete_percentiles(Collection(df), "v", *percents, accuracy=200)
        assert str(found.first()[:]) == str(df.agg(*[F.expr(x) for x in literals]).first()[:]), value
    plan = mm.discrete_percentiles(Collection(spark.range(4000)), "id", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan


def test_the_approximate_percentiles_query_ranks_nothing_in_one_buffer(spark, tmp_path):
    from pyspark.sql import functions as F

    from catalog.aggregating import agg_percentiles_approx

    rows = spark.range(3000).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") * 1.5).alias("l_extendedprice"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = agg_percentiles_approx(spark, str(tmp_path))
    assert "percentile_disc" not in found._jdf.queryExecution().analyzed().toString().lower()
    assert [(r["percent"], r["near"]) for r in found.collect()] == [(p, True) for p in (1, 5, 25, 50, 75, 95, 99)]
