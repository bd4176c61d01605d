"""Cells of the map and fields that hold ranges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siftframe import Collection, Field, Mapping
from siftframe.functions import cells, geo
from siftframe.operators.intervals import join_points
from siftframe.operators.search import search
from siftframe.plans import conditions as q


def number(lat, lon):
    """The cell by interleaving bits one by one."""
    x = min(max(math.floor((lon + 180) / 360 * 65536), 0), 65535)
    y = min(max(math.floor((lat + 90) / 180 * 65536), 0), 65535)
    return sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(16))


POINTS = [(random.Random(i).uniform(-90, 90), random.Random(-i - 1).uniform(-180, 180)) for i in range(3000)]
POINTS += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (89.99, -180.0), (95.0, 200.0)]


@pytest.fixture(scope="module")
def places(spark):
    rows = [(str(i), p) for i, p in enumerate(POINTS)] + [("none", None)]
    df = spark.createDataFrame(rows, "_id string, at struct<lat: double, lon: double>")
    return Collection(df, Mapping({"at": Field("geo_point")}))


def test_numbers_interleave_bits(places):
    df = cells.with_cells(places.df, "at")
    found = {r["_id"]: r["at__cell"] for r in df.collect()}
    assert found["none"] is None and all(found[str(i)] == number(*p) for i, p in enumerate(POINTS))


@pytest.mark.parametrize("box", [(10, 20, -10, 40), (90, -180, -90, 180), (40, 150, -20, -120), (0.001, 0, 0, 0.001), (90, -180, 80, 180), (5, 7, 5, 7)])
def test_a_cover_is_small_and_holds_the_box(box):
    ranges = cells.cover(*box)
    assert 1 <= len(ranges) <= cells.MOST_RANGES + 2 and all(a <= b for a, b in ranges)
    top, left, bottom, right = box
    draw = random.Random(1)
    for _ in range(500):
        lat = draw.uniform(bottom, top)
        lon = draw.uniform(left, right) if left <= right else (draw.uniform(left, 540 + right - 180 + 0) + 180) % 360 - 180
        if left > right and right < lon < left:
            continue
        assert any(a <= number(lat, lon) <= b for a, b in ranges)
    size = sum(b - a + 1 for a, b in ranges) / 2**32
    width = (right - left) % 360 or 360
    assert size <= (top - bottom) * width / (180 * 360) * 2.5 + 0.02


CONDITIONS = [
    q.geo_distance("at", 48.85, 2.35, "700km"), q.geo_distance("at", -80.0, 10.0, "3000km"), q.geo_distance("at", 5.0, 179.0, "900km"),
    q.geo_bounding_box("at", 40, 150, -20, -120), q.geo_bounding_box("at", 10, 10, 5, 20), q.geo_distance("at", 0, 0, 1),
]


def test_stored_cells_do_not_change_results(spark, places, tmp_path):
    cells.write_in_cell_order(places.df, "at", str(tmp_path / "t"), files=8)
    stored = places.with_df(spark.read.parquet(str(tmp_path / "t")))
    for condition in [*CONDITIONS, ~CONDITIONS[0], ~CONDITIONS[3]]:
        ids = [sorted(r["_id"] for r in search(c, condition, sort=[], size=None, source=["_id"]).collect()) for c in (places, stored)]
        assert ids[0] == ids[1]


def test_the_scan_leaves_files_out(spark, places, tmp_path):
    cells.write_in_cell_order(places.df, "at", str(tmp_path / "t"), files=8)
    stored = places.with_df(spark.read.parquet(str(tmp_path / "t")))
    df = search(stored, CONDITIONS[0], sort=[], size=None, source=["_id"])
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = leaf.metrics().get("numOutputRows").get().value()
    assert 0 < read < len(POINTS) / 2  # row groups without the circle's cells are skipped
    hit = stored.df.where(cells.among(F.col("at__cell"), cells.cover(*geo.around(48.85, 2.35, 700_000.0))))
    assert hit.select("_metadata.file_name").distinct().count() <= 3


def test_a_point_that_many_rows_share_is_spread(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").cast("string").alias("_id"), F.struct(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon")).alias("at"))
    cells.write_in_cell_order(df, "at", str(tmp_path / "t"), files=4)
    sizes = spark.read.parquet(str(tmp_path / "t")).groupBy("_metadata.file_name").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1000


# --- ranges -------------------------------------------------------------------


def intervals():
    draw = random.Random(3)
    rows = []
    for i in range(150):
        low = draw.uniform(-100, 100)
        length = draw.choice([0.0, 1e-13, 0.01, 1.0, 8.0, 64.0, 1e6])
        rows.append((i, (low if draw.random() > 0.1 else None, low + length if draw.random() > 0.1 else None)))
    return rows + [(200, None), (201, (5.0, 4.0)), (202, (float("nan"), 5.0)), (203, (None, None)), (204, (-1e300, 1e300)), (205, (7.0, 7.0))]


def points():
    draw = random.Random(4)
    rows = [(i, draw.choice([draw.uniform(-120, 120), float(draw.randint(-100, 100))])) for i in range(200)]
    return rows + [(500, None), (501, float("nan")), (502, 7.0), (502, 7.0), (503, 1e12), (504, -0.0)]


def pairs():
    holds = lambda x, r: (
        x is not None and x == x and r is not None and not any(b is not None and b != b for b in r)
        and (r[0] is None or r[0] <= x) and (r[1] is None or x <= r[1])
    )
    return sorted((p, i) for p, x in points() for i, r in intervals() if holds(x, r))


def test_points_meet_long_and_short_intervals(spark):
    left = spark.createDataFrame(points(), "p long, x double")
    right = spark.createDataFrame(intervals(), "i long, r struct<gte: double, lte: double>")
    met = join_points(left, right, "x", "r")
    assert met.columns == ["p", "x", "i", "r"]
    assert sorted((r["p"], r["i"]) for r in met.collect()) == pairs()
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    held = {p for p, _ in pairs()}
    semi = sorted(r["p"] for r in join_points(left, right, "x", "r", "left_semi").collect())
    assert semi == sorted(p for p, _ in points() if p in held)
    outer = join_points(left, right, "x", "r", "left").collect()
    assert sorted((r["p"], r["i"]) for r in outer if r["i"] is not None) == pairs()
    assert sorted(r["p"] for r in outer if r["i"] is None) == sorted(p for p, _ in points() if p not in held)
    assert join_points(left.where("false"), right, "x", "r").count() == 0
    assert join_points(left, right.where("false"), "x", "r").count() == 0
    with pytest.raises(ValueError, match="differ"):
        join_points(left, right.withColumnRenamed("i", "p"), "x", "r")


def test_dates_and_relations(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '2024-01-01', TIMESTAMP_NTZ '2024-01-10'),"
        " ('b', TIMESTAMP_NTZ '2024-01-05', CAST(NULL AS TIMESTAMP_NTZ)), ('c', TIMESTAMP_NTZ '2024-02-01', TIMESTAMP_NTZ '2024-02-02') AS t(_id, lo, hi)"
    ).select("_id", F.struct(F.col("lo").alias("gte"), F.col("hi").alias("lte")).alias("stay"))
    df = df.unionByName(df.limit(1).select(F.lit("none").alias("_id"), F.lit(None).cast(df.schema["stay"].dataType).alias("stay")))
    c = Collection(df, Mapping({"stay": Field("date_range")}))
    ids = lambda condition: sorted(r["_id"] for r in search(c, condition, sort=[], size=None, source=["_id"]).collect())
    assert ids(q.range_relation("stay", "2024-01-08", "2024-01-20")) == ["a", "b"]
    assert ids(q.range_relation("stay", "2024-01-01", "2024-01-31", "within")) == ["a"]
    assert ids(q.range_relation("stay", "2024-01-06", "2024-01-07", "contains")) == ["a", "b"]
    assert ids(~q.range_relation("stay", "2024-01-08", "2024-01-20")) == ["c", "none"]
    assert ids(q.range_relation("stay")) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="relation"):
        q.range_relation("stay", relation="near")
    days = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-06' AS day UNION ALL SELECT TIMESTAMP_NTZ '2024-01-11'")
    met = join_points(days, df, "day", "stay")
    assert sorted((r["day"].day, r["_id"]) for r in met.collect()) == [(6, "a"), (6, "b"), (11, "b")]


def test_totals_of_intervals_equal_those_of_their_pairs_without_pairing(spark):
    left = spark.createDataFrame(points(), "p long, x double")
    right = spark.createDataFrame(intervals() + [(7, (None, None))], "i long, r struct<gte: double, lte: double>")
    wanted = {"n": ("count", "*"), "low": ("min", "x"), "last": ("max", "p"), "all": ("sum", "p")}
    found = join_points(left, right, "x", "r", totals=wanted)
    assert found.columns == ["i", "r", *wanted]
    pair = join_points(left, right, "x", "r").withColumn("at", F.struct("i", "r"))
    # Interval 7 comes twice, with other bounds.
    want = pair.groupBy("i", "r").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("p").alias("last"), F.sum("p").alias("all"))
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and want.count() > 50
    assert join_points(left.where("false"), right, "x", "r", totals=wanted).count() == 0
    assert join_points(left, right.where("false"), "x", "r", totals=wanted).count() == 0
    # All pairs would be 9 * 10^9 rows.
    many = spark.range(300_000).select((F.col("id") % 1000).alias("v"), F.col("id").alias("p"))
    wide = spark.range(30_000).select(F.col("id").alias("i"), F.struct(F.lit(None).cast("long").alias("gte"), F.lit(5000).alias("lte")).alias("r"))
    every = join_points(many, wide, "v", "r", totals={"n": ("count", "*"), "last": ("max", "p")}).groupBy("n", "last").count().collect()
    assert [tuple(r) for r in every] == [(300_000, 299_999, 30_000)]
    with pytest.raises(ValueError, match="inner"):
        join_points(left, right, "x", "r", "left", totals=wanted)
