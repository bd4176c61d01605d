"""Sketches that are stored and merged."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftframe.operators import sketches as sk

SPEC = {"users": sk.Distinct("user", 14), "value": sk.Quantiles("value", (1, 50, 99.9), 400)}


@pytest.fixture(scope="module")
def events(spark):
    df = spark.range(30_000).select(
        (F.col("id") % 10).alias("day"),
        F.when(F.col("id") % 97 > 0, F.pmod(F.xxhash64("id"), F.lit(9_000))).alias("user"),
        F.when(F.col("id") % 89 == 0, F.lit(float("nan"))).when(F.col("id") % 83 > 0, F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 100.0, 2)).alias("value"),
    )
    return df.cache()


def exact(rows):
    values = np.sort([r["value"] for r in rows if r["value"] is not None and r["value"] == r["value"]])
    return len({r["user"] for r in rows} - {None}), values


def check(row, users, values):
    assert abs(row["users"] - users) <= 5 * SPEC["users"].error * users
    for percent, name in ((1, "p1"), (50, "p50"), (99.9, "p99_9")):
        found = row[f"value_{name}"]
        ranks = np.searchsorted(values, found, "left"), np.searchsorted(values, found, "right")
        want = percent / 100 * len(values)
        slack = 2 * SPEC["value"].error * len(values) + 1
        assert found in values and ranks[0] - slack <= want <= ranks[1] + slack


def test_merged_over_any_range(spark, events, tmp_path):
    sk.sketched(events, {"day": F.col("day")}, SPEC).write.parquet(str(tmp_path / "s"))
    table = spark.read.parquet(str(tmp_path / "s"))
    rows = events.collect()
    for low, high in ((0, 9), (3, 5), (7, 7)):
        found = sk.estimates(sk.merged(table.where(F.col("day").between(low, high)), {}, SPEC), SPEC).first()
        mine = [r for r in rows if low <= r["day"] <= high]
        assert found["rows"] == len(mine)
        check(found, *exact(mine))
    halves = sk.estimates(sk.merged(table, {"half": F.col("day") >= 5}, SPEC), SPEC).collect()
    assert {r["half"]: r["rows"] for r in halves} == {False: 15_000, True: 15_000}


def test_few_values_are_exact_and_none_is_nothing(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 5.0), ("a", 2, 4.0), ("b", None, None), ("c", 7, float("nan"))], "k string, user int, value double")
    found = {r["k"]: r for r in sk.estimates(sk.sketched(df, {"k": F.col("k")}, SPEC), SPEC).collect()}
    assert (found["a"]["users"], found["a"]["value_p50"], found["a"]["value_p99_9"]) == (2, 4.0, 5.0)
    assert (found["b"]["users"], found["b"]["value_p50"]) == (0, None) and found["c"]["value_p1"] is None
    whole = sk.estimates(sk.merged(sk.sketched(df, {"k": F.col("k")}, SPEC), {}, SPEC), SPEC).first()
    assert (whole["rows"], whole["users"], whole["value_p50"]) == (5, 3, 4.0)
    none = sk.merged(sk.sketched(df.where("false"), {"k": F.col("k")}, SPEC), {}, SPEC)
    assert sk.estimates(none, SPEC).first().asDict() == {"rows": 0, "users": 0, "value_p1": None, "value_p50": None, "value_p99_9": None}


def test_other_types_are_counted_as_text(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS d UNION ALL SELECT DATE '2024-01-02' UNION ALL SELECT DATE '2024-01-01'")
    spec = {"days": sk.Distinct("d")}
    assert sk.estimates(sk.sketched(df, {}, spec), spec).first()["days"] == 2


def test_a_stream_adds_partial_sketches(spark, events, tmp_path):
    for part in range(3):
        events.where(F.col("day") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sk.stream_sketches(stream, {"day": F.col("day")}, SPEC, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    table = sk.read_sketches(spark, str(tmp_path / "out"))
    assert table.count() == 10
    found = sk.estimates(sk.merged(table, {}, SPEC), SPEC).first()
    assert found["rows"] == 30_000
    check(found, *exact(events.collect()))
