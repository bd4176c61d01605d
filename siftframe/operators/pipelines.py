"""Functions over bucket tables: statistics of buckets and functions from one
bucket to the next.

The sequential functions take the histogram that made the buckets. Its bucket
numbers cut the table into blocks, so that even a table with very many buckets
is worked on in parallel; a block borrows the few rows it needs from the block
before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftframe.operators.buckets import Histogram
from siftframe.session import stage

BLOCK = 65_536


def avg_bucket(buckets: DataFrame, metric: str = "doc_count") -> DataFrame:
    return buckets.agg(F.avg(metric).alias("value"))


def sum_bucket(buckets: DataFrame, metric: str = "doc_count") -> DataFrame:
    return buckets.agg(F.coalesce(F.sum(metric), F.lit(0)).alias("value"))


def max_bucket(buckets: DataFrame, metric: str = "doc_count") -> DataFrame:
    """The highest value and every bucket that reaches it, one row per bucket."""
    return _extreme(buckets, metric, F.max(metric))


def min_bucket(buckets: DataFrame, metric: str = "doc_count") -> DataFrame:
    return _extreme(buckets, metric, F.min(metric))


def _extreme(buckets: DataFrame, metric: str, best: Column) -> DataFrame:
    buckets = stage(buckets, "buckets")  # read twice
    reached = buckets.agg(best.alias("value")).scalar()
    return buckets.where(F.col(metric) == reached).select("key", F.col(metric).alias("value"))


def moving_avg(
    buckets: DataFrame, metric: str, window: int, spec: Histogram, by: list[str] | None = None, name: str = "value"
) -> DataFrame:
    """Mean of a bucket and those of the ``window - 1`` buckets before it that
    the table has: buckets are counted by number, so a gap stays a gap."""
    number, rows, cols = _blocks(buckets, spec, by, reach=window - 1)
    frame = W.partitionBy(*cols).orderBy(number).rangeBetween(-(window - 1), 0)
    return _own_rows(rows.withColumn(name, F.avg(metric).over(frame)))


def derivative(
    buckets: DataFrame, metric: str, spec: Histogram, by: list[str] | None = None, name: str = "value"
) -> DataFrame:
    """Difference to the bucket before; null for the first and after a gap."""
    number, rows, cols = _blocks(buckets, spec, by, reach=1)
    before = F.max(metric).over(W.partitionBy(*cols).orderBy(number).rangeBetween(-1, -1))
    return _own_rows(rows.withColumn(name, F.col(metric) - before))


def cumulative_sum(
    buckets: DataFrame, metric: str, spec: Histogram, by: list[str] | None = None, name: str = "value"
) -> DataFrame:
    """Running total: the total of earlier blocks plus the running total inside
    the block."""
    number, rows, cols = _blocks(stage(buckets, "buckets"), spec, by, reach=0)
    inside = F.sum(metric).over(W.partitionBy(*cols).orderBy(number).rowsBetween(W.unboundedPreceding, 0))
    totals = rows.groupBy(*cols).agg(F.sum(metric).alias("_total"))
    # One row per block of 65 536 buckets.
    earlier = W.partitionBy(*(by or [])).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(*cols, F.sum("_total").over(earlier).alias("_carried"))
    summed = rows.withColumn(name, inside).join(carried, cols)
    total = F.coalesce(F.col(name), F.lit(0)) + F.coalesce("_carried", F.lit(0))
    return _own_rows(summed.withColumn(name, total).drop("_carried"))


def _blocks(buckets: DataFrame, spec: Histogram, by: list[str] | None, reach: int):
    """Rows with their block. A row within ``reach`` of the end of its block is
    copied into the next one, marked as borrowed."""
    size = max(BLOCK, reach)
    number = F.col("_number")
    rows = buckets.withColumn("_number", spec.number(F.col("key")))
    home = F.floor(number / size).cast("bigint")
    near_end = F.pmod(number, F.lit(size)) >= size - reach
    places = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home)) if reach else F.array(home)
    rows = rows.withColumn("_block", F.explode(places))
    rows = rows.withColumn("_borrowed", F.col("_block") != home)
    return number, rows, [*(by or []), "_block"]


def _own_rows(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("_borrowed")).drop("_number", "_block", "_borrowed")
