"""Fields that hold ranges: points against many intervals.

An interval lies in the bins of a width that its own length chooses: the least
power of two not below it, so it meets at most two bins whether it is long or
short. A point is looked up in one bin of every width that occurs, a few dozen
at most. So points and intervals meet by equality of (width, bin), never all
with all, and the exact bounds decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftframe.session import fits_broadcast, stage

LEAST_LEVEL = -40  # power of two of the narrowest bins; shorter intervals use these


def _level(length: Column) -> Column:
    """Power of two of the bins of an interval of this length; never too small
    for it, whatever the rounding of the logarithm."""
    level = F.ceil(F.log2(F.greatest(length, F.lit(2.0**LEAST_LEVEL)))).cast("int")
    return F.when(F.pow(F.lit(2.0), level) < length, level + 1).otherwise(level)


def _bin(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level))


def as_number(c: Column, kind: str) -> Column:
    """Dates and numbers on one scale: dates as microseconds."""
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def join_points(
    points: DataFrame,
    intervals: DataFrame,
    value: str,
    field: str,
    how: str = "inner",
    totals: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Every pair of a row of ``points`` and a row of ``intervals`` (a column
    ``field`` of gte and lte, both included) that holds its ``value``.

    A null bound is open. Intervals with lte below gte hold nothing; rows
    without an interval or value, or with one that is not a number, meet
    nothing. ``how`` is inner, left (points without an interval stay) or
    left_semi. Column names of the two tables must differ. Repeated rows pair
    each. A bin that many points fall into is split by adaptive execution.

    Intervals are first clipped to the least and greatest point, which closes
    open ones and changes nothing about the points they hold.

    ``totals`` (name: kind and column of the points, of the kinds in ``TOTALS``)
    gives one row per interval that holds a point, with these figures over all of
    its points, in place of the pairs, whose number may grow with the product of
    both tables.
    """
    if totals and (how != "inner" or set(totals) & set(intervals.columns)):
        raise ValueError("totals need an inner join and names of their own")
    kind = points.schema[value].dataType.simpleString()
    low, high = (as_number(F.col(f"`{field}`")[b], intervals.schema[field].dataType[b].dataType.simpleString()) for b in ("gte", "lte"))
    number = as_number(F.col(f"`{value}`"), kind)
    key = [*points.columns, *intervals.columns]
    names = {n: f"_iv_{n}" for n in ("x", "low", "high", "level", "bin", "id")}
    if set(names.values()) & set(key) or len(set(key)) < len(key):
        raise ValueError("column names of points and intervals must differ")
    rows = intervals.where(F.col(f"`{field}`").isNotNull()).withColumns({names["low"]: low, names["high"]: high})
    nan = F.coalesce(F.isnan(names["low"]), F.lit(False)) | F.coalesce(F.isnan(names["high"]), F.lit(False))
    rows = rows.where(~nan & (F.coalesce(F.col(names["low"]) <= F.col(names["high"]), F.lit(True))))
    low, high = F.col(names["low"]), F.col(names["high"])
    numbered = points.withColumn(names["x"], number)
    if how != "inner":
        # Written, so that a row keeps its number.
        numbered = stage(numbered.withColumn(names["id"], F.monotonically_increasing_id()), "points")
    x = F.col(names["x"])
    some = numbered.where(x.isNotNull() & ~F.isnan(x))
    ends = some.agg(F.min(x).alias("least"), F.max(x).alias("most")).first()
    least, most = ends["least"] or 0.0, ends["most"] or 0.0
    clipped = {names["low"]: F.greatest(low, F.lit(least)), names["high"]: F.least(high, F.lit(most))}
    rows = rows.withColumns(clipped).where(low <= high)
    if totals:
        return _totals(some, rows, names, totals).select(*[F.col(f"`{c}`") for c in intervals.columns], *totals)

    binned = rows.withColumn(names["level"], _level(high - low))
    level = F.col(names["level"])
    binned = binned.withColumn(names["bin"], F.explode(F.array_distinct(F.array(_bin(low, level), _bin(high, level)))))
    # One row per width that occurs, a power of two.
    levels = sorted(r[0] for r in binned.select(names["level"]).distinct().collect())
    spread = some.withColumn(names["level"], F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    spread = spread.withColumn(names["bin"], _bin(x, level))
    side = F.broadcast(binned) if fits_broadcast(binned) else binned
    met = spread.join(side, [names["level"], names["bin"]]).where((x >= low) & (x <= high))
    met = met.drop(names["level"], names["bin"])
    extra = [names[n] for n in ("x", "low", "high")]
    if how == "inner":
        return met.drop(*extra)
    found = met.select(names["id"]).distinct()
    if how == "left_semi":
        return numbered.join(found, names["id"], "left_semi").select(*[F.col(f"`{c}`") for c in points.columns])
    alone = numbered.join(found, names["id"], "left_anti")
    return met.unionByName(alone, allowMissingColumns=True).drop(*extra, names["id"])


# Figures that can be put together from those of parts.
TOTALS = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def _totals(points: DataFrame, intervals: DataFrame, names: dict[str, str], totals: dict[str, tuple[str, str]]) -> DataFrame:
    """Figures over the points of each interval, without the pairs.

    The distinct points are numbered in ascending order, and an interval becomes
    a span of numbers. Spans of 1, 2, 4, ... numbers that begin at a multiple of
    their length have their figures worked out once, and every span is put
    together from at most two of each length.
    """
    x, low, high = names["x"], names["low"], names["high"]
    combined = [TOTALS[kind][1](F.col(f"`{n}`")).alias(n) for n, (kind, _) in totals.items()]
    first = [TOTALS[kind][0](F.lit(1) if c == "*" else F.col(f"`{c}`")).alias(n) for n, (kind, c) in totals.items()]
    leaves = stage(points.groupBy(F.col(x).alias("_iv_v")).agg(*first), "leaves")

    # Ends and points in one order: a value's place is the number of points up to it.
    bounds = [intervals.select(F.col(c).alias("_iv_v"), F.lit(0).alias("_iv_is")) for c in (low, high)]
    values = leaves.select("_iv_v", F.lit(1).alias("_iv_is")).unionByName(bounds[0]).unionByName(bounds[1])
    values = stage(values.groupBy("_iv_v").agg(F.max("_iv_is").alias("_iv_is")).orderBy("_iv_v"), "values")
    values = values.select("*", F.col("_metadata.file_name").alias("_iv_file"))
    # One row per file, each a range of values.
    files = values.groupBy("_iv_file").agg(F.sum("_iv_is").alias("n"), F.min("_iv_v").alias("least"))
    before = F.coalesce(F.sum("n").over(W.orderBy("least").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = F.broadcast(files.select("_iv_file", before.alias("_iv_before")))
    inside = F.sum("_iv_is").over(W.partitionBy("_iv_file").orderBy("_iv_v").rowsBetween(W.unboundedPreceding, 0))
    places = values.withColumn("_iv_inside", inside).join(files, "_iv_file")
    places = stage(places.select("_iv_v", "_iv_is", (F.col("_iv_before") + F.col("_iv_inside")).alias("_iv_upto")), "places")

    start = places.select(F.col("_iv_v").alias(low), (F.col("_iv_upto") - F.col("_iv_is")).alias("_iv_start"))
    end = places.select(F.col("_iv_v").alias(high), F.col("_iv_upto").alias("_iv_end"))
    spanned = intervals.join(start, low).join(end, high).where("_iv_start < _iv_end")
    spanned = stage(spanned.drop(x, low, high), "spans")

    depth = max(1, leaves.count().bit_length())
    numbered = leaves.join(places.where("_iv_is = 1"), "_iv_v").withColumn("_iv_at", F.col("_iv_upto") - 1)
    levels = F.explode(F.array(*[F.struct(F.lit(n).alias("_iv_level"), F.shiftright("_iv_at", n).alias("_iv_node")) for n in range(depth)]))
    nodes = numbered.select(*totals, levels.alias("_iv_n")).select(*totals, "_iv_n.*").groupBy("_iv_level", "_iv_node").agg(*combined)
    nodes = stage(nodes, "nodes")

    parts = []
    for n in range(depth):
        left, right = F.shiftright(F.col("_iv_start") + (2**n - 1), n), F.shiftright("_iv_end", n)
        for odd, node in ((left, left), (right, right - 1)):
            taken = F.struct(F.lit(n).alias("_iv_level"), node.alias("_iv_node"))
            parts.append(F.when((left < right) & (odd % 2 == 1), taken))
    pieces = spanned.select("_iv_start", "_iv_end").distinct()
    pieces = pieces.select("_iv_start", "_iv_end", F.explode(F.array_compact(F.array(*parts))).alias("_iv_n"))
    pieces = pieces.select("_iv_start", "_iv_end", "_iv_n.*")
    met = pieces.join(F.broadcast(nodes) if fits_broadcast(nodes) else nodes, ["_iv_level", "_iv_node"])
    figures = met.groupBy("_iv_start", "_iv_end").agg(*combined)
    return spanned.join(figures, ["_iv_start", "_iv_end"])
