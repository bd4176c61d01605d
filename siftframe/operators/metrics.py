"""Metric aggregations. All metrics of one request share one aggregation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.operators.search import matching
from siftframe.plans.collection import Collection
from siftframe.plans.conditions import Condition

# Percentiles reported when none are named.
DEFAULT_PERCENTS = (1, 5, 25, 50, 75, 95, 99)


@dataclass(frozen=True)
class Metric:
    """``kind`` of a field. Some kinds give several columns, named after the
    metric: ``price`` of kind stats gives ``price_count``, ``price_min``, ..."""

    kind: str
    field: str
    percents: tuple[float, ...] = DEFAULT_PERCENTS
    exact: bool = False
    rsd: float = 0.02
    accuracy: int = 10_000

    def columns(self, c: Collection, name: str, only: Column | None = None) -> list[tuple[str, Column]]:
        """(label, aggregate) pairs, over the rows where ``only`` holds."""
        slot = c.scope.slot(self.field)
        value = slot.column if only is None else F.when(only, slot.column)
        parts = _list_parts(value, _whole_elements(c, slot.column)) if slot.is_array else _value_parts(value)
        return self._outputs(name, value, parts, slot.is_array)

    def _outputs(self, name: str, value: Column, parts: dict, listed: bool) -> list[tuple[str, Column]]:
        if self.kind in ("avg", "sum", "min", "max", "value_count"):
            return [(name, parts[self.kind])]
        if self.kind == "stats":
            return [(f"{name}_{k}", parts[v]) for k, v in STATS.items()]
        if self.kind in ("geo_bounds", "geo_centroid"):
            return _geo_outputs(self.kind, name, value)
        if listed:
            raise ValueError(f"{self.kind} of the list field {self.field}: explode the list first")
        if self.kind == "extended_stats":
            return [(f"{name}_{k}", parts[v]) for k, v in STATS.items()] + _spread(name, value)
        if self.kind == "cardinality":
            counted = F.count_distinct(value) if self.exact else F.approx_count_distinct(value, self.rsd)
            return [(name, counted)]
        if self.kind == "percentiles":
            shares = [p / 100 for p in self.percents]
            found = F.percentile_approx(value, shares, self.accuracy)
            return [(f"{name}_{percent_label(p)}", F.get(found, F.lit(i))) for i, p in enumerate(self.percents)]
        raise ValueError(f"unknown metric: {self.kind}")


# Outputs of stats, by the metric each repeats.
STATS = {"count": "value_count", "min": "min", "max": "max", "avg": "avg", "sum": "sum"}


def _value_parts(v: Column) -> dict[str, Column]:
    return {
        "avg": F.avg(v),
        "sum": F.coalesce(F.sum(v), F.lit(0)),
        "min": F.min(v),
        "max": F.max(v),
        "value_count": F.count(v),
    }


def _whole_elements(c: Collection, lists: Column) -> bool:
    return isinstance(c.df.select(lists).schema[0].dataType.elementType, T.IntegralType)


def _list_parts(v: Column, whole: bool) -> dict[str, Column]:
    """A metric over a list field sees every element; each list is reduced in
    its row, so the rows are not multiplied. Sums of ``whole`` numbers are exact."""
    kind = "bigint" if whole else "double"
    zero = F.lit(0).cast(kind)
    total = F.sum(F.aggregate(v, zero, lambda a, x: a + F.coalesce(x.cast(kind), zero)))
    number = F.coalesce(F.sum(F.size(F.array_compact(v))), F.lit(0))
    return {
        "avg": F.try_divide(total, number),
        "sum": F.coalesce(total, zero),
        "min": F.min(F.array_min(v)),
        "max": F.max(F.array_max(v)),
        "value_count": number,
    }


def _spread(name: str, v: Column) -> list[tuple[str, Column]]:
    mean, deviation = F.avg(v), F.stddev_pop(v)
    return [
        (f"{name}_sum_of_squares", F.sum(v.cast("double") * v.cast("double"))),
        (f"{name}_variance_population", F.var_pop(v)),
        (f"{name}_variance_sampling", F.var_samp(v)),
        (f"{name}_std_population", deviation),
        (f"{name}_std_sampling", F.stddev_samp(v)),
        (f"{name}_upper", mean + 2 * deviation),
        (f"{name}_lower", mean - 2 * deviation),
    ]


def _geo_outputs(kind: str, name: str, point: Column) -> list[tuple[str, Column]]:
    lat, lon = point.getField("lat"), point.getField("lon")
    if kind == "geo_bounds":
        return [
            (f"{name}_top", F.max(lat)),
            (f"{name}_left", F.min(lon)),
            (f"{name}_bottom", F.min(lat)),
            (f"{name}_right", F.max(lon)),
        ]
    return [
        (f"{name}_lat", F.avg(lat)),
        (f"{name}_lon", F.avg(lon)),
        (f"{name}_count", F.count_if(lat.isNotNull() & lon.isNotNull())),
    ]


def percent_label(p: float) -> str:
    return str(int(p) if float(p).is_integer() else p).replace(".", "_")


def avg(field: str) -> Metric:
    return Metric("avg", field)


def sum_of(field: str) -> Metric:
    return Metric("sum", field)


def min_of(field: str) -> Metric:
    return Metric("min", field)


def max_of(field: str) -> Metric:
    return Metric("max", field)


def value_count(field: str) -> Metric:
    return Metric("value_count", field)


def stats(field: str) -> Metric:
    return Metric("stats", field)


def extended_stats(field: str) -> Metric:
    return Metric("extended_stats", field)


def cardinality(field: str, exact: bool = False, rsd: float = 0.02) -> Metric:
    return Metric("cardinality", field, exact=exact, rsd=rsd)


def percentiles(field: str, *percents: float, accuracy: int = 10_000) -> Metric:
    """Approximate percentiles; see ``exact_percentiles`` for exact ones."""
    return Metric("percentiles", field, percents=percents or DEFAULT_PERCENTS, accuracy=accuracy)


def geo_bounds(field: str) -> Metric:
    return Metric("geo_bounds", field)


def geo_centroid(field: str) -> Metric:
    return Metric("geo_centroid", field)


def aggregate(c: Collection, metrics: dict[str, Metric], condition: Condition | None = None) -> DataFrame:
    """All metrics over the rows of a condition: one row, one scan."""
    rows = matching(c, condition)
    return rows.agg(*metric_columns(c, metrics))


def labelled(c: Collection, metrics: dict[str, Metric] | None, only: Column | None = None) -> list[tuple[str, Column]]:
    return [pair for name, m in (metrics or {}).items() for pair in m.columns(c, name, only)]


def metric_columns(c: Collection, metrics: dict[str, Metric] | None) -> list[Column]:
    return [column.alias(label) for label, column in labelled(c, metrics)]


# Brackets of up to this many rows are ranked directly.
BRACKET_ROWS = 10_000


@dataclass
class _Bracket:
    """The values of the ranks ``first`` and ``last``, which are neighbours, lie
    between ``low`` and ``high``; ``below`` rows lie under ``low``, ``inside``
    rows between the two."""

    first: int
    last: int
    low: float
    high: float
    below: int
    inside: int
    slack: float
    settled: bool = False

    def shares(self) -> tuple[float, float]:
        """Shares of the rows inside between which the ranks must lie."""
        start, end = self.first - self.below, self.last - self.below + 1
        return max(0.0, start / self.inside - self.slack), min(1.0, end / self.inside + self.slack)

    @property
    def open(self) -> bool:
        return not self.settled and self.low < self.high and self.inside > BRACKET_ROWS


def exact_percentiles(
    c: Collection,
    field: str,
    *percents: float,
    condition: Condition | None = None,
    name: str = "p",
    accuracy: int = 20_000,
) -> DataFrame:
    """Exact percentiles with linear interpolation, without sorting the table.

    Every wanted rank starts with all rows as its bracket. A sketch of bounded
    size narrows the bracket to a few 1/accuracy of its rows, a count proves
    that the rank is inside (or widens the next attempt), and this repeats until
    a bracket is one value or few rows. Only those rows are then ranked. NaN
    counts as missing.
    """
    percents = percents or DEFAULT_PERCENTS
    value = c.scope.slot(field).column.cast("double")
    values = matching(c, condition).select(value.alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    labels = [f"{name}_{percent_label(p)}" for p in percents]
    whole = values.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).head()
    if not whole.n:
        return c.df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(x) for x in labels])

    pairs = sorted({_neighbours(p, whole.n) for p in percents})
    row = _ranked_values(values, pairs, whole, accuracy)
    return row.select(*[_interpolated(p, whole.n, pairs).alias(x) for p, x in zip(percents, labels)])


def discrete_percentiles(
    c: Collection,
    field: str,
    *percents: float,
    condition: Condition | None = None,
    name: str = "p",
    accuracy: int = 20_000,
) -> DataFrame:
    """Exact percentiles without interpolation: the least value that the given
    percent of the values do not exceed. Found as by ``exact_percentiles``, so
    no task holds the distinct values. NaN counts as the greatest value."""
    percents = percents or DEFAULT_PERCENTS
    value = c.scope.slot(field).column.cast("double")
    given = matching(c, condition).select(value.alias("v")).where("v IS NOT NULL")
    number = ~F.isnan("v")
    kept = F.when(number, F.col("v"))
    whole = given.agg(
        F.count("*").alias("all"), F.count_if(number).alias("n"), F.min(kept).alias("low"), F.max(kept).alias("high")
    ).head()
    ranks = [max(0, math.ceil(round(p / 100, 12) * whole["all"]) - 1) for p in percents]
    pairs = sorted({(r, r) for r in ranks if r < whole.n})
    row = _ranked_values(given.where(number), pairs, whole, accuracy) if pairs else c.df.sparkSession.range(1)
    beyond = F.lit(float("nan") if whole["all"] else None).cast("double")
    found = {r: F.col(f"a{pairs.index((r, r))}") if r < whole.n else beyond for r in ranks}
    return row.select(*[found[r].alias(f"{name}_{percent_label(p)}") for p, r in zip(percents, ranks)])


def _ranked_values(values: DataFrame, pairs: list[tuple[int, int]], whole: Row, accuracy: int) -> DataFrame:
    """One row with the values ``a`` and ``b`` of the two ranks of every pair."""
    brackets = [_Bracket(*pair, whole.low, whole.high, 0, whole.n, 4.0 / accuracy) for pair in pairs]
    while any(b.open for b in brackets):
        _narrow(values, [b for b in brackets if b.open], accuracy)
    return _values_at(values, brackets)


def _narrow(values: DataFrame, brackets: list[_Bracket], accuracy: int) -> None:
    # Ranks that still share a bracket share its sketch.
    spans = list(dict.fromkeys((b.low, b.high) for b in brackets))
    shares = {span: [x for b in brackets if (b.low, b.high) == span for x in b.shares()] for span in spans}
    sketches = [
        F.percentile_approx(F.when(F.col("v").between(*span), F.col("v")), shares[span], accuracy) for span in spans
    ]
    found = values.agg(*[x.alias(f"c{i}") for i, x in enumerate(sketches)]).head()
    ends = {span: iter(found[i]) for i, span in enumerate(spans)}
    cuts = [(next(ends[b.low, b.high]), next(ends[b.low, b.high])) for b in brackets]
    counts = []
    for i, b in enumerate(brackets):
        # The outermost shares keep the old ends, which are known to hold.
        (first, last), (low, high) = b.shares(), cuts[i]
        low, high = (b.low if first <= 0 else low), (b.high if last >= 1 else high)
        counts += [
            F.count_if(F.col("v") < low).alias(f"below{i}"),
            F.count_if(F.col("v").between(low, high)).alias(f"inside{i}"),
            F.lit(low).alias(f"low{i}"),
            F.lit(high).alias(f"high{i}"),
        ]
    seen = values.agg(*counts).head()
    for i, b in enumerate(brackets):
        low, high, below, count = (seen[f"{x}{i}"] for x in ("low", "high", "below", "inside"))
        if below <= b.first and b.last < below + count:
            # No narrower than before: few distinct values, each in many rows.
            b.settled = (low, high) == (b.low, b.high)
            b.low, b.high, b.below, b.inside = low, high, below, count
        else:
            b.slack *= 16


def _values_at(values: DataFrame, brackets: list[_Bracket]) -> DataFrame:
    """One row with the values ``a`` and ``b`` of every bracket's two ranks: the
    smallest value whose running count passes the rank, over the distinct values
    of the bracket."""
    spans = [
        F.when(
            F.col("v").between(b.low, b.high),
            F.struct(F.lit(i).alias("i"), F.lit(b.first - b.below).alias("a"), F.lit(b.last - b.below).alias("b")),
        )
        for i, b in enumerate(brackets)
        if b.low < b.high
    ]
    known = [
        (F.lit(b.low) if b.low == b.high else F.max(F.when(F.col("i") == i, F.col(side)))).alias(f"{side}{i}")
        for i, b in enumerate(brackets)
        for side in "ab"
    ]
    if not spans:
        return values.sparkSession.range(1).select(*known)
    placed = values.select("v", F.inline(F.array_compact(F.array(*spans))))
    counted = placed.groupBy("i", "a", "b", "v").agg(F.count("*").alias("n"))
    ranked = counted.withColumn("upto", F.sum("n").over(W.partitionBy("i").orderBy("v")))
    passed = [F.min(F.when(F.col("upto") > F.col(side), F.col("v"))).alias(side) for side in "ab"]
    return ranked.groupBy("i").agg(*passed).agg(*known)


def _neighbours(percent: float, total: int) -> tuple[int, int]:
    position = percent / 100 * (total - 1)
    below = int(position)
    return below, min(below + 1, total - 1)


def _interpolated(percent: float, total: int, pairs: list[tuple[int, int]]) -> Column:
    pair = _neighbours(percent, total)
    share = percent / 100 * (total - 1) - pair[0]
    low, high = F.col(f"a{pairs.index(pair)}"), F.col(f"b{pairs.index(pair)}")
    return low + (high - low) * share
