"""Bucket aggregations: one row per bucket with ``key``, ``doc_count``, metrics."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftframe.functions import dates, geo
from siftframe.operators.metrics import Metric, labelled, metric_columns
from siftframe.operators.numbering import numbered
from siftframe.operators.search import TOP_ROWS, matching
from siftframe.plans.collection import Collection
from siftframe.plans.conditions import Condition, Exists, lifted
from siftframe.session import stage

DEFAULT_TERMS = 10


@dataclass(frozen=True)
class Terms:
    """The ``size`` most frequent values; ties by value. A list field counts a
    row once per distinct element. ``order_by`` is ``_count``, ``_key`` or the
    name of a metric."""

    field: str
    size: int = DEFAULT_TERMS
    order_by: str = "_count"
    order: str = "desc"

    @property
    def top(self) -> int:
        return self.size if self.size > 0 else DEFAULT_TERMS

    def keys(self, c: Collection) -> tuple[Column, bool]:
        slot = c.scope.slot(self.field)
        return (F.array_distinct(slot.terms()), True) if slot.many else (slot.column, False)

    def orderings(self, key: str, doc_count: str = "doc_count", metric_prefix: str = "") -> list[Column]:
        named = {"_count": doc_count, "_key": key}.get(self.order_by, metric_prefix + self.order_by)
        first = F.col(f"`{named}`")
        first = first.asc_nulls_last() if self.order == "asc" else first.desc_nulls_last()
        return [first] if self.order_by == "_key" else [first, F.col(f"`{key}`").asc()]


@dataclass(frozen=True)
class Histogram:
    """Equal steps over numbers. Buckets are grouped by their whole number, so
    gaps between the first and the last are a sequence of integers."""

    field: str
    interval: float

    def ordinal(self, c: Column) -> Column:
        return F.floor(c / F.lit(self.interval)).cast("bigint")

    def key(self, ordinal: Column) -> Column:
        return (ordinal * F.lit(self.interval)).cast("double")

    def number(self, key: Column) -> Column:
        """Bucket number of a bucket's own key."""
        return F.round(key / F.lit(self.interval)).cast("bigint")

    def keys(self, c: Collection) -> tuple[Column, bool]:
        slot = c.scope.slot(self.field)
        if slot.is_array:
            return F.array_distinct(F.transform(slot.column, self.ordinal)), True
        return self.ordinal(slot.column), False


# Months per calendar unit.
UNIT_MONTHS = {"month": 1, "quarter": 3, "year": 12}
# Microseconds per unit of constant length without a time zone.
UNIT_MICROS = {"minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}
# The epoch was a Thursday; weeks start on the Monday before it.
WEEK_START_MICROS = -3 * 86_400_000_000


@dataclass(frozen=True)
class DateHistogram(Histogram):
    """Calendar steps: minute, hour, day, week (from Monday), month, quarter, year."""

    interval: str = "1d"

    def ordinal(self, c: Column) -> Column:
        unit = dates.calendar_unit(self.interval)
        if unit in UNIT_MONTHS:
            months = F.year(c) * 12 + F.month(c) - 1
            return _whole(months.cast("bigint"), UNIT_MONTHS[unit])
        shift = WEEK_START_MICROS if unit == "week" else 0
        return _whole(dates.epoch_micros(c) - shift, UNIT_MICROS[unit])

    def key(self, ordinal: Column) -> Column:
        unit = dates.calendar_unit(self.interval)
        if unit in UNIT_MONTHS:
            months = ordinal * UNIT_MONTHS[unit]
            year = _whole(months, 12)
            return F.make_date(year.cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1)).cast(
                "timestamp_ntz"
            )
        shift = WEEK_START_MICROS if unit == "week" else 0
        return dates.from_epoch_micros(ordinal * UNIT_MICROS[unit] + shift)

    def number(self, key: Column) -> Column:
        return self.ordinal(key)


@dataclass(frozen=True)
class FixedDateHistogram(Histogram):
    """Steps of constant length, aligned to the epoch: ``30s``, ``5m``, ``6h``."""

    interval: str = "1h"

    def ordinal(self, c: Column) -> Column:
        return _whole(dates.epoch_micros(c), dates.fixed_micros(self.interval))

    def key(self, ordinal: Column) -> Column:
        return dates.from_epoch_micros(ordinal * dates.fixed_micros(self.interval))

    def number(self, key: Column) -> Column:
        return self.ordinal(key)


def _whole(c: Column, step: int) -> Column:
    """Floor division of whole numbers, exact also below zero."""
    return ((c - F.pmod(c, F.lit(step))) / step).cast("bigint")


@dataclass(frozen=True)
class Filters:
    """One bucket per named condition; a row may fall into several."""

    conditions: dict[str, Condition]

    def tests(self, c: Collection) -> dict[str, Column]:
        return {name: lifted(cond).truth(c.scope) for name, cond in self.conditions.items()}

    def keys(self, c: Collection) -> tuple[Column, bool]:
        hits = [F.when(test, F.lit(name)) for name, test in self.tests(c).items()]
        return F.array_compact(F.array(*hits)), True


@dataclass(frozen=True)
class Ranges(Filters):
    """Buckets ``{key?, from?, to?}`` over a field: from inclusive, to
    exclusive. Ranges may overlap, and empty ones are reported."""

    field: str = ""
    ranges: tuple[dict, ...] = ()
    now: dt.datetime | None = None

    def bound(self, value: Any) -> Column:
        return F.lit(value)

    def value(self, c: Collection) -> Column:
        return c.scope.slot(self.field).column

    def tests(self, c: Collection) -> dict[str, Column]:
        slot_many = self.field in c.df.columns and c.scope.slot(self.field).is_array
        tests = {}
        for r in self.ranges:
            def inside(v: Column, r=r) -> Column:
                test = v.isNotNull()
                if r.get("from") is not None:
                    test = test & (v >= self.bound(r["from"]))
                if r.get("to") is not None:
                    test = test & (v < self.bound(r["to"]))
                return test

            value = self.value(c)
            test = F.exists(value, inside) if slot_many else inside(value)
            tests[range_key(r)] = F.coalesce(test, F.lit(False))
        return tests


@dataclass(frozen=True)
class DateRanges(Ranges):
    """Ranges of dates; bounds may be expressions such as ``now-7d/d``."""

    def bound(self, value: Any) -> Column:
        return dates.timestamp_literal(dates.resolve_date(value, self.now))


@dataclass(frozen=True)
class GeoRings(Ranges):
    """Ranges of the distance in metres from a point."""

    origin: tuple[float, float] = (0.0, 0.0)

    def value(self, c: Collection) -> Column:
        point = c.scope.slot(self.field).column
        return geo.haversine(point.getField("lat"), point.getField("lon"), *self.origin)

    def bound(self, value: Any) -> Column:
        return F.lit(geo.metres(value))


def range_key(r: dict) -> str:
    if r.get("key") is not None:
        return r["key"]
    ends = ["*" if r.get(side) is None else str(r[side]) for side in ("from", "to")]
    return "-".join(ends)


def ranges(field: str, *bounds: dict) -> Ranges:
    return Ranges({}, field, bounds)


def date_ranges(field: str, *bounds: dict, now: dt.datetime | None = None) -> DateRanges:
    return DateRanges({}, field, bounds, now)


def geo_rings(field: str, origin: tuple[float, float], *bounds: dict) -> GeoRings:
    return GeoRings({}, field, bounds, None, origin)


# --- single-level buckets -------------------------------------------------


def buckets(
    c: Collection,
    spec: Terms | Histogram | Filters,
    metrics: dict[str, Metric] | None = None,
    condition: Condition | None = None,
) -> DataFrame:
    """One row per bucket over the rows of a condition."""
    rows = c.with_df(matching(c, condition))
    if isinstance(spec, Filters):
        return _conditional_buckets(rows, spec.tests(c), metrics)
    if isinstance(spec, Histogram):
        return _histogram(rows, spec, metrics)
    return _terms(rows, spec, metrics)


def _grouped(c: Collection, spec, metrics) -> DataFrame:
    keys, many = spec.keys(c)
    keyed = c.df.withColumn("_key", F.explode(keys) if many else keys).where(F.col("_key").isNotNull())
    grouped = keyed.groupBy("_key").agg(F.count("*").alias("doc_count"), *metric_columns(c, metrics))
    return grouped.withColumnRenamed("_key", "key")


def _terms(c: Collection, spec: Terms, metrics) -> DataFrame:
    grouped = _grouped(c, spec, metrics)
    found = top_rows(grouped, spec.orderings("key"), spec.top)
    keys, many = spec.keys(c)
    weight = F.sum(F.size(keys)) if many else F.count(keys)
    everything = c.df.agg(weight.cast("bigint").alias("all")).scalar()
    if spec.top <= TOP_ROWS:
        # One frame over the few rows that are left spares their second making.
        shown = F.sum("doc_count").over(W.partitionBy())
    else:
        # These rows were written by ``top_rows`` and are only read again.
        shown = F.coalesce(found.agg(F.sum("doc_count").alias("shown")).scalar(), F.lit(0))
    return found.withColumn("sum_other_doc_count", everything - shown)


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in order: a per-task top-n, or a distributed sort when
    ``n`` is too large to be kept by a task."""
    if n <= TOP_ROWS:
        return df.orderBy(*order).limit(n)
    rows = numbered(stage(df.orderBy(*order), "sorted"))
    return rows.where(F.col("_position") < n).drop("_position")


def _histogram(c: Collection, spec: Histogram, metrics) -> DataFrame:
    filled = fill_gaps(_grouped(c, spec, metrics), "key")
    return filled.withColumn("key", spec.key(F.col("key")))


# Bucket numbers that one step of the gap filling writes out at a time.
_SPINE_BLOCK = 4096
# Buckets that gaps between two keys of one parent may be filled up to.
MAX_BUCKETS = 10_000_000


def fill_gaps(grouped: DataFrame, ordinal: str, by: list[str] | None = None) -> DataFrame:
    """Add empty buckets between the first and the last bucket number, per
    parent if ``by`` names its keys. Numbers are laid out block by block, so a
    long span is spread over tasks instead of being one long list. A span of
    more than ``MAX_BUCKETS`` fails with an error that names its ends."""
    by = by or []
    # The last bucket is taken with all of its columns: both readers of the bucket
    # table then want the same ones and share its aggregation, instead of each
    # scanning the rows behind it.
    others = [n for n in grouped.columns if n not in (ordinal, *by)]
    ends = grouped.groupBy(*by).agg(F.min(ordinal).alias("_lo"), F.max(F.struct(ordinal, *others)).alias("_last"))
    ends = ends.select(*by, "_lo", F.col(f"_last.{ordinal}").alias("_hi")).where(F.col("_lo").isNotNull())
    # Two outliers may span more steps than any table can hold: an error, not a flood of empty rows.
    few = F.col("_hi") - F.col("_lo") < MAX_BUCKETS
    many = F.raise_error(F.concat(F.lit(f"more than {MAX_BUCKETS} buckets, filled up from "), "_lo", F.lit(" to "), "_hi"))
    starts = F.sequence("_lo", F.when(few, F.col("_hi")).otherwise(many.cast("bigint")), F.lit(_SPINE_BLOCK).cast("bigint"))
    blocks = ends.select(*by, "_hi", F.explode(starts).alias("_start")).repartition(*by, "_start")
    within = F.sequence("_start", F.least(F.col("_start") + _SPINE_BLOCK - 1, F.col("_hi")))
    spine = blocks.select(*by, F.explode(within).alias(ordinal))
    filled = spine.join(grouped, [*by, ordinal], "left")
    return filled.withColumn("doc_count", F.coalesce("doc_count", F.lit(0)))


def _conditional_buckets(c: Collection, tests: dict[str, Column], metrics) -> DataFrame:
    """Overlapping buckets in one pass: every bucket is a conditional aggregate
    of the same scan, not a copy of the rows."""
    names = list(tests)
    flags = c.df.withColumns({f"_in{i}": tests[n] for i, n in enumerate(names)})
    columns = []
    for i in range(len(names)):
        inside = F.col(f"_in{i}")
        columns.append(F.count_if(inside).alias(f"b{i}_doc_count"))
        for label, column in labelled(c, metrics, inside):
            columns.append(column.alias(f"b{i}_{label}"))
    labels = [label for label, _ in labelled(c, metrics)]
    wide = flags.agg(*columns)
    rows = [
        F.struct(
            F.lit(name).alias("key"),
            F.col(f"b{i}_doc_count").alias("doc_count"),
            *[F.col(f"b{i}_{label}").alias(label) for label in labels],
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def filter_bucket(
    c: Collection, inside: Condition, metrics: dict[str, Metric] | None = None, condition: Condition | None = None
) -> DataFrame:
    """One bucket: rows of the request that also satisfy ``inside``."""
    found = buckets(c, Filters({"filter": inside}), metrics, condition)
    return found.drop("key")


def missing(
    c: Collection, field: str, metrics: dict[str, Metric] | None = None, condition: Condition | None = None
) -> DataFrame:
    """One bucket: rows whose field is null or an empty list."""
    return filter_bucket(c, ~Exists(field), metrics, condition)


# --- nested levels --------------------------------------------------------


@dataclass(frozen=True)
class Level:
    """One level of nested buckets: its name, how rows fall into buckets, and
    the metrics reported for each of its buckets."""

    name: str
    spec: Any
    metrics: dict[str, Metric] | None = None


def nested_buckets(c: Collection, levels: list[Level], condition: Condition | None = None) -> DataFrame:
    """Buckets inside buckets, one row per innermost bucket: for every level its
    key, its row count ``<level>_count`` and metrics ``<level>_<metric>``.

    Each level keeps its own top ``size`` below every parent that survives, and
    the metrics of every level come from the rows themselves. Histograms fill
    their gaps and empty ranges and filters are listed at every level; a bucket
    without children is one row with null child keys and counts 0. All levels are
    grouping sets of one pass over the rows, unless a level inside another may
    put a row into several buckets; then each level is grouped by itself.
    """
    rows = c.with_df(matching(c, condition))
    # Equal metrics of several levels are worked out once; names belong to a level.
    metrics: dict[str, Metric] = {}
    named = []
    for level in levels:
        own: dict[str, str] = {}
        for k, metric in (level.metrics or {}).items():
            known = [n for n, m in metrics.items() if m == metric]
            own[k] = known[0] if known else f"_m{len(metrics)}_"
            metrics[own[k]] = metric
        named.append(own)
    levels = [_ordered_by(level, own) for level, own in zip(levels, named)]
    labels = {n: [label for label, _ in m.columns(c, n)] for n, m in metrics.items()}
    measures = ["doc_count", *(label for found in labels.values() for label in found)]
    keys = [f"_k{i}" for i in range(len(levels))]
    sources = [level.spec.keys(rows) for level in levels]
    if any(many for _, many in sources[1:]):
        table = _levels_apart(rows, keys, sources, metrics)
    else:
        table = _levels_together(rows, keys, sources, metrics)
    # The bucket table is read several times from here on; written once, the
    # rows behind it are scanned once.
    leaves = _surviving(rows, stage(table, "buckets"), keys, levels, measures)
    out = []
    for i, level in enumerate(levels):
        key = level.spec.key(F.col(keys[i])) if isinstance(level.spec, Histogram) else F.col(keys[i])
        own = "" if i == len(levels) - 1 else f"_up{i}_"
        out += [key.alias(level.name), F.coalesce(F.col(f"`{own}doc_count`"), F.lit(0)).alias(f"{level.name}_count")]
        for k, n in named[i].items():
            out += [F.col(f"`{own}{x}`").alias(f"{level.name}_{k}{x.removeprefix(n)}") for x in labels[n]]
    return leaves.select(*out)


def _ordered_by(level: Level, names: dict[str, str]) -> Level:
    """The level with the metric that orders its terms by its column's name."""
    order = getattr(level.spec, "order_by", None)
    for k, n in names.items():
        if order is not None and (order == k or order.startswith(k + "_")):
            return replace(level, spec=replace(level.spec, order_by=n + order.removeprefix(k)))
    return level


def _levels_together(c: Collection, keys: list[str], sources, metrics) -> DataFrame:
    keyed = c.df
    for name, (key, many) in zip(keys, sources):
        keyed = keyed.withColumn(name, F.explode(key) if many else key)
    keyed = keyed.where(F.col(keys[0]).isNotNull())
    sets = [[F.col(n) for n in keys[: i + 1]] for i in range(len(keys))]
    grouped = keyed.groupingSets(sets, *[F.col(n) for n in keys]).agg(
        F.grouping_id().alias("_gid"), F.count("*").alias("doc_count"), *metric_columns(c, metrics)
    )
    # The deeper the level, the fewer keys are grouped away.
    depth = {2 ** (len(keys) - 1 - i) - 1: i for i in range(len(keys))}
    level_no = F.coalesce(*[F.when(F.col("_gid") == gid, F.lit(i)) for gid, i in depth.items()])
    table = grouped.withColumn("_level", level_no).drop("_gid")
    # A row without a key at some level has no bucket there or below.
    present = F.lit(True)
    for i, name in enumerate(keys):
        present = present & ((F.col("_level") < i) | F.col(name).isNotNull())
    return table.where(present)


def _levels_apart(c: Collection, keys: list[str], sources, metrics) -> DataFrame:
    parts = None
    keyed = c.df
    for i, (name, (key, many)) in enumerate(zip(keys, sources)):
        keyed = keyed.withColumn(name, F.explode(key) if many else key).where(F.col(name).isNotNull())
        grouped = keyed.groupBy(*keys[: i + 1]).agg(F.count("*").alias("doc_count"), *metric_columns(c, metrics))
        grouped = grouped.withColumn("_level", F.lit(i))
        parts = grouped if parts is None else parts.unionByName(grouped, allowMissingColumns=True)
    return parts


def _surviving(c: Collection, table: DataFrame, keys: list[str], levels: list[Level], measures: list[str]) -> DataFrame:
    """Buckets of the innermost level below every parent that survives, with the
    count and metrics of every parent beside them. A parent without children
    stays, with null keys from there on."""
    found = None
    for i, level in enumerate(levels):
        here = table.where(F.col("_level") == i).select(*keys[: i + 1], *[f"`{x}`" for x in measures])
        parents = found.withColumnsRenamed({x: f"_up{i - 1}_{x}" for x in measures}) if i else None
        if isinstance(level.spec, Terms):
            # Spark cuts every task to the top rows before it shuffles for the
            # rank, so a parent with very many children is no hot spot.
            if i:
                frame = W.partitionBy(*keys[:i]).orderBy(*level.spec.orderings(keys[i]))
                here = here.withColumn("_rank", F.row_number().over(frame))
                here = here.where(F.col("_rank") <= level.spec.top).drop("_rank")
            else:
                here = top_rows(here, level.spec.orderings(keys[0]), level.spec.top)
        elif isinstance(level.spec, Histogram):
            here = here.join(parents.select(*keys[:i]), keys[:i], "left_semi") if i else here
            here = fill_gaps(here, keys[i], keys[:i])
        else:
            # Every range or filter is a bucket of every parent, empty or not.
            each = F.explode(F.array(*[F.lit(name) for name in level.spec.tests(c)])).alias(keys[i])
            spine = c.df.sparkSession.range(1).select(each)
            if i:
                spine = parents.where(F.col(keys[i - 1]).isNotNull()).select(*keys[:i], each)
            here = spine.join(here, keys[: i + 1], "left")
        found = parents.join(here, keys[:i], "left") if i else here
    return found
