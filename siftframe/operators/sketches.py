"""Stored sketches: distinct counts and quantiles that merge.

A sketch table has one row per key (a day, a type, ...) with a sketch of each
field's distinct values or of its distribution. Rows merge over any coarser key
and over any range, so a month is read from thirty rows and not from its
events. A stream adds a table of partial sketches per micro-batch; nothing is
kept in state and late events count like any other.

Errors are the sketches' own: a distinct count is off by about
``1.04 / sqrt(2^lg_k)`` (one standard error) and exact while few values are in
it (about 2^lg_k / 11); a quantile's rank is off by about ``2.3 / k`` and exact
up to k values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Distinct:
    """Distinct values of a field; nulls do not count."""

    field: str
    lg_k: int = 12

    @property
    def error(self) -> float:
        """One standard error, as a share of the count."""
        return 1.04 / math.sqrt(2**self.lg_k)

    def sketch(self, df: DataFrame) -> Column:
        value = F.col(self.field)
        if not isinstance(df.select(value).schema[0].dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
            value = value.cast("string")
        return F.hll_sketch_agg(value, F.lit(self.lg_k))

    def merged(self, name: str) -> Column:
        return F.hll_union_agg(name)

    def estimates(self, name: str) -> dict[str, Column]:
        return {name: F.coalesce(F.hll_sketch_estimate(name), F.lit(0).cast("bigint"))}


@dataclass(frozen=True)
class Quantiles:
    """Distribution of a numeric field, read at ``percents``; nulls and NaN do
    not count. A percentile is a value of the field, null where there is none."""

    field: str
    percents: tuple[float, ...] = (50,)
    k: int = 200

    @property
    def error(self) -> float:
        """Error of a value's rank that is rarely passed, as a share of the values."""
        return 2.3 / self.k

    def sketch(self, df: DataFrame) -> Column:
        value = F.col(self.field).cast("double")
        return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), self.k)

    def merged(self, name: str) -> Column:
        return F.kll_merge_agg_double(name, self.k)

    def estimates(self, name: str) -> dict[str, Column]:
        label = lambda p: f"{p:g}".replace(".", "_")
        some = F.kll_sketch_get_n_double(name) > 0
        return {f"{name}_p{label(p)}": F.when(some, F.kll_sketch_get_quantile_double(name, F.lit(p / 100))) for p in self.percents}


Sketches = dict[str, Distinct | Quantiles]


def sketched(df: DataFrame, keys: dict[str, Column], sketches: Sketches) -> DataFrame:
    """One row per key with ``rows``, their number, and the sketches. Sketches
    are built map-side and merged, so a key that many rows share is no burden."""
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.count("*").alias("rows"), *[s.sketch(df).alias(n) for n, s in sketches.items()]
    )


def merged(table: DataFrame, keys: dict[str, Column], sketches: Sketches) -> DataFrame:
    """The rows of a sketch table merged over coarser keys (none: all of them)."""
    grouped = table.groupBy(*[c.alias(n) for n, c in keys.items()])
    return grouped.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[s.merged(n).alias(n) for n, s in sketches.items()])


def estimates(table: DataFrame, sketches: Sketches) -> DataFrame:
    """What the sketches say, in place of the sketches themselves."""
    others = [n for n in table.columns if n not in sketches]
    found = {n: c for name, s in sketches.items() for n, c in s.estimates(name).items()}
    return table.select(*others, *[c.alias(n) for n, c in found.items()])


def stream_sketches(
    events: DataFrame, keys: dict[str, Column], sketches: Sketches, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Add the partial sketches of every micro-batch to the table at ``path``. A
    batch that comes again overwrites its own folder with the same rows."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        sketched(batch, keys, sketches).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """All partial sketches of a stream so far; merge them before reading them."""
    return spark.read.option("basePath", path).parquet(path).drop("batch")
