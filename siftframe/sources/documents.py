"""Reading tables and putting documents together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftframe.plans.collection import Collection
from siftframe.plans.conditions import Condition, where
from siftframe.sources.mapping import Mapping


def read_collection(spark: SparkSession, path: str, mapping: Mapping | None = None, id: str = "_id") -> Collection:
    """A parquet table as a collection."""
    return Collection(spark.read.parquet(path), mapping or Mapping(), id)


def spread(df: DataFrame) -> DataFrame:
    """Spread a table of few, unsplittable files over the cores before heavy
    work per row. A table with enough splits is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def alias_view(c: Collection, name: str, condition: Condition | None = None) -> DataFrame:
    """A named view of the collection, limited to the rows of a condition. The
    filter stays part of every query on the view and reaches the scan."""
    view = where(c.df, condition, c.scope)
    view.createOrReplaceTempView(name)
    return view


def document(**fields: Column) -> Column:
    """An object column from scalar, object and list columns."""
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def list_of(*values: Column) -> Column:
    return F.array(*values)


def gather_objects(parents: DataFrame, children: DataFrame, on: str, into: str, order: str) -> DataFrame:
    """Add a list of objects to each parent: its child rows in ``order``. The
    list is a document's own field, so it is as long as a document is."""
    names = [n for n in children.columns if n != on]
    entries = F.array_sort(F.collect_list(F.struct(order, *[n for n in names if n != order])))
    lists = children.groupBy(on).agg(entries.alias(into))
    empty = F.array().cast(lists.schema[into].dataType)
    return parents.join(lists, on, "left").withColumn(into, F.coalesce(into, empty))


def parse_documents(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Spread a JSON text column into the fields of ``schema``."""
    return df.withColumn("_doc", F.from_json(column, schema)).select("*", "_doc.*").drop("_doc")


def flattened_get(column: str, key: str) -> Column:
    """Value of a key of a flattened (map) field, null when it is absent."""
    return F.try_element_at(F.col(column), F.lit(key))
