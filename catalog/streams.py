"""Operations and events that arrive as streams of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.mutating import WHOLE_TABLE, as_operations, bulk_sql, customers, flat, operations
from catalog.registry import query
from siftframe.session import scratch_path, stage
from siftframe.streaming import histogram, ingest


def file_stream(spark, sf, name: str):
    """A table's files as a stream."""
    schema = t.load(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query("stream_bulk", bulk_sql(WHOLE_TABLE))
def stream_bulk(spark, sf):
    ops = as_operations(file_stream(spark, sf, "orders"))
    log = scratch_path(spark, "log")
    base = customers(spark, sf)
    ingest.stream_bulk(ops, base, log, buckets=8).awaitTermination()
    return flat(ingest.current_table(spark, log))


@query("stream_bulk_levels", bulk_sql(WHOLE_TABLE))
def stream_bulk_levels(spark, sf):
    """The same operations in twelve batches by seq, with merges on two levels."""
    store = ingest.open_log(customers(spark, sf), scratch_path(spark, "log"), buckets=4)
    ops = stage(operations(spark, sf), "ops")
    last = ops.agg(F.max("seq")).first()[0] or 0
    for k in range(12):
        batch = ops.where(F.col("seq").between(last * k // 12 + (k > 0), last * (k + 1) // 12))
        ingest.apply_batch(store, batch, k, fanout=3)
    return flat(ingest.current_table(spark, store.root))


EVENTS_SQL = (
    "SELECT make_timestamp(epoch_us(ts) // 21600000000 * 21600000000) AS key, event_type, count(*) AS doc_count,"
    " round(sum(value), 4) AS total FROM events GROUP BY 1, 2"
)


@query("stream_date_histogram", EVENTS_SQL)
def stream_date_histogram(spark, sf):
    buckets = histogram.windowed_counts(
        file_stream(spark, sf, "events"), "ts", "6h", ["event_type"], {"total": F.sum("value")}
    )
    path = scratch_path(spark, "buckets")
    histogram.write_snapshot(buckets, path, scratch_path(spark, "state")).awaitTermination()
    return spark.read.parquet(path).withColumn("total", F.round("total", 4))


@query(
    "stream_date_histogram_append",
    f"WITH b AS ({EVENTS_SQL}) SELECT * FROM b WHERE key + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)",
)
def stream_date_histogram_append(spark, sf):
    buckets = histogram.windowed_counts(
        file_stream(spark, sf, "events"), "ts", "6h", ["event_type"], {"total": F.sum("value")}, watermark="1 day"
    )
    path = scratch_path(spark, "closed")
    histogram.write_closed(buckets, path, scratch_path(spark, "state")).awaitTermination()
    return spark.read.parquet(path).withColumn("total", F.round("total", 4))
