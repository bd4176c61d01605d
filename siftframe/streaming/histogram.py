"""Date histograms over a stream of events."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from siftframe.functions import dates


def windowed_counts(
    events: DataFrame,
    time: str,
    interval: str,
    by: list[str] | None = None,
    metrics: dict[str, Column] | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Fixed-interval buckets per key: ``key``, ``doc_count`` and metrics. With
    a watermark, rows that are later than it are dropped and buckets can be
    closed; the state then stays as large as the open buckets."""
    # Watermarks need an instant; a zone-less time counts as UTC, whatever zone
    # the session has.
    zoneless = isinstance(events.schema[time].dataType, T.TimestampNTZType)
    instant = F.timestamp_micros(dates.epoch_micros(F.col(time))) if zoneless else F.col(time)
    timed = events.withColumn("_time", instant)
    if watermark is not None:
        timed = timed.withWatermark("_time", watermark)
    step = f"{dates.fixed_micros(interval)} microseconds"
    grouped = timed.groupBy(F.window("_time", step).alias("_window"), *(by or []))
    counted = grouped.agg(F.count("*").alias("doc_count"), *[m.alias(n) for n, m in (metrics or {}).items()])
    start = F.col("_window.start")
    key = (dates.from_epoch_micros(F.unix_micros(start)) if zoneless else start).alias("key")
    return counted.select(key, *(by or []), "doc_count", *(metrics or {}))


def write_closed(buckets: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append buckets as the watermark closes them, each exactly once."""
    writer = buckets.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def write_snapshot(buckets: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the state of all buckets so far at ``path``, replaced by every batch."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = buckets.writeStream.outputMode("complete").foreachBatch(replace)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped because they came after their bucket was closed.

    A query remembers the progress of its last batches only; once the first is
    forgotten this raises. For long streams count with ``LateRows``.
    """
    kept = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(query.recentProgress) >= kept:
        raise ValueError("progress of early batches is gone: register LateRows before the query starts")
    return sum(
        state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Running count of late rows by query id, over any number of batches:
    ``spark.streams.addListener(late := LateRows())`` before the query starts."""

    def __init__(self) -> None:
        self.dropped: Counter = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] += found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
