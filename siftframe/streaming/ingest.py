"""Bulk operations arriving as a stream, kept in levels.

The table is a sequence of runs: the base, then what each micro-batch changed.
A run has one row per id, in buckets by a hash of the id. When a level holds
``FANOUT`` runs they are merged into one run of the next level, the latest row
of an id winning, so the number of runs follows the logarithm of the number of
batches. A batch reads only the buckets of the ids it touches, in these runs.

Runs are the folders of a versioned table (``sources.snapshots``). A batch
publishes its changes together with its number, so it is applied exactly once
however often Spark hands it over, and readers see whole batches only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siftframe.operators.mutate import bulk
from siftframe.sources.snapshots import Snapshot, Snapshots

BUCKETS = 64  # of a new log; a log keeps the number it began with
FANOUT = 8  # runs of a level before they are merged
STEP = 100  # run numbers between batches: those in between are merged runs
CHANGES = "changes"


def _bucket(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def _laid_out(rows: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """Rows ready to be written by bucket, one file for each."""
    return rows.withColumn("bucket", _bucket(id_col, buckets)).repartition("bucket").sortWithinPartitions("bucket", id_col)


def open_log(base: DataFrame, log: str, id_col: str = "_id", buckets: int = BUCKETS) -> Snapshots:
    """The log at ``log``; a new one begins with a copy of ``base`` in buckets."""
    store = Snapshots(base.sparkSession, log)
    if not store.versions():
        rows = _laid_out(base.withColumn("_deleted", F.lit(False)), id_col, buckets)
        schema = T.StructType([f for f in rows.schema.fields if f.name != "bucket"])
        schema = schema.add("run", T.LongType()).add("bucket", T.IntegerType())
        with store.commit() as commit:
            commit.append(CHANGES, rows, "run=0", ["bucket"], schema)
            commit.note = {"batch": -1, "buckets": buckets, "levels": []}
    return store


def stream_bulk(
    ops: DataFrame,
    base: DataFrame,
    log: str,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    id_col: str = "_id",
    version_col: str = "_version",
    trigger: dict | None = None,
    buckets: int = BUCKETS,
    fanout: int = FANOUT,
) -> StreamingQuery:
    """Start applying a stream of operations on top of the table ``base``.

    How many operations a batch takes is set at the source (for files,
    ``maxFilesPerTrigger``). ``on_batch`` receives each batch's item report.
    """
    store = open_log(base, log, id_col, buckets)

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(store, batch, batch_id, id_col, version_col, fanout)
        if on_batch is not None:
            on_batch(store.spark.read.parquet(f"{log}/items/batch={batch_id}"), batch_id)

    writer = ops.writeStream.foreachBatch(apply).option("checkpointLocation", f"{log}/checkpoint")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def apply_batch(
    store: Snapshots, batch: DataFrame, batch_id: int, id_col: str = "_id", version_col: str = "_version", fanout: int = FANOUT
) -> None:
    """Apply one batch of operations; one that is published already is left alone."""
    now = store.pinned()
    if now.note["batch"] < batch_id:
        touched = batch.select(id_col).distinct()
        # At most one row per bucket comes here.
        wanted = touched.select(_bucket(id_col, now.note["buckets"]).alias("b")).distinct().collect()
        latest = latest_rows(now, id_col, touched, sorted(r["b"] for r in wanted))
        state = latest.where(~F.col("_deleted")).drop("_deleted")
        gone = latest.where("_deleted").select(id_col, version_col)
        result = bulk(state, batch, id_col, version_col, staged=True, gone=gone)
        result.items.write.mode("overwrite").parquet(f"{store.root}/items/batch={batch_id}")
        run = (batch_id + 1) * STEP
        with store.commit() as commit:
            commit.append(CHANGES, _laid_out(result.changes, id_col, now.note["buckets"]), f"run={run}", ["bucket"])
            levels = [list(level) for level in now.note["levels"]] or [[]]
            levels[0].append(run)
            commit.note |= {"batch": batch_id, "levels": levels}
    merge_levels(store, id_col, fanout)


def merge_levels(store: Snapshots, id_col: str = "_id", fanout: int = FANOUT) -> None:
    """Merge every full level into the next one. Readers are not disturbed, and
    a merge that is lost is made up for after the next batch."""
    at = 0
    while at < len((now := store.pinned()).note["levels"]):
        runs = now.note["levels"][at]
        if len(runs) >= fanout:
            _merged(store, now, at, runs, id_col)
        at += 1


def _merged(store: Snapshots, now: Snapshot, at: int, runs: list[int], id_col: str) -> None:
    run = runs[-1] - runs[-1] % STEP + at + 1  # after the runs it holds, before the next batch
    folders = [f"run={r}" for r in runs]
    rows = _latest(now.read(CHANGES, folders), id_col)
    with store.commit() as commit:
        commit.append(CHANGES, _laid_out(rows, id_col, now.note["buckets"]), f"run={run}", ["bucket"])
        commit.forget(CHANGES, folders)
        levels = [list(level) for level in now.note["levels"]]
        levels[at] = []
        if at + 1 == len(levels):
            levels.append([])
        levels[at + 1].append(run)
        commit.note["levels"] = levels


def compact(store: Snapshots, id_col: str = "_id") -> None:
    """Merge all runs into a new base. Rows of deleted ids stay, marked: their
    versions go on counting."""
    now = store.pinned()
    run = now.note["batch"] * STEP + 2 * STEP - 1
    with store.commit() as commit:
        commit.append(CHANGES, _laid_out(_latest(now.read(CHANGES), id_col), id_col, now.note["buckets"]), f"run={run}", ["bucket"])
        commit.forget(CHANGES, now.folders(CHANGES))
        commit.note["levels"] = []


def _latest(changes: DataFrame, id_col: str) -> DataFrame:
    row = F.struct(*[n for n in changes.columns if n not in ("run", "bucket")])
    return changes.groupBy(id_col).agg(F.max_by(row, "run").alias("row")).select("row.*")


def latest_rows(
    now: Snapshot, id_col: str = "_id", only: DataFrame | None = None, buckets: list[int] | None = None
) -> DataFrame:
    """The last row of every id, deleted ones marked, optionally of some ids
    and their buckets only."""
    changes = now.read(CHANGES)
    if buckets is not None:
        changes = changes.where(F.col("bucket").isin(buckets))
    if only is not None:
        changes = changes.join(only, id_col, "left_semi")
    return _latest(changes, id_col)


def as_of(spark: SparkSession, log: str, before: int | None = None) -> Snapshot:
    """The latest version of a log, or the last one before a batch."""
    store = Snapshots(spark, log)
    if before is None:
        return store.pinned()
    for version in reversed(store.versions()):
        found = store.pinned(version)
        if found.note["batch"] < before:
            return found
    raise ValueError(f"no version before batch {before} is kept")


def current_table(spark: SparkSession, log: str, before: int | None = None, id_col: str = "_id") -> DataFrame:
    """The table with all batches applied, or those before a given one.

    The base only passes an anti join on the ids that have changed since.
    """
    now = as_of(spark, log, before)
    recent = [f"run={r}" for level in now.note["levels"] for r in level]
    base = now.read(CHANGES, [f for f in now.folders(CHANGES) if f not in recent])
    latest = _latest(now.read(CHANGES, recent), id_col) if recent else None
    columns = [n for n in base.columns if n not in ("run", "bucket", "_deleted")]
    rows = base.where(~F.col("_deleted"))
    if latest is None:
        return rows.select(*columns)
    rows = rows.join(latest.select(id_col), id_col, "left_anti").select(*columns)
    return rows.unionByName(latest.where(~F.col("_deleted")).select(*columns))


def item_log(spark: SparkSession, log: str) -> DataFrame:
    """Item reports of all batches so far, with their batch number."""
    return spark.read.option("basePath", f"{log}/items").parquet(f"{log}/items")
