"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows a side may have before we stop asking for a broadcast. A row of ids or
# words is well under 1 KB, so this is at most a few tens of MB per executor.
BROADCAST_ROWS = 100_000


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings that every job here assumes: adaptive plans, skew splitting, UTC."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster shares between executors.

    The cluster names it in ``spark.checkpoint.dir``; only a session without
    that setting (a local test) falls back to a temporary folder, and only a
    local master may, because executors on other machines would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="siftframe-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Staged tables of this process, for ``drop_staged``.
_staged: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a fixed snapshot
    that survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _staged.append(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.staged_path = path
    return found


def _deleted(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unstage(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more (what was worked out
    from them is written). The shuffle files of the jobs that are done go too:
    Spark's cleaner drops them once the driver has collected their plans."""
    for table in tables:
        _staged.remove(table.staged_path)
        _deleted(spark, table.staged_path)
    spark._jvm.System.gc()


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables staged so far by this process and return their number.
    Call it once the results that were built on them are written."""
    dropped = 0
    while _staged:
        dropped += _deleted(spark, _staged.pop())
    return dropped


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; stops reading beyond."""
    return df.limit(max_rows + 1).count() <= max_rows
