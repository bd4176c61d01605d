"""Dense row numbers without bringing rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftframe.session import BROADCAST_ROWS


def numbered(staged: DataFrame, position: str = "_position") -> DataFrame:
    """Number the rows of a written parquet table 0, 1, 2, ... in file order.

    A row's number is the row count of the files before it plus its index in
    its own file. Both come from file metadata, so they do not depend on how
    the files are split into tasks, and only the list of files (one row per
    file) meets in one place.
    """
    file_name = F.col("_metadata.file_name")
    counts = staged.groupBy(file_name.alias("_file")).agg(F.count("*").alias("_rows"))
    # Written files carry the number of the task that wrote them.
    task = F.regexp_extract("_file", r"part-(\d+)", 1).try_cast("bigint")
    before = W.orderBy(task, "_file").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    if len(staged.inputFiles()) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    rows = staged.select("*", file_name.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    numbers = rows.join(offsets, "_file").withColumn(position, F.col("_offset") + F.col("_row"))
    return numbers.select(*staged.columns, position)
