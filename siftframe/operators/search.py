"""Searching a collection: filter, score, sort, page, highlight, project."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftframe.operators.numbering import numbered
from siftframe.operators.scoring import scored
from siftframe.operators.sorting import SortKey, orderings, sort_keys
from siftframe.plans.collection import Collection
from siftframe.plans.conditions import Condition, lifted, where
from siftframe.session import stage

# A window up to this many rows is kept per task while picking the top; a
# deeper one sorts across the cluster instead.
TOP_ROWS = 10_000


def matching(c: Collection, condition: Condition | None) -> DataFrame:
    """Rows that satisfy the condition."""
    return where(c.df, condition, c.scope)


def search(
    c: Collection,
    condition: Condition | None = None,
    *,
    sort: list | None = None,
    from_: int = 0,
    size: int | None = 10,
    source: list[str] | None = None,
    highlight: list[str] | None = None,
    min_score: float | None = None,
    track_scores: bool = False,
    term_tables: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Hits of a condition: ``_id``, ``_score`` and the source columns.

    Without ``sort`` the best score comes first. The score, and the statistics
    pass it needs, is only computed when something asks for it. ``term_tables``
    are stored ``term_stats`` by field, which spare that pass. ``size=None``
    returns all hits, unordered.
    """
    condition = None if condition is None else lifted(condition)
    by_score = sort is None or any(k.field == "_score" for k in sort_keys(c, sort))
    with_score = by_score or track_scores or min_score is not None
    rows = scored(c, condition, term_tables) if with_score else matching(c, condition)
    if min_score is not None:
        rows = rows.where(F.col("_score") >= min_score)
    keys = sort_keys(c, [SortKey("_score", "desc")] if sort is None else sort)
    wanted = list(dict.fromkeys([c.id, *(["_score"] if with_score else []), *(source or c.df.columns)]))
    marks = highlight_columns(c, condition, highlight) if highlight else []
    hits = page(c.with_df(rows), keys, from_, size) if size is not None else rows
    return hits.select(*[_source_column(n) for n in wanted], *marks)


def _source_column(name: str) -> Column:
    return F.col(name).alias(name) if "." in name else F.col(f"`{name}`")


def page(c: Collection, keys: list[SortKey], from_: int, size: int) -> DataFrame:
    """Rows ``from_`` to ``from_ + size`` of the sorted result."""
    if from_ + size <= TOP_ROWS:
        sorted_rows = c.df.orderBy(*orderings(c, keys))
        return (sorted_rows.offset(from_) if from_ else sorted_rows).limit(size)
    rows = sorted_rows_numbered(c, keys)
    inside = (F.col("_position") >= from_) & (F.col("_position") < from_ + size)
    return rows.where(inside).drop("_position")


def sorted_rows_numbered(c: Collection, keys: list[SortKey]) -> DataFrame:
    """All rows with their position in the sort order, from a range-partitioned
    sort written once: no task ever holds more than its range."""
    return numbered(stage(c.df.orderBy(*orderings(c, keys)), "sorted"))


def count(c: Collection, condition: Condition | None = None) -> DataFrame:
    return matching(c, condition).agg(F.count("*").alias("count"))


def hits_total(c: Collection, condition: Condition | None = None) -> DataFrame:
    """Number of hits and best score, one row."""
    return scored(c, condition).agg(F.count("*").alias("total"), F.max("_score").alias("max_score"))


def highlight_columns(c: Collection, condition: Condition | None, fields: list[str]) -> list[Column]:
    """``highlight``: field -> fragments with the query's words in ``<em>``.
    Fields without a matched word are left out."""
    words: dict[str, list[str]] = {f: [] for f in fields}
    for field, text in condition.words(c.scope) if condition is not None else []:
        slot = c.scope.slot(field)
        if field in words:
            words[field] += slot.spec.chain.words(text) if slot.is_text else [text]
    entries = []
    for field, found in words.items():
        if found:
            text = c.scope.slot(field).column
            marked = mark_words(text, list(dict.fromkeys(found)))
            entry = F.struct(F.lit(field).alias("key"), F.array(marked).alias("value"))
            # Marked at all: a text may hold the tag itself.
            entries.append(F.when(marked != text, entry))
    if not entries:
        return [F.lit(None).cast("map<string,array<string>>").alias("highlight")]
    kept = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return [F.map_from_entries(kept).alias("highlight")]


def mark_words(text: Column, words: list[str]) -> Column:
    """Whole words in ``<em>`` tags, whatever their case."""
    edge = r"[\p{L}\p{M}\p{N}_]"
    choice = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    return F.regexp_replace(text, rf"(?iu)(?<!{edge})({choice})(?!{edge})", "<em>$1</em>")


def mget(c: Collection, ids: list[str] | DataFrame) -> DataFrame:
    """One row per requested id, in request order (``_pos``), with ``found``.

    The table is cut to the requested ids before the outer join, so at most one
    row per request is moved.
    """
    spark = c.df.sparkSession
    if isinstance(ids, DataFrame):
        asked = ids
    else:
        asked = spark.createDataFrame(list(enumerate(ids)), f"_pos bigint, {c.id} string")
    keys = asked.select(c.id).distinct()
    if not isinstance(ids, DataFrame) and len(ids) <= 1_000_000:
        keys = F.broadcast(keys)
    rows = c.df.join(keys, c.id, "left_semi").withColumn("found", F.lit(True))
    return asked.join(rows, c.id, "left").withColumn("found", F.coalesce("found", F.lit(False)))
