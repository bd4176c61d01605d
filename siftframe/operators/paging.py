"""Deep paging by sort key, and export in fixed batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftframe.operators.numbering import numbered
from siftframe.operators.scoring import scored
from siftframe.operators.search import highlight_columns, matching
from siftframe.operators.sorting import after, orderings, sort_keys
from siftframe.plans.collection import Collection
from siftframe.plans.conditions import Condition, lifted
from siftframe.session import stage


def search_after(
    c: Collection,
    condition: Condition | None = None,
    *,
    sort: list | None = None,
    values: tuple | None = None,
    size: int = 10,
    min_score: float | None = None,
    source: list[str] | None = None,
    highlight: list[str] | None = None,
) -> DataFrame:
    """The ``size`` rows that follow the sort key ``values``; the id breaks
    ties. Each page costs one filtered top-k, however deep it lies. The column
    ``sort`` holds the row's key for the next call; ``_score`` is there when the
    order or ``min_score`` needs it, marks as in ``search``."""
    condition = None if condition is None else lifted(condition)
    keys = sort_keys(c, sort)
    with_score = min_score is not None or any(k.field == "_score" for k in keys)
    rows = scored(c, condition) if with_score else matching(c, condition)
    if min_score is not None:
        rows = rows.where(F.col("_score") >= min_score)
    if values is not None:
        rows = rows.where(after(c, keys, tuple(values)))
    found = rows.orderBy(*orderings(c, keys)).limit(size)
    key = F.struct(*[k.value(c).alias(f"k{i}") for i, k in enumerate(keys)]).alias("sort")
    names = list(dict.fromkeys([c.id, *(["_score"] if with_score else []), *(source or c.df.columns)]))
    marks = highlight_columns(c, condition, highlight) if highlight else []
    return found.select(*names, *marks, key)


class Pager:
    """Walks through a result page by page; only one key row stays here."""

    def __init__(self, c: Collection, condition: Condition | None = None, **options):
        self._arguments = (c, condition)
        self._options = options
        self._page: DataFrame | None = None
        self._last: tuple | None = None
        self._rows = 0

    def first(self) -> DataFrame:
        return self._fetch(None)

    def next(self) -> DataFrame:
        if self._page is None:
            raise RuntimeError("fetch the first page before the next one")
        if self._last is None:
            raise RuntimeError("the last page was empty")
        return self._fetch(self._last)

    @property
    def has_more(self) -> bool:
        """True unless the last page came back empty."""
        return self._rows > 0

    @property
    def last_sort_values(self) -> tuple | None:
        return self._last

    def _fetch(self, values: tuple | None) -> DataFrame:
        c, condition = self._arguments
        self._page = search_after(c, condition, values=values, **self._options)
        self._last, self._rows = last_sort_values(self._page)
        return self._page


def last_sort_values(page: DataFrame) -> tuple[tuple | None, int]:
    """Sort key of the last row of a page, and the number of rows of the page.
    A page is at most ``size`` rows, of which only the keys come here."""
    keys = page.select("sort").collect()
    return (tuple(keys[-1]["sort"]) if keys else None), len(keys)


def scroll_export(c: Collection, condition: Condition | None = None, size: int = 1000) -> DataFrame:
    """Every matching row exactly once, with its ``_batch`` of ``size`` rows,
    over a snapshot written to the shared folder. Nothing is sorted or shuffled."""
    rows = numbered(stage(matching(c, condition), "scroll"))
    return rows.withColumn("_batch", F.floor(F.col("_position") / size).cast("bigint"))


def write_batches(batches: DataFrame, path: str, format: str = "json", rows_per_file: int = 1_000_000) -> None:
    """Write an export in batch order; consecutive batches share files."""
    ordered = batches.repartitionByRange("_batch").sortWithinPartitions("_position")
    ordered.write.option("maxRecordsPerFile", rows_per_file).format(format).save(path)
