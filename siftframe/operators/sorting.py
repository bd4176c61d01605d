"""Sort keys: order, missing values, list modes, and what comes after a key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftframe.plans.collection import Collection


@dataclass(frozen=True)
class SortKey:
    """``missing`` is ``_last``, ``_first`` or a value that stands in for null.
    ``mode`` picks the value of a list field: min, max, avg or sum."""

    field: str
    order: str = "asc"
    missing: Any = "_last"
    mode: str | None = None

    @property
    def descending(self) -> bool:
        if self.order not in ("asc", "desc"):
            raise ValueError(f"order must be asc or desc: {self.order}")
        return self.order == "desc"

    @property
    def nulls_first(self) -> bool:
        return self.missing == "_first"

    def value(self, c: Collection) -> Column:
        """The value rows are compared by."""
        if self.field in ("_score", c.id):
            return F.col(self.field)
        slot = c.scope.slot(self.field)
        value = slot.column
        if slot.is_array:
            value = _list_value(value, self.mode or ("max" if self.descending else "min"))
        if self.missing not in ("_last", "_first"):
            value = F.coalesce(value, F.lit(self.missing))
        return value

    def ordering(self, value: Column) -> Column:
        if self.descending:
            return value.desc_nulls_first() if self.nulls_first else value.desc_nulls_last()
        return value.asc_nulls_first() if self.nulls_first else value.asc_nulls_last()

    def beyond(self, value: Column, at: Any) -> Column:
        """Rows strictly after ``at`` in this key's order. Plain comparisons, so
        they reach the parquet reader."""
        if at is None:
            return value.isNotNull() if self.nulls_first else F.lit(False)
        later = value < F.lit(at) if self.descending else value > F.lit(at)
        return later if self.nulls_first else later | value.isNull()

    def same(self, value: Column, at: Any) -> Column:
        return value.isNull() if at is None else value == F.lit(at)


def _list_value(c: Column, mode: str) -> Column:
    if mode == "min":
        return F.array_min(c)
    if mode == "max":
        return F.array_max(c)
    total = F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))
    if mode == "sum":
        return total
    if mode == "avg":
        return F.try_divide(total, F.size(c))
    raise ValueError(f"unknown sort mode: {mode}")


def sort_keys(c: Collection, sort: list | None) -> list[SortKey]:
    """Keys in call order with the id as last tie-breaker. Entries are names,
    ``(name, order)`` pairs or ``SortKey``."""
    keys = []
    for entry in sort or []:
        if isinstance(entry, str):
            entry = SortKey(entry)
        elif not isinstance(entry, SortKey):
            entry = SortKey(*entry)
        keys.append(entry)
    if not any(k.field == c.id for k in keys):
        keys.append(SortKey(c.id))
    return keys


def orderings(c: Collection, keys: list[SortKey]) -> list[Column]:
    return [k.ordering(k.value(c)) for k in keys]


def after(c: Collection, keys: list[SortKey], at: tuple) -> Column:
    """Rows strictly after the given sort values, in mixed directions: the
    first key decides, or it ties and the next one decides, and so on."""
    if len(at) != len(keys):
        raise ValueError(f"{len(keys)} sort values needed, got {len(at)}")
    steps = []
    for i, key in enumerate(keys):
        ties = [k.same(k.value(c), v) for k, v in zip(keys[:i], at[:i])]
        steps.append(reduce(lambda a, b: a & b, [*ties, key.beyond(key.value(c), at[i])]))
    # The first key alone bounds the page, also where a later key is computed
    # and cannot reach the reader.
    first = keys[0].value(c)
    bound = keys[0].beyond(first, at[0]) | keys[0].same(first, at[0])
    return bound & reduce(lambda a, b: a | b, steps)
