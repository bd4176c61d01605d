"""Conditions as values that turn into Spark columns.

A condition gives a predicate for filtering and, if it scores, a score column.
A leaf on a missing field is false, so its negation keeps the row. Predicates
stay plain comparisons wherever possible: Spark's filter already treats unknown
as false, and only plain comparisons reach the parquet reader.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftframe.functions import cells, geo
from siftframe.functions.dates import resolve_date, timestamp_literal
from siftframe.plans.collection import Scope, Slot

# Beyond this many listed values a top-level condition becomes a semi join.
INLINE_VALUES = 1_000


def _any(slot: Slot, test) -> Column:
    """``test`` on the value, or on any token or element."""
    return F.exists(slot.terms(), test) if slot.many else test(slot.column)


def _or(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def _and(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def _literal(slot: Slot) -> bool:
    """Tokens occur literally in the lower-case text, so testing the raw text
    first spares most rows the tokenizer."""
    return slot.stored_tokens is None and not slot.is_array and slot.spec.chain.substring_tokens


def _literal_tests(slot: Slot, words: list[str]) -> list[Column]:
    return [F.contains(F.lower(slot.column), F.lit(w)) for w in dict.fromkeys(words)]


@dataclass(frozen=True)
class Condition:
    """Base class. ``&``, ``|`` and ``~`` combine conditions."""

    def predicate(self, scope: Scope) -> Column:
        raise NotImplementedError

    def negation(self, scope: Scope) -> Column:
        return ~F.coalesce(self.predicate(scope), F.lit(False))

    def truth(self, scope: Scope) -> Column:
        """True or false, never unknown."""
        return F.coalesce(self.predicate(scope), F.lit(False))

    def outline(self, scope: Scope) -> Column:
        """A test that every matching row passes and that analyses no text; it
        thins the rows out before the words of the others are worked out."""
        return F.lit(True)

    @property
    def scores(self) -> bool:
        """Whether the condition counts towards relevance when it must hold."""
        return True

    def words(self, scope: Scope) -> list[tuple[str, str]]:
        """(field, text) pairs whose statistics the score needs."""
        return []

    def score(self, scope: Scope, stats) -> Column:
        """Score of a row that satisfies the condition."""
        return F.lit(1.0)

    def __and__(self, other: "Condition") -> "Condition":
        return all_of(self, other)

    def __or__(self, other: "Condition") -> "Condition":
        return any_of(self, other)

    def __invert__(self) -> "Condition":
        return none_of(self)


@dataclass(frozen=True)
class MatchAll(Condition):
    """Every row, score 1."""

    def predicate(self, scope: Scope) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class FieldCondition(Condition):
    field: str

    def negation(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        if slot.many:
            return super().negation(scope)
        return slot.column.isNull() | ~self.predicate(scope)

    def outline(self, scope: Scope) -> Column:
        return F.lit(True) if scope.slot(self.field).is_text else self.predicate(scope)


@dataclass(frozen=True)
class FilterCondition(FieldCondition):
    """A leaf that restricts without scoring."""

    @property
    def scores(self) -> bool:
        return False


@dataclass(frozen=True)
class Match(FieldCondition):
    """Any analysed word of the text occurs; equality on other fields."""

    value: Any

    def predicate(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        if not slot.is_text:
            return _equals(slot, self.value)
        words = slot.spec.chain.words(str(self.value))
        if not words:
            return F.lit(False)
        if len(words) == 1:
            found = F.array_contains(slot.tokens(), words[0])
        else:
            found = F.arrays_overlap(slot.tokens(), F.array(*map(F.lit, words)))
        return _or(_literal_tests(slot, words)) & found if _literal(slot) else found

    def outline(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        if not slot.is_text:
            return self.predicate(scope)
        tests = _literal_tests(slot, slot.spec.chain.words(str(self.value))) if _literal(slot) else []
        return _or(tests) if tests else F.lit(True)

    def words(self, scope: Scope) -> list[tuple[str, str]]:
        slot = scope.slot(self.field)
        return [] if slot.is_array and not slot.is_text else [(self.field, str(self.value))]

    def score(self, scope: Scope, stats) -> Column:
        slot = scope.slot(self.field)
        if slot.is_array and not slot.is_text:
            return F.lit(1.0)
        return stats.score(slot, str(self.value))


@dataclass(frozen=True)
class MatchPhrase(FieldCondition):
    """The analysed words occur next to each other, in order."""

    value: str

    def predicate(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        if not slot.is_text:
            return _equals(slot, self.value)
        words = slot.spec.chain.words(self.value)
        if not words:
            return F.lit(False)
        # A control character never is part of a word, so it can delimit words.
        joined = F.concat(F.lit("\x01"), F.array_join(slot.tokens(), "\x01"), F.lit("\x01"))
        found = F.contains(joined, F.lit("\x01" + "\x01".join(words) + "\x01"))
        return _and(_literal_tests(slot, words)) & found if _literal(slot) else found

    def outline(self, scope: Scope) -> Column:
        return Match(self.field, self.value).outline(scope)

    def words(self, scope: Scope) -> list[tuple[str, str]]:
        return Match(self.field, self.value).words(scope)

    def score(self, scope: Scope, stats) -> Column:
        return Match(self.field, self.value).score(scope, stats)


@dataclass(frozen=True)
class MultiMatch(Condition):
    """``Match`` on any of the fields; the best field gives the score."""

    query: str
    fields: tuple[str, ...]

    def _parts(self) -> list[Match]:
        return [Match(f, self.query) for f in self.fields]

    def predicate(self, scope: Scope) -> Column:
        return _or([p.predicate(scope) for p in self._parts()])

    def outline(self, scope: Scope) -> Column:
        return _or([p.outline(scope) for p in self._parts()])

    def words(self, scope: Scope) -> list[tuple[str, str]]:
        return [w for p in self._parts() for w in p.words(scope)]

    def score(self, scope: Scope, stats) -> Column:
        scores = [F.when(p.truth(scope), p.score(scope, stats)).otherwise(0.0) for p in self._parts()]
        return F.greatest(*scores) if len(scores) > 1 else scores[0]


def _equals(slot: Slot, value: Any) -> Column:
    if slot.many:
        return F.array_contains(slot.terms(), F.lit(value))
    return slot.column == F.lit(value)


@dataclass(frozen=True)
class Term(FilterCondition):
    """Exact value, not analysed. A list matches by any element, a text by any token."""

    value: Any

    def predicate(self, scope: Scope) -> Column:
        return _equals(scope.slot(self.field), self.value)

    def words(self, scope: Scope) -> list[tuple[str, str]]:
        slot = scope.slot(self.field)
        return [] if slot.many else [(self.field, str(self.value))]

    def score(self, scope: Scope, stats) -> Column:
        slot = scope.slot(self.field)
        return F.lit(1.0) if slot.many else stats.score(slot, str(self.value))


@dataclass(frozen=True)
class Terms(FilterCondition):
    """Any of the values, given as a tuple or as a one-column table."""

    values: Any

    @property
    def as_join(self) -> bool:
        return isinstance(self.values, DataFrame) or len(self.values) > INLINE_VALUES

    def predicate(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        if isinstance(self.values, DataFrame):
            if slot.many or scope.element is not None:
                raise ValueError("a table of values is compared with a field of one value")
            # An existence join: one flag per row, whatever stands around it. The
            # new name and the alias keep the row's column from being looked up
            # in the table of values, which may come from the same collection.
            name = f"_value_{uuid.uuid4().hex}"
            return self.values.toDF(name).alias("_values").where(F.col(name) == slot.column.outer()).exists()
        if slot.many:
            return F.arrays_overlap(slot.terms(), F.array(*[F.lit(v) for v in self.values]))
        return slot.column.isin(list(self.values))

    def outline(self, scope: Scope) -> Column:
        return F.lit(True) if self.as_join else super().outline(scope)


@dataclass(frozen=True)
class Ids(Terms):
    """Rows by identifier. The field is the collection's id column."""


@dataclass(frozen=True)
class Range(FilterCondition):
    """Bounds on a value; no bound at all means that the field exists."""

    gte: Any = None
    lte: Any = None
    gt: Any = None
    lt: Any = None
    now: dt.datetime | None = None

    def _test(self, slot: Slot, c: Column) -> Column:
        bound = lambda v: F.lit(v) if not _is_date(slot, v) else timestamp_literal(resolve_date(v, self.now))
        parts = []
        if self.gte is not None:
            parts.append(c >= bound(self.gte))
        if self.gt is not None:
            parts.append(c > bound(self.gt))
        if self.lte is not None:
            parts.append(c <= bound(self.lte))
        if self.lt is not None:
            parts.append(c < bound(self.lt))
        return _and(parts)

    def predicate(self, scope: Scope) -> Column:
        if (self.gte, self.lte, self.gt, self.lt) == (None,) * 4:
            return Exists(self.field).predicate(scope)
        slot = scope.slot(self.field)
        return _any(slot, lambda c: self._test(slot, c))

    def negation(self, scope: Scope) -> Column:
        if (self.gte, self.lte, self.gt, self.lt) == (None,) * 4:
            return Exists(self.field).negation(scope)
        return super().negation(scope)


RELATIONS = ("intersects", "within", "contains")


@dataclass(frozen=True)
class RangeRelation(FilterCondition):
    """How a field that holds a range lies to the range of the query: it meets
    it, lies within it, or contains it. All bounds are included, absent ones open."""

    gte: Any = None
    lte: Any = None
    relation: str = "intersects"
    now: dt.datetime | None = None

    def predicate(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        dated = slot.spec is not None and slot.spec.type == "date_range"
        bound = lambda v: timestamp_literal(resolve_date(v, self.now)) if dated else F.lit(v)

        def test(c: Column) -> Column:
            low, high, parts = c["gte"], c["lte"], [c.isNotNull()]
            if self.relation == "within":
                parts += [] if self.gte is None else [low >= bound(self.gte)]
                parts += [] if self.lte is None else [high <= bound(self.lte)]
            elif self.relation == "contains":
                parts.append(low.isNull() if self.gte is None else low.isNull() | (low <= bound(self.gte)))
                parts.append(high.isNull() if self.lte is None else high.isNull() | (high >= bound(self.lte)))
            else:
                parts += [] if self.lte is None else [low.isNull() | (low <= bound(self.lte))]
                parts += [] if self.gte is None else [high.isNull() | (high >= bound(self.gte))]
            return _and(parts)

        return _any(slot, test)

    def negation(self, scope: Scope) -> Column:
        return Condition.negation(self, scope)


def _is_date(slot: Slot, value: Any) -> bool:
    """Dates, and texts such as ``now-7d/d`` for a field declared as a date."""
    declared = slot.spec is not None and slot.spec.type == "date"
    return isinstance(value, (dt.datetime, dt.date)) or (declared and isinstance(value, str))


@dataclass(frozen=True)
class Exists(FilterCondition):
    """Not null; an empty list counts as missing."""

    def predicate(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        present = slot.column.isNotNull()
        return present & (F.size(slot.column) > 0) if slot.is_array else present

    def negation(self, scope: Scope) -> Column:
        slot = scope.slot(self.field)
        absent = slot.column.isNull()
        return absent | (F.size(slot.column) == 0) if slot.is_array else absent


@dataclass(frozen=True)
class Wildcard(FieldCondition):
    """``*`` is any run, ``?`` one character; the whole value or token must fit."""

    pattern: str

    def predicate(self, scope: Scope) -> Column:
        escaped = re.sub(r"([%_\\])", r"\\\1", self.pattern)
        like = escaped.replace("*", "%").replace("?", "_")
        return _any(scope.slot(self.field), lambda c: c.like(like))


@dataclass(frozen=True)
class Prefix(FieldCondition):
    value: str

    def predicate(self, scope: Scope) -> Column:
        return _any(scope.slot(self.field), lambda c: c.startswith(self.value))


@dataclass(frozen=True)
class Regexp(FieldCondition):
    """The pattern must fit the whole value or token."""

    pattern: str

    def predicate(self, scope: Scope) -> Column:
        return _any(scope.slot(self.field), lambda c: c.rlike(rf"\A(?:{self.pattern})\z"))


@dataclass(frozen=True)
class Fuzzy(FieldCondition):
    """Edit distance up to ``fuzziness``; None or AUTO depends on the length."""

    value: str
    fuzziness: int | str | None = None

    @property
    def distance(self) -> int:
        if self.fuzziness is None or str(self.fuzziness).upper() == "AUTO":
            return 0 if len(self.value) <= 2 else 1 if len(self.value) <= 5 else 2
        return int(self.fuzziness)

    def predicate(self, scope: Scope) -> Column:
        n, k = len(self.value), self.distance

        def close(c: Column) -> Column:
            # The length test settles most values without computing a distance.
            near = F.length(c).between(n - k, n + k)
            return near & F.levenshtein(c, F.lit(self.value), k).between(0, k)

        return _any(scope.slot(self.field), close)


def _in_cells(scope: Scope, field: str, box: tuple[float, float, float, float], exact: Column) -> Column:
    """``exact`` behind a test of the point's cell, where the table stores it."""
    stored = f"{scope.mapping.column_name(field)}__cell"
    if scope.element is not None or stored not in scope.schema.names:
        return exact
    return cells.among(F.col(f"`{stored}`"), cells.cover(*box)) & exact


@dataclass(frozen=True)
class GeoDistance(FilterCondition):
    lat: float
    lon: float
    distance: str | float

    def predicate(self, scope: Scope) -> Column:
        point, distance = scope.slot(self.field).column, geo.metres(self.distance)
        exact = geo.within(point.lat, point.lon, self.lat, self.lon, distance)
        return _in_cells(scope, self.field, geo.around(self.lat, self.lon, distance), exact)

    def negation(self, scope: Scope) -> Column:
        return Condition.negation(self, scope)


@dataclass(frozen=True)
class GeoBoundingBox(FilterCondition):
    top_lat: float
    left_lon: float
    bottom_lat: float
    right_lon: float

    def predicate(self, scope: Scope) -> Column:
        point = scope.slot(self.field).column
        box = (self.top_lat, self.left_lon, self.bottom_lat, self.right_lon)
        return _in_cells(scope, self.field, box, geo.in_box(point.lat, point.lon, *box))

    def negation(self, scope: Scope) -> Column:
        return Condition.negation(self, scope)


@dataclass(frozen=True)
class Nested(Condition):
    """One single element of a list of objects satisfies the whole condition."""

    path: str
    condition: Condition

    def predicate(self, scope: Scope) -> Column:
        return F.exists(
            scope.slot(self.path).column, lambda x: self.condition.truth(scope.inside(self.path, x))
        )

    def outline(self, scope: Scope) -> Column:
        return self.predicate(scope)


@dataclass(frozen=True)
class Expression(Condition):
    """Any Spark column as an unscored condition."""

    column: Column

    @property
    def scores(self) -> bool:
        return False

    def predicate(self, scope: Scope) -> Column:
        return self.column

    def outline(self, scope: Scope) -> Column:
        return self.column


@dataclass(frozen=True)
class Bool(Condition):
    """must AND filter AND NOT any must_not AND enough of should.

    Without ``minimum_should_match`` one should clause is needed if there is
    neither must nor filter; otherwise should clauses only add to the score.
    """

    must: tuple[Condition, ...] = ()
    filter: tuple[Condition, ...] = ()
    should: tuple[Condition, ...] = ()
    must_not: tuple[Condition, ...] = ()
    minimum_should_match: int | str | None = None

    @property
    def needed(self) -> int:
        if not self.should:
            return 0
        if self.minimum_should_match is None:
            return 0 if self.must or self.filter else 1
        return required_matches(self.minimum_should_match, len(self.should))

    def predicate(self, scope: Scope) -> Column:
        parts = [c.predicate(scope) for c in (*self.filter, *self.must)]
        parts += [c.negation(scope) for c in self.must_not]
        m, n = self.needed, len(self.should)
        if m > n:
            parts.append(F.lit(False))
        elif m == n and n:
            parts += [c.predicate(scope) for c in self.should]
        elif m == 1:
            parts.append(_or([c.predicate(scope) for c in self.should]))
        elif m > 1:
            hits = reduce(lambda a, b: a + b, [c.truth(scope).cast("int") for c in self.should])
            parts.append(hits >= m)
        return _and(parts) if parts else F.lit(True)

    def outline(self, scope: Scope) -> Column:
        parts = [c.outline(scope) for c in (*self.filter, *self.must)]
        if self.needed:
            parts.append(_or([c.outline(scope) for c in self.should]))
        return _and(parts) if parts else F.lit(True)

    @property
    def scores(self) -> bool:
        return any(c.scores for c in self.must) or bool(self.should) or self == Bool()

    def words(self, scope: Scope) -> list[tuple[str, str]]:
        return [w for c in (*self.must, *self.should) for w in c.words(scope)]

    def score(self, scope: Scope, stats) -> Column:
        if self == Bool():
            return F.lit(1.0)
        parts = [c.score(scope, stats) for c in self.must]
        parts += [F.when(c.truth(scope), c.score(scope, stats)).otherwise(0.0) for c in self.should]
        return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def required_matches(rule: int | str, n: int) -> int:
    """Number of should clauses that ``rule`` asks for: ``2``, ``-1``, ``"75%"``,
    ``"-25%"``, or steps such as ``"2<75% 9<-3"``."""
    text = str(rule).strip()
    if "<" in text:
        chosen = None
        for step in text.split():
            above, _, then = step.partition("<")
            if n > int(above):
                chosen = then
        return n if chosen is None else required_matches(chosen, n)
    if text.endswith("%"):
        share = float(text[:-1])
        count = n - math.floor(n * -share / 100) if share < 0 else math.floor(n * share / 100)
    else:
        count = n + int(text) if int(text) < 0 else int(text)
    return max(count, 0)


# --- constructors ---------------------------------------------------------


def match(field: str, value: Any) -> Match:
    return Match(field, value)


def match_phrase(field: str, value: str) -> MatchPhrase:
    return MatchPhrase(field, value)


def multi_match(query: str, *fields: str) -> MultiMatch:
    return MultiMatch(query, fields)


def term(field: str, value: Any) -> Term:
    return Term(field, value)


def terms(field: str, *values: Any) -> Terms:
    listed = values[0] if len(values) == 1 and isinstance(values[0], DataFrame) else values
    return Terms(field, listed)


def ids(*values: Any, field: str = "_id") -> Ids:
    listed = values[0] if len(values) == 1 and isinstance(values[0], DataFrame) else values
    return Ids(field, listed)


def between(
    field: str, gte: Any = None, lte: Any = None, *, gt: Any = None, lt: Any = None, now: dt.datetime | None = None
) -> Range:
    return Range(field, gte, lte, gt, lt, now)


def range_relation(
    field: str, gte: Any = None, lte: Any = None, relation: str = "intersects", now: dt.datetime | None = None
) -> RangeRelation:
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {', '.join(RELATIONS)}")
    return RangeRelation(field, gte, lte, relation, now)


def exists(field: str) -> Exists:
    return Exists(field)


def wildcard(field: str, pattern: str) -> Wildcard:
    return Wildcard(field, pattern)


def prefix(field: str, value: str) -> Prefix:
    return Prefix(field, value)


def regexp(field: str, pattern: str) -> Regexp:
    return Regexp(field, pattern)


def fuzzy(field: str, value: str, fuzziness: int | str | None = None) -> Fuzzy:
    return Fuzzy(field, value, fuzziness)


def geo_distance(field: str, lat: float, lon: float, distance: str | float) -> GeoDistance:
    return GeoDistance(field, lat, lon, distance)


def geo_bounding_box(field: str, top_lat: float, left_lon: float, bottom_lat: float, right_lon: float) -> GeoBoundingBox:
    return GeoBoundingBox(field, top_lat, left_lon, bottom_lat, right_lon)


def nested(path: str, condition: Condition) -> Nested:
    return Nested(path, condition)


def match_all() -> MatchAll:
    return MatchAll()


def expression(column: Column) -> Expression:
    return Expression(column)


def lifted(condition: Condition | Column) -> Condition:
    """Plain Spark columns are accepted wherever a condition is."""
    return Expression(condition) if isinstance(condition, Column) else condition


def all_of(*conditions: Condition | Column) -> Bool:
    """Every condition holds; exact ones restrict, textual ones also score."""
    conditions = tuple(map(lifted, conditions))
    return Bool(
        must=tuple(c for c in conditions if c.scores), filter=tuple(c for c in conditions if not c.scores)
    )


def any_of(*conditions: Condition | Column, min_match: int | str = 1) -> Bool:
    return Bool(should=tuple(map(lifted, conditions)), minimum_should_match=min_match)


def none_of(*conditions: Condition | Column) -> Bool:
    return Bool(must_not=tuple(map(lifted, conditions)))


@dataclass(frozen=True)
class Every:
    parts: tuple


@dataclass(frozen=True)
class Some:
    parts: tuple


@dataclass(frozen=True)
class Without:
    part: Any


def every(*parts: Any) -> Every:
    return Every(parts)


def some(*parts: Any) -> Some:
    return Some(parts)


def without(part: Any) -> Without:
    return Without(part)


@dataclass(frozen=True)
class KeywordQuery(Condition):
    """Words combined by ``every``, ``some`` and ``without``; each word may
    occur in any of the fields, by default in every text or keyword field."""

    tree: Any
    fields: tuple[str, ...] = ()

    def _resolve(self, node: Any, fields: tuple[str, ...]) -> Condition:
        if isinstance(node, str):
            return any_of(*[Match(f, node) for f in fields])
        if isinstance(node, Every):
            return all_of(*[self._resolve(p, fields) for p in node.parts])
        if isinstance(node, Some):
            return any_of(*[self._resolve(p, fields) for p in node.parts])
        if isinstance(node, Without):
            return none_of(self._resolve(node.part, fields))
        raise TypeError(f"not a word combination: {node!r}")

    def _condition(self, scope: Scope) -> Condition:
        declared = scope.mapping.fields.items()
        fields = self.fields or tuple(
            n for n, f in declared if f.index and (f.is_text or f.type == "keyword")
        )
        return self._resolve(self.tree, fields)

    def predicate(self, scope: Scope) -> Column:
        return self._condition(scope).predicate(scope)

    def outline(self, scope: Scope) -> Column:
        return self._condition(scope).outline(scope)

    def words(self, scope: Scope) -> list[tuple[str, str]]:
        return self._condition(scope).words(scope)

    def score(self, scope: Scope, stats) -> Column:
        return self._condition(scope).score(scope, stats)


def keyword_query(tree: Any, *fields: str) -> KeywordQuery:
    """``keyword_query(every(some("iphone", "samsung"), "electronics"), "title", "category")``"""
    return KeywordQuery(tree, fields)


# --- applying a condition to a table --------------------------------------


def where(df: DataFrame, condition: Condition | Column | None, scope: Scope) -> DataFrame:
    """Rows that satisfy the condition. Long value lists among the top-level
    clauses become semi and anti joins."""
    if condition is None:
        return df
    condition = lifted(condition)
    if isinstance(condition, Terms) and condition.as_join and not scope.slot(condition.field).many:
        return _value_join(df, condition, scope, "left_semi")
    if not isinstance(condition, Bool):
        return df.where(condition.predicate(scope))
    joined = lambda c: isinstance(c, Terms) and c.as_join and not scope.slot(c.field).many
    keep = [c for c in (*condition.must, *condition.filter) if joined(c)]
    drop = [c for c in condition.must_not if joined(c)]
    if keep or drop:
        required = condition.needed
        condition = Bool(
            must=tuple(c for c in condition.must if c not in keep),
            filter=tuple(c for c in condition.filter if c not in keep),
            should=condition.should,
            must_not=tuple(c for c in condition.must_not if c not in drop),
            minimum_should_match=required,
        )
    df = df.where(condition.predicate(scope))
    for c in keep:
        df = _value_join(df, c, scope, "left_semi")
    for c in drop:
        df = _value_join(df, c, scope, "left_anti")
    return df


def _value_join(df: DataFrame, c: Terms, scope: Scope, how: str) -> DataFrame:
    slot = scope.slot(c.field)
    values = c.values
    if not isinstance(values, DataFrame):
        values = df.sparkSession.createDataFrame([(v,) for v in values], "_value " + slot.type.simpleString())
        # The list came from the caller, so its length is known here.
        if len(c.values) <= 1_000_000:
            values = F.broadcast(values)
    else:
        values = values.toDF("_value")
    return df.join(values, slot.column == values["_value"], how)
