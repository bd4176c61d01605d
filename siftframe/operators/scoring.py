"""Relevance: BM25 (Robertson and Zaragoza, 2009) over analysed fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftframe.functions.analysis import let
from siftframe.plans.collection import Collection, Scope, Slot
from siftframe.plans.conditions import Condition, where
from siftframe.session import fits_broadcast, stage

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def saturation(tf: Column, dl: Column, avgdl: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))


class QueryStats:
    """Statistics of the few words of one query, as one struct computed by a
    single aggregation over the whole collection. The struct enters the
    scoring plan as a scalar subquery: one row, no join.

    ``tables`` gives stored ``term_stats`` tables by field. Their words are
    looked up, and the collection is not scanned for that field.
    """

    def __init__(
        self, c: Collection, pairs: Iterable[tuple[str, str]], tables: dict[str, DataFrame] | None = None
    ):
        self.fields: list[str] = []
        self.words: list[tuple[str, str]] = []
        self.scope = c.scope
        for field, text in pairs:
            if field not in self.fields:
                self.fields.append(field)
            for word in _words(self.scope.slot(field), text):
                if (field, word) not in self.words:
                    self.words.append((field, word))
        self._df = c.df
        self._tables = tables or {}

    def column(self) -> Column:
        """All statistics of the query as one struct."""
        found = {}
        counted = [f for f in self.fields if f not in self._tables]
        frames = [self._counted(counted)] if counted else []
        frames += [self._looked_up(f) for f in self.fields if f in self._tables]
        for frame in frames:
            row = frame.select(F.struct("*").alias("stats")).scalar()
            found |= {name: row.getField(name) for name in frame.columns}
        return F.struct(*[value.alias(name) for name, value in found.items()])

    def _asked(self, field: str) -> list[tuple[int, str]]:
        return [(j, word) for j, (f, word) in enumerate(self.words) if f == field]

    def _counted(self, fields: list[str]) -> DataFrame:
        slots = {f: self.scope.slot(f) for f in fields}
        base = self._df.select(*[s.terms().alias(f"f{self.fields.index(f)}") for f, s in slots.items()])
        parts = []
        for field, slot in slots.items():
            i = self.fields.index(field)
            parts.append(F.count(f"f{i}").alias(f"n{i}"))
            if slot.is_text:
                lengths = F.sum(F.size(f"f{i}")).cast("double")
                parts.append((lengths / F.nullif(F.count(f"f{i}"), F.lit(0))).alias(f"avgdl{i}"))
            for j, word in self._asked(field):
                hit = F.array_contains(f"f{i}", word) if slot.is_text else F.col(f"f{i}").cast("string") == word
                parts.append(F.count_if(hit).alias(f"df{j}"))
        return base.agg(*parts)

    def _looked_up(self, field: str) -> DataFrame:
        i, asked = self.fields.index(field), self._asked(field)
        rows = self._tables[field].where(F.col("term").isin([word for _, word in asked]))
        return rows.agg(
            F.max("n").alias(f"n{i}"),
            F.max("avgdl").alias(f"avgdl{i}"),
            *[F.coalesce(F.max(F.when(F.col("term") == w, F.col("df"))), F.lit(0)).alias(f"df{j}") for j, w in asked],
        )

    def score(self, slot: Slot, text: str) -> Column:
        """Score of the query text in one field of a row."""
        i = self.fields.index(slot.name)
        stats = F.col("_stats")
        parts = []
        for word in _words(slot, text):
            j = self.words.index((slot.name, word))
            weight = idf(stats[f"n{i}"], stats[f"df{j}"])
            if slot.is_text:
                tokens = slot.tokens()
                dl = F.size(tokens)
                tf = dl - F.size(F.array_remove(tokens, word))
                parts.append(F.when(tf > 0, weight * saturation(tf, dl, stats[f"avgdl{i}"])).otherwise(0.0))
            else:
                parts.append(F.when(slot.column.cast("string") == word, weight).otherwise(0.0))
        return sum(parts, F.lit(0.0))


def _words(slot: Slot, text: str) -> list[str]:
    # A word repeated in the query counts each time, as in the sum of the formula.
    return slot.spec.chain.words(text) if slot.is_text else [text]


def scored(
    c: Collection, condition: Condition | None, term_tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Rows that satisfy the condition, with their ``_score``.

    A text is analysed once per row: rows are first thinned out by tests on the
    raw columns, then the words of the rest become columns, which the exact
    condition and the score both read.
    """
    if condition is None or not condition.scores:
        score = F.lit(1.0 if condition is None else 0.0)
        return where(c.df, condition, c.scope).withColumn("_score", score)
    pairs = condition.words(c.scope)
    if not pairs:
        rows = where(c.df, condition, c.scope)
        return rows.withColumn("_score", condition.score(c.scope, None).cast("double"))
    stats = QueryStats(c, pairs, term_tables)
    texts = [s for s in map(c.scope.slot, stats.fields) if s.is_text and s.stored_tokens is None]
    wide, added = c.df.where(condition.outline(c.scope)), []
    for slot in texts:
        added.append(f"{c.mapping.column_name(slot.name)}__tokens")
        # Through a generator, so that Spark does not copy the analysis into
        # the filter that follows.
        wide = wide.select("*", F.explode(F.array(slot.tokens())).alias(added[-1]))
    scope = Scope(c.mapping, wide.schema)
    rows = where(wide, condition, scope).withColumn("_stats", stats.column())
    return rows.withColumn("_score", condition.score(scope, stats)).drop("_stats", *added)


def postings(c: Collection, field: str) -> DataFrame:
    """``(term, id, tf, dl)`` per distinct word of a row.

    Occurrences are counted inside the row, by sorting its words and measuring
    runs of equal ones, so no token ever crosses the network.
    """
    slot = c.scope.slot(field)

    def runs(words: Column) -> Column:
        n = F.size(words)
        first = F.transform(words, lambda w, i: F.when((i == 0) | (w != F.get(words, i - 1)), i))
        starts = F.filter(first, lambda i: i.isNotNull())
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, j: F.struct(
                    F.get(words, start).alias("term"),
                    (F.coalesce(F.get(at, j + 1), n) - start).cast("bigint").alias("tf"),
                    n.cast("bigint").alias("dl"),
                ),
            ),
        )

    # The list goes straight into the generator: as a column of its own, Spark
    # would also test its size in a filter and so work it out twice.
    counted = c.df.select(c.id, F.inline(let(F.sort_array(slot.tokens()), runs)))
    return counted.select("term", c.id, "tf", "dl")


def term_stats(c: Collection, field: str) -> DataFrame:
    """``(term, df, n, avgdl)``: rows holding each word, beside the collection's
    size and mean length. The counts combine map-side, so a word that is in
    every text is no heavier than any other."""
    slot = c.scope.slot(field)
    totals = collection_stats(c, field).select(F.struct("n", "avgdl").alias("t")).scalar()
    words = c.df.select(F.explode(F.array_distinct(slot.tokens())).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("df"))
    return counts.withColumn("_t", totals).select("term", "df", F.col("_t.n"), F.col("_t.avgdl"))


def collection_stats(c: Collection, field: str) -> DataFrame:
    """One row: number of rows having the field and its mean number of words."""
    slot = c.scope.slot(field)
    sizes = c.df.select(F.size(slot.tokens()).alias("dl"), slot.column.isNotNull().alias("has")).where("has")
    return sizes.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))


# Occurrences per wanted row that are scored to find a first threshold.
_PROBE = 100
# Sums of the same parts may differ in their last digits.
_ROUNDING = 1e-6


def search_batch(
    c: Collection,
    field: str,
    queries: DataFrame,
    k: int = 10,
    query_id: str = "qid",
    query_text: str = "text",
) -> DataFrame:
    """Top ``k`` rows for every query of a table ``(query_id, query_text)``.

    Words that no query uses are dropped before anything is shuffled. A frequent
    word occurs in many rows and in many queries, so pairing all of them would
    dominate the work. The result stays exact without that (the MaxScore
    argument of Turtle and Flood, 1995):

    1. each query's rarest words give partial scores; the k-th best of them is
       a threshold that the final k-th score cannot fall below;
    2. the most frequent words whose greatest possible scores add up to less
       than the threshold cannot lift a row into the result on their own, so
       only rows with one of the other words are candidates;
    3. candidates that could still reach the threshold get their full score.
    """
    slot = c.scope.slot(field)
    asked = queries.select(query_id, F.explode(slot.spec.chain.tokens(F.col(query_text))).alias("term"))
    asked = asked.groupBy(query_id, "term").agg(F.count("*").alias("_times"))
    vocabulary = asked.select("term").distinct()
    small = fits_broadcast(asked)
    if small:
        vocabulary = F.broadcast(vocabulary)

    texts = c.df.select(c.id, slot.tokens().alias("_words"))
    # The outer form keeps Spark from adding a filter on the list's size, which
    # would analyse every text twice; its null terms fall out of the next join.
    words = texts.select(c.id, F.size("_words").alias("dl"), F.explode_outer("_words").alias("term"))
    words = words.join(vocabulary, "term", "left_semi")
    entries = stage(words.groupBy(c.id, "dl", "term").agg(F.count("*").alias("tf")), "postings")

    frequencies = entries.groupBy("term").agg(F.count("*").alias("_df"))
    totals = collection_stats(c, field).select(F.struct("n", "avgdl").alias("t")).scalar()
    weights = asked.join(frequencies, "term").withColumn("_t", totals)
    weights = weights.select(
        query_id,
        "term",
        "_df",
        (F.col("_times") * idf(F.col("_t.n"), F.col("_df"))).alias("_weight"),
        F.col("_t.avgdl").alias("_avgdl"),
    )
    weights = stage(weights, "weights")

    # 1. Windows over a query's own words.
    rarest = W.partitionBy(query_id).orderBy("_df", "term").rowsBetween(W.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("_df").over(rarest), F.lit(0))
    probe = weights.withColumn("_seen", seen).where(F.col("_seen") < _PROBE * k)
    thresholds = _kth_score(c, _partial_scores(c, entries, probe, query_id, small), query_id, k)

    # 2. The threshold is null for a query with too few rows: all words count.
    most_frequent = W.partitionBy(query_id).orderBy(F.desc("_df"), "term").rowsBetween(W.unboundedPreceding, 0)
    bounded = weights.withColumn("_bound", F.sum(F.col("_weight") * (K1 + 1)).over(most_frequent))
    bounded = bounded.join(thresholds, query_id, "left")
    lifts = F.coalesce(F.col("_bound") >= F.col("_threshold"), F.lit(True))
    bounded = stage(bounded.withColumn("_lifts", lifts), "bounds")
    rest = bounded.where(~F.col("_lifts"))

    # 3. Scores of candidates, completed by the words left aside. The partial
    # scores give a closer threshold, so few candidates are left to complete.
    partial = stage(_partial_scores(c, entries, bounded.where("_lifts"), query_id, small), "partial")
    limits = _kth_score(c, partial, query_id, k).join(
        rest.groupBy(query_id).agg(F.max("_bound").alias("_rest")), query_id, "left"
    )
    reach = F.col("_score") + F.coalesce("_rest", F.lit(0.0)) >= F.col("_threshold")
    candidates = partial.join(limits, query_id, "left").where(F.coalesce(reach, F.lit(True)))
    candidates = candidates.select(query_id, c.id, "_score")
    missing = candidates.select(query_id, c.id).join(rest.select(query_id, "term", "_weight", "_avgdl"), query_id)
    added = missing.join(entries, [c.id, "term"]).select(query_id, c.id, _part().alias("_score"))
    scores = candidates.unionByName(added).groupBy(query_id, c.id).agg(F.sum("_score").alias("_score"))
    # Equal scores must tie exactly, whatever order their parts were added in.
    scores = scores.withColumn("_score", F.round("_score", 9))
    return _ranked(c, scores, query_id, k)


def _ranked(c: Collection, scores: DataFrame, query_id: str, k: int) -> DataFrame:
    """Best ``k`` rows per query; Spark cuts every task to ``k`` rows first."""
    best = W.partitionBy(query_id).orderBy(F.desc("_score"), F.asc(c.id))
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _kth_score(c: Collection, scores: DataFrame, query_id: str, k: int) -> DataFrame:
    """The k-th best score of each query that has so many rows, less what
    rounding may take away."""
    last = _ranked(c, scores, query_id, k).where(F.col("rank") == k)
    return last.select(query_id, (F.col("_score") - _ROUNDING).alias("_threshold"))


def _part() -> Column:
    return F.col("_weight") * saturation(F.col("tf"), F.col("dl"), F.col("_avgdl"))


def _partial_scores(c: Collection, entries: DataFrame, weights: DataFrame, query_id: str, small: bool) -> DataFrame:
    """Scores over the given words. Weights proven small are broadcast; others
    meet the postings by word and salt, as one word may hold many of them."""
    weights = weights.select(query_id, "term", "_weight", "_avgdl")
    if small:
        pairs = entries.join(F.broadcast(weights), "term")
    else:
        salts = 32
        copies = weights.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        spread = entries.withColumn("_salt", F.pmod(F.xxhash64(c.id), F.lit(salts)).cast("int"))
        pairs = spread.join(copies, ["term", "_salt"])
    return pairs.groupBy(query_id, c.id).agg(F.sum(_part()).alias("_score"))
