"""A stored index of a text field: postings in blocks, and its vocabulary.

Every addition of rows is a set of folders of its own, published as one version
(``sources.snapshots``), so an index grows by appending and readers keep theirs.

``blocks``      up to ``BLOCK`` postings of a word (id, frequency, length, positions) with the
                greatest frequency and least length among them, from which the greatest score
                follows whatever the mean length has become. Documents are dealt to parts by
                their id, and a word's postings to blocks inside a part, best ones first, so
                no group holds more than the documents of a part, however frequent the word.
``terms``       the distinct words of an addition.
``grams``       three-letter pieces of each word, ends marked: the way from a pattern to the
                few words it may fit.
``neighbours``  hashes of the three pieces of a word: of a word at edit distance two or less
                one piece at least is whole, moved by two letters at most.

Patterns are tested on the vocabulary only. Queries never read a text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftframe.functions.analysis import Analyzer, let
from siftframe.operators.scoring import idf, saturation
from siftframe.plans.collection import Collection
from siftframe.plans.conditions import Condition, Fuzzy, Match, MatchPhrase, Prefix, Regexp, Term, Wildcard
from siftframe.session import BROADCAST_ROWS, fits_broadcast, stage
from siftframe.sources.snapshots import Commit, Snapshot, Snapshots

BLOCK = 128  # postings of a block
PART_ROWS = 1 << 16  # documents of a part, about
BUCKETS = 16  # folders of each table, by hash of the word or gram
NEAR = 2  # edits that leave one of a word's NEAR + 1 pieces whole
DEALT = 8  # tasks that write a bucket of the vocabulary
LONGEST = 40  # letters of a word that has neighbours; longer ones are compared one by one
START, END = "\x02", "\x03"
_PROBE = 100
_ROUNDING = 1e-6


def _bucket(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def _part(key: Column, parts: int | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def positional_postings(c: Collection, field: str) -> DataFrame:
    """``(id, term, tf, dl, positions)`` per distinct word of a row, counted
    inside the row: positions are those in the list of its words, from 0."""
    slot = c.scope.slot(field)

    def runs(words: Column) -> Column:
        n = F.size(words)
        first = F.transform(words, lambda w, i: F.when((i == 0) | (w["term"] != F.get(words, i - 1)["term"]), i))

        def one(at: Column) -> Column:
            def posting(start: Column, j: Column) -> Column:
                end = F.coalesce(F.get(at, j + 1), n)
                return F.struct(
                    F.get(words, start)["term"].alias("term"),
                    (end - start).alias("tf"),
                    n.alias("dl"),
                    F.transform(F.slice(words, start + 1, end - start), lambda w: w["at"]).alias("positions"),
                )

            return F.transform(at, posting)

        return let(F.filter(first, lambda i: i.isNotNull()), one)

    words = F.transform(slot.tokens(), lambda w, i: F.struct(w.alias("term"), i.alias("at")))
    return c.df.select(F.col(c.id).alias("id"), F.inline(let(F.sort_array(words), runs)))


def _piece(length: Column, i: int) -> tuple[Column, Column]:
    """Where piece ``i`` of a word of this length begins, from 0, and its length.
    The last pieces have one letter more if it does not divide."""
    n = NEAR + 1
    short, longer = F.floor(length / n).cast("int"), (length % n).cast("int")
    more = F.greatest(F.lit(0), longer - (n - i))
    return short * i + more, short + (longer >= n - i).cast("int")


def _key(length: Column, i: int, piece: Column) -> Column:
    return F.xxhash64(length.cast("int"), F.lit(i), piece)


def _pieces(word: Column) -> Column:
    """Hashes of the pieces of a word, with its length and their number."""

    def one(i: int) -> Column:
        begin, n = _piece(F.length(word), i)
        return _key(F.length(word), i, F.substring(word, begin + 1, n))

    return F.array(*[one(i) for i in range(NEAR + 1)])


def _neighbours(word: Column, k: int = NEAR) -> Column:
    """Hashes of which every word within ``k`` edits (``NEAR`` at most) has one
    among its pieces: the places where a piece of a word of any length within
    reach may be found in ``word``."""
    found = []
    for longer in range(-k, k + 1):
        length = F.length(word) + longer
        for i in range(NEAR + 1):
            begin, n = _piece(length, i)
            for moved in range(-k, k + 1):
                at = begin + moved
                fits = (length >= 0) & (at >= 0) & (at + n <= F.length(word))
                found.append(F.when(fits, _key(length, i, F.substring(word, at + 1, n))))
    return F.array_distinct(F.array_compact(F.array(*found)))


def _shifted(offset: int) -> Column:
    """Where a phrase would begin that has the word at ``offset``."""
    return F.transform("positions", lambda x: x - offset)


def _literal_grams(pieces: list[str]) -> list[str]:
    return sorted({p[i : i + 3] for p in pieces for i in range(len(p) - 2)})


def wildcard_grams(pattern: str) -> list[str]:
    """Three-letter pieces that every word fitting the pattern holds."""
    return _literal_grams(re.split(r"[*?]", START + pattern + END))


def regexp_grams(pattern: str) -> list[str]:
    """The same for a regular expression of letters, ``.`` and simple repeats;
    any other leads to the whole vocabulary."""
    if not re.fullmatch(r"[\w.*+?-]*", pattern) or re.search(r"[*+?]{2}", pattern):
        return []
    # A repeated letter may be absent (? and *) or follow itself (+ and *): it ends a piece.
    marked = re.sub(r"([\w-])\+", lambda m: m[1] + "." + m[1], pattern)
    return _literal_grams(re.split(r"\.[*+?]?|[\w-][*?]", START + marked + END))


@dataclass(frozen=True)
class BatchResult:
    """Best rows per query, and every block of a query's words: whether it was
    opened, its postings and about how many bytes they have."""

    rows: DataFrame
    blocks: DataFrame

    def read(self) -> DataFrame:
        """One row: blocks and bytes there are, and how many were opened."""
        once = self.blocks.groupBy("term", "segment", "part", "block").agg(F.max("opened").alias("opened"), F.max("bytes").alias("bytes"))
        opened = F.col("opened")
        return once.agg(
            F.count("*").alias("blocks"),
            F.count_if(opened).alias("opened"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum(F.when(opened, F.col("bytes"))), F.lit(0)).alias("opened_bytes"),
        )


class TextIndex:
    """The index at ``root``, as of a version (the latest one unless given)."""

    def __init__(self, spark: SparkSession, root: str, chain: Analyzer, version: int | None = None):
        self.spark, self.store, self.chain = spark, Snapshots(spark, root), chain
        self.now: Snapshot = self.store.pinned(version)

    @staticmethod
    def build(c: Collection, field: str, root: str) -> TextIndex:
        """A new index of ``field`` at ``root``."""
        index = TextIndex(c.df.sparkSession, root, c.scope.slot(field).spec.chain)
        return index.added(c, field)

    def added(self, c: Collection, field: str) -> TextIndex:
        """The index with more rows. Their ids are new ones: a row whose text
        has changed is a new row under a new id. Rows without an id, or without
        the field, are not indexed; a text without words counts for the mean
        length."""
        column = c.scope.slot(field).column
        some = c.with_df(c.df.where(F.col(c.id).isNotNull() & column.isNotNull()))
        n = some.df.count()
        parts = max(1, -(-n // PART_ROWS))
        segment = len(self.now.note.get("parts", []))
        posting = F.struct("tf", "dl", "id", "positions")
        found = positional_postings(some, field)
        found = found.withColumns({"bucket": _bucket(F.col("term")), "part": _part(F.col("id"), parts)})
        # Postings move once: dealt by bucket and part, they are grouped, sorted and written in place.
        groups = found.repartition("bucket", "part").groupBy("bucket", "term", "part").agg(F.collect_list(posting).alias("p"))
        # Best first: the order of greatest possible scores, for any mean length.
        impact = F.sort_array(F.transform("p", lambda x: F.struct((-x["tf"]).alias("a"), x["dl"].alias("b"), x["id"].alias("c"), x["positions"].alias("d"))))
        cut = let(
            impact,
            lambda p: F.transform(F.sequence(F.lit(0), (F.size(p) - 1).cast("int"), F.lit(BLOCK)), lambda at: F.slice(p, at + 1, BLOCK)),
        )
        blocks = groups.select("bucket", "term", "part", F.posexplode(cut).alias("block", "p")).select(
            "term",
            F.lit(segment).alias("segment"),
            "part",
            "block",
            F.size("p").alias("n"),
            (-F.array_min(F.transform("p", lambda x: x["a"]))).alias("max_tf"),
            F.array_min(F.transform("p", lambda x: x["b"])).alias("min_dl"),
            F.transform("p", lambda x: x["c"]).alias("ids"),
            F.transform("p", lambda x: -x["a"]).alias("tfs"),
            F.transform("p", lambda x: x["b"]).alias("dls"),
            F.transform("p", lambda x: x["d"]).alias("positions"),
            "bucket",
        )
        with self.store.commit() as commit:
            commit.append("blocks", blocks.sortWithinPartitions("bucket", "term"), by=["bucket"])
            written = commit.read("blocks")
            words = written.agg(F.coalesce(F.sum(F.aggregate("tfs", F.lit(0).cast("bigint"), lambda a, x: a + x)), F.lit(0))).first()[0]
            commit.append("terms", written.select("term").distinct())
            self._append_vocabulary(commit, commit.read("terms"))
            note = commit.note
            commit.note = {"n": note.get("n", 0) + n, "words": note.get("words", 0) + words, "parts": [*note.get("parts", []), parts]}
        return TextIndex(self.spark, self.store.root, self.chain)

    @staticmethod
    def _append_vocabulary(commit: Commit, terms: DataFrame) -> None:
        """The ways to the words of an addition."""
        padded = F.concat(F.lit(START), F.col("term"), F.lit(END))
        pieces = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))
        grams = terms.select(F.explode(F.array_distinct(pieces)).alias("gram"), "term").withColumn("bucket", _bucket(F.col("gram")))
        short = terms.where(F.length("term") <= LONGEST)
        near = short.select(F.explode(_pieces(F.col("term"))).alias("key"), "term").withColumn("bucket", _bucket(F.col("key")))
        for name, rows, key in (("grams", grams, "gram"), ("neighbours", near, "key")):
            commit.append(name, rows.repartition("bucket", _part(F.col("term"), DEALT)).sortWithinPartitions("bucket", key), by=["bucket"])

    # -- vocabulary ----------------------------------------------------------

    def terms(self) -> DataFrame:
        """All distinct words."""
        return self.now.read("terms").distinct()

    def _holding(self, grams: list[str]) -> DataFrame:
        """Words that hold all the grams; all words without any."""
        if not grams:
            return self.terms()
        rows = self._some("grams", "gram", grams)
        return rows.groupBy("term").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select("term")

    def _some(self, table: str, column: str, values: list) -> DataFrame:
        """Rows with one of the values, from their buckets only."""
        if not values:
            return self.now.read(table).limit(0)
        literals = F.array(*[F.lit(v) for v in values])
        buckets = self.spark.range(1).select(F.transform(literals, _bucket).alias("b")).first()["b"]
        return self.now.read(table).where(F.col("bucket").isin(sorted(set(buckets))) & F.col(column).isin(values))

    def terms_like(self, condition: Wildcard | Prefix | Regexp | Fuzzy) -> DataFrame:
        """Words that fit a pattern, or are near to a word."""
        if isinstance(condition, Fuzzy):
            return self._near(condition.value, condition.distance)
        term = F.col("term")
        if isinstance(condition, Prefix):
            found = self._holding(_literal_grams([START + condition.value]))
            return found.where(term.startswith(condition.value))
        if isinstance(condition, Wildcard):
            like = re.sub(r"([%_\\])", r"\\\1", condition.pattern).replace("*", "%").replace("?", "_")
            return self._holding(wildcard_grams(condition.pattern)).where(term.like(like))
        return self._holding(regexp_grams(condition.pattern)).where(term.rlike(rf"\A(?:{condition.pattern})\z"))

    def _near(self, value: str, k: int) -> DataFrame:
        close = F.levenshtein("term", F.lit(value), k).between(0, k)
        if k > NEAR or len(value) > LONGEST - k:
            return self.terms().where(F.length("term").between(len(value) - k, len(value) + k) & close)
        keys = self.spark.range(1).select(_neighbours(F.lit(value), k).alias("k")).first()["k"]
        return self._some("neighbours", "key", keys).select("term").distinct().where(close)

    # -- rows ----------------------------------------------------------------

    def frequencies(self, terms: list[str]) -> dict[str, int]:
        """In how many rows each of a query's words is."""
        rows = self._some("blocks", "term", terms).groupBy("term").agg(F.sum("n").alias("df")).collect()
        return {r["term"]: r["df"] for r in rows}

    def holding(self, terms: DataFrame) -> DataFrame:
        """Ids of the rows that hold any of a table of words."""
        if fits_broadcast(terms):
            terms = F.broadcast(terms)
        blocks = self.now.read("blocks").select("term", "ids").join(terms, "term", "left_semi")
        return blocks.select(F.explode("ids").alias("id")).distinct()

    def phrase(self, text: str) -> DataFrame:
        """``(id, n)``: rows in which the words of ``text`` follow each other,
        and how often.

        Postings are met word by word, the rarest first: starts that a word
        allows are intersected with those that are left. As long as the rows
        left are few they are sent to the others' postings, which then stay in
        place."""
        words = self.chain.words(text)
        df = self.frequencies(sorted(set(words)))
        nothing = self.now.read("blocks").select(F.explode("ids").alias("id"), F.lit(0).alias("n")).limit(0)
        if not words or any(w not in df for w in words):
            return nothing
        left = None
        for word in sorted(set(words), key=lambda w: (df[w], w)):
            offsets = [i for i, w in enumerate(words) if w == word]
            rows = self._some("blocks", "term", [word]).select(F.explode(F.arrays_zip("ids", "positions")).alias("p"))
            rows = rows.select(F.col("p.ids").alias("id"), F.col("p.positions").alias("positions"))
            starts = _shifted(offsets[0])
            for offset in offsets[1:]:
                starts = F.array_intersect(starts, _shifted(offset))
            rows = rows.select("id", starts.alias("starts"))
            if left is None:
                left, few = rows, df[word] <= BROADCAST_ROWS
                continue
            other = rows.withColumnRenamed("starts", "more")
            left = other.join(F.broadcast(left) if few else left, "id")
            left = left.select("id", F.array_intersect("starts", "more").alias("starts")).where(F.size("starts") > 0)
        starts = F.filter("starts", lambda x: x >= 0)
        return left.select("id", F.size(starts).alias("n")).where("n > 0")

    def ids(self, condition: Condition) -> DataFrame:
        """Ids of the rows that satisfy a condition on the indexed field."""
        if isinstance(condition, MatchPhrase):
            return self.phrase(condition.value).select("id")
        if isinstance(condition, Match):
            words = self.chain.words(condition.value)
        elif isinstance(condition, Term):
            words = [condition.value]
        else:
            return self.holding(self.terms_like(condition))
        return self._some("blocks", "term", sorted(set(words))).select(F.explode("ids").alias("id")).distinct()

    def rows(self, c: Collection, condition: Condition) -> DataFrame:
        """Rows of the indexed collection that satisfy the condition; their
        texts are not looked at."""
        ids = self.ids(condition).withColumnRenamed("id", c.id)
        return c.df.join(ids, c.id, "left_semi")

    # -- relevance -----------------------------------------------------------

    def search_batch(self, queries: DataFrame, k: int = 10, query_id: str = "qid", query_text: str = "text") -> BatchResult:
        """Top ``k`` rows by BM25 for every query of a table.

        The rarest words give a first threshold. Words that are frequent and
        light enough to stay below it together are left aside (MaxScore), and of
        the others a block is only opened if its greatest score, with the
        greatest of all the query's other words, reaches the threshold: a row
        with a posting in a block that stays shut cannot be in the result. What
        the words left aside add to the rows that could still get there is read
        from the parts these rows are in. Scores are exact.
        """
        n, words = self.now.note.get("n", 0), self.now.note.get("words", 0)
        avgdl = words / n if n else 1.0
        asked = queries.select(query_id, F.explode(self.chain.tokens(F.col(query_text))).alias("term"))
        asked = stage(asked.groupBy(query_id, "term").agg(F.count("*").alias("times")), "asked")
        small = fits_broadcast(asked)
        hint = F.broadcast if small else (lambda df: df)
        blocks = self.now.read("blocks")
        if small:
            buckets = [r[0] for r in asked.select(_bucket(F.col("term"))).distinct().collect()]  # up to BUCKETS numbers
            blocks = blocks.where(F.col("bucket").isin(buckets))
        place = ["term", "segment", "part", "block"]
        heads = blocks.select(*place, "n", "max_tf", "min_dl")
        heads = stage(heads.join(hint(asked.select("term").distinct()), "term", "left_semi"), "heads")

        frequencies = heads.groupBy("term").agg(F.sum("n").alias("df"))
        weights = asked.join(frequencies, "term")
        weights = weights.select(query_id, "term", "df", (F.col("times") * idf(F.lit(n), F.col("df"))).alias("weight"))
        rarest = W.partitionBy(query_id).orderBy("df", "term").rowsBetween(W.unboundedPreceding, -1)
        weights = stage(weights.withColumn("seen", F.coalesce(F.sum("df").over(rarest), F.lit(0))), "weights")

        def part(tf: str, dl: str) -> Column:
            return F.col("weight") * saturation(F.col(tf), F.col(dl), F.lit(avgdl))

        def scores(wanted: DataFrame) -> DataFrame:
            """Sums over the postings of (query, weight, block) rows."""
            chosen = wanted.select(query_id, "weight", *place)
            met = blocks.select(*place, "ids", "tfs", "dls").join(hint(chosen) if fits_broadcast(chosen) else chosen, place)
            met = met.select(query_id, "weight", F.explode(F.arrays_zip("ids", "tfs", "dls")).alias("p"))
            met = met.select(query_id, F.col("p.ids").alias("id"), "weight", F.col("p.tfs").alias("tf"), F.col("p.dls").alias("dl"))
            return met.groupBy(query_id, "id").agg(F.sum(part("tf", "dl")).alias("score"))

        bounded = heads.join(hint(weights), "term").withColumn("bound", part("max_tf", "min_dl"))
        bounded = stage(bounded, "bounds")
        limit = self._kth(scores(bounded.where(F.col("seen") < _PROBE * k)), query_id, k)

        # Words left aside: the most frequent ones, as long as their greatest scores stay below the threshold.
        tops = bounded.groupBy(query_id, "term").agg(F.max("bound").alias("top"), F.max("df").alias("df"))
        most = W.partitionBy(query_id).orderBy(F.desc("df"), "term").rowsBetween(W.unboundedPreceding, 0)
        tops = tops.withColumn("upto", F.sum("top").over(most)).withColumn("all", F.sum("top").over(W.partitionBy(query_id)))
        tops = tops.join(limit, query_id, "left")
        lifts = F.coalesce(F.col("upto") >= F.col("threshold"), F.lit(True))
        tops = stage(tops.withColumn("lifts", lifts), "tops")
        known = tops.select(query_id, "term", "top", "all", "threshold", "lifts")
        bounded = bounded.join(hint(known), [query_id, "term"])
        reaches = F.coalesce(F.col("bound") + F.col("all") - F.col("top") >= F.col("threshold"), F.lit(True))
        bounded = stage(bounded.withColumn("opened", F.col("lifts") & reaches), "blocks")

        partial = stage(scores(bounded.where("opened")), "partial")
        aside = tops.where("not lifts").groupBy(query_id).agg(F.max("upto").alias("aside"))
        limit = self._kth(partial, query_id, k).join(aside, query_id, "left")
        reach = F.col("score") + F.coalesce("aside", F.lit(0.0)) >= F.col("threshold")
        candidates = partial.join(limit, query_id, "left").where(F.coalesce(reach, F.lit(True)))
        candidates = stage(candidates.select(query_id, "id", "score"), "candidates")

        # The parts that hold a candidate, of the words left aside.
        parts = [F.struct(F.lit(s).alias("segment"), _part(F.col("id"), p).alias("part")) for s, p in enumerate(self.now.note.get("parts", []))]
        spread = candidates.select(query_id, "id", F.explode(F.array(*parts)).alias("p")).select(query_id, "id", "p.*") if parts else None
        rows, opened = candidates, bounded
        if spread is not None:
            need = bounded.where("not lifts").select(query_id, "weight", *place)
            need = need.join(spread.select(query_id, "segment", "part").distinct(), [query_id, "segment", "part"], "left_semi")
            met = blocks.select(*place, "ids", "tfs", "dls").join(need.select(*place).distinct(), place, "left_semi")
            met = met.select("term", "segment", "part", F.explode(F.arrays_zip("ids", "tfs", "dls")).alias("p"))
            met = met.select("term", F.col("p.ids").alias("id"), F.col("p.tfs").alias("tf"), F.col("p.dls").alias("dl"))
            ours = candidates.select("id").distinct()
            met = met.join(F.broadcast(ours) if fits_broadcast(ours) else ours, "id", "left_semi")
            lost = candidates.select(query_id, "id").join(known.where("not lifts").select(query_id, "term").distinct(), query_id)
            lost = lost.join(weights.select(query_id, "term", "weight"), [query_id, "term"])
            more = lost.join(met, ["id", "term"]).select(query_id, "id", part("tf", "dl").alias("score"))
            rows = candidates.unionByName(more).groupBy(query_id, "id").agg(F.sum("score").alias("score"))
            second = need.select(query_id, *place).withColumn("second", F.lit(True))
            opened = bounded.join(second, [query_id, *place], "left")
            opened = opened.withColumn("opened", F.col("opened") | F.coalesce("second", F.lit(False)))
        rows = rows.withColumn("_score", F.round("score", 9))
        best = W.partitionBy(query_id).orderBy(F.desc("_score"), "id")
        rows = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        sizes = opened.withColumn("bytes", F.col("n") * 24)
        return BatchResult(rows.select(query_id, "id", "_score", "rank"), sizes.select(query_id, *place, "n", "bytes", "opened"))

    def _kth(self, found: DataFrame, query_id: str, k: int) -> DataFrame:
        """The k-th best score of each query that has so many rows, less what
        rounding may take away."""
        best = W.partitionBy(query_id).orderBy(F.desc("score"), "id")
        last = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
        return last.select(query_id, (F.col("score") - _ROUNDING).alias("threshold"))
