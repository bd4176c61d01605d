"""Text analysis as column expressions.

A chain is char filters (string -> string), one tokenizer (string -> list) and
token filters (list -> list). Every stage is a built-in Spark expression but the
Porter stemmer and the character grams of tokens, which are Arrow-batched
functions: analysing a text needs no shuffle, and Python only for those two.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftframe.functions.grams import token_grams
from siftframe.functions.stemming import porter_stem_tokens
from siftframe.session import fits_broadcast, stage

Stage = Callable[[Column], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once per row. Expressions inside a
    lambda are not shared by the optimizer, so a costly input is bound here."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- char filters ---------------------------------------------------------

# The five basic HTML entities; the ampersand comes last so that
# an escaped entity is decoded once.
HTML_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def html_strip(c: Column) -> Column:
    """Text of an HTML page: script and style bodies, comments and tags give
    way to a blank, basic entities are decoded."""
    c = F.regexp_replace(c, r"(?is)<script\b[^>]*>.*?</script\s*>", " ")
    c = F.regexp_replace(c, r"(?is)<style\b[^>]*>.*?</style\s*>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"<[^>]+>", " ")
    for entity, char in HTML_ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def char_mapping(rules: dict[str, str]) -> Stage:
    """Literal replacements, in the order given."""

    def apply(c: Column) -> Column:
        for old, new in rules.items():
            c = F.replace(c, F.lit(old), F.lit(new))
        return c

    return apply


def pattern_replace(pattern: str, replacement: str) -> Stage:
    return lambda c: F.regexp_replace(c, pattern, replacement)


# --- tokenizers -----------------------------------------------------------

# A letter, mark, digit or underscore that is not Han. ASCII (``\w``) is asked for
# first, so that only other characters are looked up by script.
_RUN = r"[\w[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]]"


def standard(c: Column) -> Column:
    """Runs of letters and digits; each Han character is a word of its own."""
    return F.regexp_extract_all(c, F.lit(rf"{_RUN}+|\p{{IsHan}}"), F.lit(0))


def standard_limited(max_token_length: int) -> Stage:
    """As ``standard``; a longer run is split at the limit."""
    pattern = rf"{_RUN}{{1,{max_token_length}}}|\p{{IsHan}}"
    return lambda c: F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def letter(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\p{L}+"), F.lit(0))


def lowercase_letter(c: Column) -> Column:
    return letter(F.lower(c))


def whitespace(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\S+"), F.lit(0))


def keyword(c: Column) -> Column:
    return F.when(c.isNotNull(), F.array(c))


def pattern(regex: str = r"\W+") -> Stage:
    return lambda c: F.filter(F.split(c, regex), lambda t: t != "")


def ngram(min_gram: int = 1, max_gram: int = 2) -> Stage:
    """Every substring of min to max characters, by length, then position."""

    def grams(c: Column) -> Column:
        def of_length(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.length(c) - (n - 1))
            return F.when(F.length(c) >= n, F.transform(starts, lambda i: F.substring(c, i, F.lit(n)))).otherwise(
                F.array().cast("array<string>")
            )

        parts = [of_length(n) for n in range(min_gram, max_gram + 1)]
        return F.when(c.isNotNull(), F.concat(*parts))

    return grams


def edge_ngram(min_gram: int = 1, max_gram: int = 2) -> Stage:
    """Prefixes of min to max characters."""

    def grams(c: Column) -> Column:
        sizes = F.sequence(F.lit(min_gram), F.least(F.lit(max_gram), F.length(c)))
        return F.when(F.length(c) >= min_gram, F.transform(sizes, lambda n: F.substring(c, F.lit(1), n))).when(
            c.isNotNull(), F.array().cast("array<string>")
        )

    return grams


def path_hierarchy(c: Column) -> Column:
    """``/a/b/c`` gives ``/a``, ``/a/b``, ``/a/b/c``."""
    lead = F.when(c.startswith("/"), "/").otherwise("")

    def prefixes(parts: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(parts))
        paths = F.transform(steps, lambda i: F.concat(lead, F.array_join(F.slice(parts, F.lit(1), i), "/")))
        return F.when(F.size(parts) > 0, paths).otherwise(F.array().cast("array<string>"))

    return let(F.filter(F.split(c, "/"), lambda p: p != ""), prefixes)


# What counts as a URL and as an e-mail address.
URL_PATTERN = r"https?://[^\s<>\"']+"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def url_email(c: Column) -> Column:
    """A URL or an e-mail address is one token, other text is split as by ``standard``."""
    return F.regexp_extract_all(c, F.lit(rf"{URL_PATTERN}|{EMAIL_PATTERN}|{_RUN}+|\p{{IsHan}}"), F.lit(0))


# --- token filters --------------------------------------------------------

# The usual short English stop list.
ENGLISH_STOP = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()

# Function words of the other languages with a named analyser.
STOP_WORDS = {
    "english": ENGLISH_STOP,
    "french": "au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me mes mon ne "
    "nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous".split(),
    "german": "aber als am an auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen "
    "einer er es für hat ich ihr im in ist ja mit nach nicht noch nur ob oder sich sie sind so über um und uns von "
    "vor war wenn wie wir zu zum zur".split(),
    "spanish": "a al algo como con de del donde el ella ellos en entre era es esta este fue ha hay la las le les lo "
    "los me mi muy más nada ni no nos o para pero por que qué se si sin sobre su sus también te tu un una uno y ya "
    "yo".split(),
}


def lowercase(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def uppercase(tokens: Column) -> Column:
    return F.transform(tokens, F.upper)


def stop(words: list[str] | None = None) -> Stage:
    """Drop stop words; order and repeats of the others stay."""
    listed = list(ENGLISH_STOP if words is None else words)
    return lambda tokens: F.filter(tokens, lambda t: ~t.isin(listed))


def synonym(rules: dict[str, list[str]]) -> Stage:
    """Single-word rules: a token is followed by its synonyms. For a rules
    table use ``expand_tokens``."""

    def expand(t: Column) -> Column:
        forms = F.array(t)
        for word, more in rules.items():
            forms = F.when(t == word, F.array(F.lit(word), *map(F.lit, more))).otherwise(forms)
        return forms

    return lambda tokens: F.flatten(F.transform(tokens, expand))


def unique(tokens: Column) -> Column:
    return F.array_distinct(tokens)


def truncate(n: int) -> Stage:
    return lambda tokens: F.transform(tokens, lambda t: F.substring(t, 1, n))


def limit(n: int) -> Stage:
    return lambda tokens: F.slice(tokens, 1, n)


def reverse(tokens: Column) -> Column:
    return F.transform(tokens, F.reverse)


def length(min_length: int = 0, max_length: int = 2**31 - 1) -> Stage:
    return lambda tokens: F.filter(tokens, lambda t: F.length(t).between(min_length, max_length))


def token_ngram(min_gram: int = 1, max_gram: int = 2) -> Stage:
    """Grams of every token, in bulk. ``inside`` gives the same for tokens that
    belong to a lambda, where Spark calls no Python."""

    def grams(tokens: Column) -> Column:
        return token_grams(tokens, min_gram, max_gram)

    of_one = ngram(min_gram, max_gram)
    grams.inside = lambda tokens: F.flatten(F.transform(tokens, of_one))
    return grams


def token_edge_ngram(min_gram: int = 1, max_gram: int = 2) -> Stage:
    grams = edge_ngram(min_gram, max_gram)
    return lambda tokens: F.flatten(F.transform(tokens, grams))


# Latin letters without a canonical decomposition.
UNDECOMPOSED = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D",
    "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "TH", "ħ": "h", "Ħ": "H", "ı": "i",
}


def _accented() -> dict[str, str]:
    """Accented letters of Latin-1 and Latin Extended A and B, by decomposition."""
    table = {}
    for code in range(0xC0, 0x250):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) == 1 and base.isascii() and base != chr(code):
            table[chr(code)] = base
    return table


def fold_string(c: Column) -> Column:
    singles = _accented() | {k: v for k, v in UNDECOMPOSED.items() if len(v) == 1}
    c = F.translate(c, "".join(singles), "".join(singles.values()))
    for old, new in UNDECOMPOSED.items():
        if len(new) > 1:
            c = F.replace(c, F.lit(old), F.lit(new))
    return c


def asciifolding(tokens: Column) -> Column:
    return F.transform(tokens, fold_string)


def trim(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.trim(t))


def word_delimiter(tokens: Column) -> Column:
    """Split at a change from lower to upper case, between letters and digits
    and at punctuation: ``WiFi`` gives ``Wi``, ``Fi``."""
    regex = F.lit(r"\p{Lu}*[\p{Ll}\p{M}]+|\p{Lu}+|\p{Lo}+|\p{N}+")
    return F.flatten(F.transform(tokens, lambda t: F.regexp_extract_all(t, regex, F.lit(0))))


def porter_stem(tokens: Column) -> Column:
    """English stems (Porter 1980)."""
    return porter_stem_tokens(tokens)


# Rules that are looked up inside the row; a larger table is joined.
INLINE_RULES = 50_000
# Tables that the rules of a row's own words are dealt to, at most.
ROW_TABLES = 64


def _lookup(df: DataFrame, rules: DataFrame) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``df`` beside a table (word, forms) of proven size, as a column ``_rules``,
    and the forms of a word by it. The table is an array of buckets by hash that
    enters the plan as one value, so nothing moves, and a word is compared with
    the few rules of its bucket."""
    n = 16
    while n < rules.count():
        n *= 2
    place = lambda w: F.pmod(F.xxhash64(w), F.lit(n)).cast("int")
    filled = rules.groupBy(place(F.col("word")).alias("b")).agg(F.sort_array(F.collect_list(F.struct("word", "forms"))).alias("e"))
    every = rules.sparkSession.range(n).select(F.col("id").cast("int").alias("b")).join(filled, "b", "left")
    table = every.agg(F.sort_array(F.collect_list(F.struct("b", "e"))).alias("t")).select(F.transform("t", lambda x: x["e"])).scalar()
    found = lambda w: F.get(F.filter(F.get("_rules", place(w)), lambda x: x["word"] == w), F.lit(0))["forms"]
    return df.withColumn("_rules", table), found


def _rewritten(tokens: Column, hits: Column, keep: bool) -> Column:
    """``tokens`` with the forms of ``hits`` (at, n, forms; ascending by place,
    one per place) in place of their words, or after them. From left to right a
    hit uses up its words; hits that begin among used words are left out."""
    start = F.struct(F.lit(0).alias("next"), F.filter(hits, lambda h: F.lit(False)).alias("chosen"))

    def step(state: Column, h: Column) -> Column:
        taken = F.struct((h["at"] + h["n"]).alias("next"), F.concat(state["chosen"], F.array(h)).alias("chosen"))
        return F.when(h["at"] >= state["next"], taken).otherwise(state)

    def assembled(chosen: Column) -> Column:
        def ended(j: Column) -> Column:
            before = F.get(chosen, j - 1)
            return F.when(j > 0, before["at"] + before["n"]).otherwise(F.lit(0))

        def piece(h: Column, j: Column) -> Column:
            begin = ended(j)
            upto = h["at"] + h["n"] if keep else h["at"]
            return F.concat(F.slice(tokens, begin + 1, upto - begin), h["forms"])

        rest = ended(F.size(chosen))
        return F.flatten(F.concat(F.transform(chosen, piece), F.array(F.slice(tokens, rest + 1, F.size(tokens) - rest))))

    return let(F.aggregate(hits, start, step, lambda state: state["chosen"]), assembled)


def expand_phrases(df: DataFrame, tokens_col: str, rules: DataFrame, keep: bool, out: str) -> DataFrame:
    """Token filter against a table of ``(phrase, form)`` rules of one or more
    words, separated by single blanks: ``new york`` to ``ny``.

    Rules are matched from left to right, the longest one at a place wins, and
    the words it matches are used up, so matches never overlap. ``keep=True``
    appends the forms to the words (synonyms), ``keep=False`` puts them in their
    place; several forms of a phrase come in order, a form of several words
    gives as many tokens. Null phrases and forms are no rules. Null token lists
    stay null. A column named ``out`` is replaced.

    Up to ``INLINE_RULES`` phrases are looked up inside the row. More are joined:
    the runs of words that are as long as a rule meet the rules by their text.
    """
    rules = rules.where(F.col("phrase").isNotNull() & F.col("form").isNotNull()).select("phrase", "form").distinct()
    forms = rules.groupBy(F.col("phrase").alias("word")).agg(F.array_sort(F.collect_set("form")).alias("forms"))
    forms = stage(forms.withColumn("forms", F.flatten(F.transform("forms", lambda f: F.split(f, " ")))), "rules")
    # One row per length that occurs.
    lengths = sorted((r[0] for r in forms.select(F.size(F.split("word", " "))).distinct().collect()), reverse=True)
    tokens = F.col(tokens_col)
    if not lengths:
        return df.withColumn(out, tokens)
    run = lambda i, n: F.array_join(F.slice(tokens, i + 1, F.lit(n)), " ", "\0")
    if fits_broadcast(forms, INLINE_RULES):
        df, found = _lookup(df, forms)

        def at(w: Column, i: Column) -> Column:
            tried = [F.when(i + n <= F.size(tokens), found(run(i, n) if n > 1 else w)) for n in lengths]
            longest = F.coalesce(*[F.when(t.isNotNull(), F.struct(i.alias("at"), F.lit(n).alias("n"), t.alias("forms"))) for n, t in zip(lengths, tried)])
            return longest

        hits = F.filter(F.transform(tokens, at), lambda h: h.isNotNull())
        return df.withColumn(out, F.when(tokens.isNotNull(), let(hits, lambda h: _rewritten(tokens, h, keep)))).drop("_rules")
    df = stage(df.withColumn("_row", F.monotonically_increasing_id()), "tokens")
    runs = F.flatten(
        F.transform(
            tokens,
            lambda w, i: F.filter(
                F.array(*[F.struct(i.alias("at"), F.lit(n).alias("n"), F.when(i + n <= F.size(tokens), run(i, n)).alias("word")) for n in lengths]),
                lambda x: x["word"].isNotNull(),
            ),
        )
    )
    some = df.select("_row", F.explode(runs).alias("r")).select("_row", "r.*").join(forms, "word")
    longest = some.groupBy("_row", "at").agg(F.max_by(F.struct("at", "n", "forms"), "n").alias("h"))
    hits = longest.groupBy("_row").agg(F.array_sort(F.collect_list("h")).alias("_hits"))
    none = F.filter(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.array(F.lit("")).alias("forms"))), lambda h: F.lit(False))
    joined = df.join(hits, "_row", "left")
    rewritten = let(F.coalesce("_hits", none), lambda h: _rewritten(tokens, h, keep))
    return joined.withColumn(out, F.when(tokens.isNotNull(), rewritten)).drop("_row", "_hits")


def expand_tokens(df: DataFrame, id_col: str, tokens_col: str, rules: DataFrame, keep: bool, out: str) -> DataFrame:
    """Token filter against a table of ``(word, form)`` rules.

    ``keep=True`` appends the forms to the word (synonyms), ``keep=False`` puts
    the form in its place (dictionary lemma). Words without a rule stay. Up to
    ``INLINE_RULES`` words are looked up inside the row, and nothing moves. A
    larger table of proven size is broadcast; beyond that the join shuffles by
    word, and adaptive execution splits the partition of a word that is a large
    share of all tokens.
    """
    rules = stage(rules.select("word", "form"), "rules")
    forms = rules.groupBy("word").agg(F.array_sort(F.collect_set("form")).alias("_forms"))
    if fits_broadcast(rules, INLINE_RULES):
        df, found = _lookup(df, stage(forms.where("word IS NOT NULL").select("word", F.col("_forms").alias("forms")), "forms"))
        new = (lambda w: F.concat(F.array(w), found(w))) if keep else found
        return df.withColumn(out, F.flatten(F.transform(tokens_col, lambda w: F.coalesce(new(w), F.array(w))))).drop("_rules")
    # Written once: texts are analysed once, and row numbers hold, which keep
    # rows apart that share an id.
    df = stage(df.withColumn("_row", F.monotonically_increasing_id()), "tokens")
    # Only the distinct words of a row that have a rule travel, without their places. The
    # outer form, as the inner one would work out the token list twice.
    words = df.select("_row", F.explode_outer(F.array_distinct(F.col(tokens_col))).alias("word")).where("word IS NOT NULL")
    # A rule is two words, some tens of bytes.
    if fits_broadcast(rules, 1_000_000):
        forms = F.broadcast(forms)
    # One group is one row's words, never more than a text's length.
    hits = words.join(forms, "word").groupBy("_row").agg(F.collect_list(F.struct("word", "_forms")).alias("_hits"))
    # A few words in each of a row's tables, as they are looked through from the start.
    place = lambda w, n: F.pmod(F.xxhash64(w), n).cast("int")
    n = F.greatest(F.lit(1), F.least(F.lit(ROW_TABLES), F.ceil(F.size("_hits") / 8))).cast("int")
    part = lambda b: F.map_from_entries(F.filter("_hits", lambda h: place(h["word"], n) == b))
    own = hits.select("_row", F.transform(F.sequence(F.lit(0), n - 1), part).alias("_own"))
    found = lambda w: F.try_element_at(F.get("_own", place(w, F.size("_own"))), w)
    new = (lambda w: F.concat(F.array(w), found(w))) if keep else found
    tokens = F.flatten(F.transform(tokens_col, lambda w: F.coalesce(new(w), F.array(w))))
    return df.join(own, "_row", "left").withColumn(out, tokens).drop("_row", "_own")


def stem_tokens(df: DataFrame, tokens_col: str, out: str) -> DataFrame:
    """Token filter: English stems (Porter 1980) of a list column. Each distinct
    word is stemmed once; words that change become the rules of
    ``expand_tokens``, so token lists themselves never leave the JVM. Null lists
    and words stay null."""
    words = df.select(F.explode(tokens_col).alias("word")).where("word IS NOT NULL").distinct()
    stems = words.select("word", F.get(porter_stem_tokens(F.array("word")), F.lit(0)).alias("form"))
    return expand_tokens(df, "", tokens_col, stems.where("word <> form"), keep=False, out=out)


# --- chains ---------------------------------------------------------------


@dataclass(frozen=True)
class Analyzer:
    """Char filters, a tokenizer and token filters, applied in this order.

    ``substring_tokens`` says that every token occurs literally in the lower
    case text, which lets conditions test the raw text before analysing it.
    """

    tokenizer: Stage
    filters: tuple[Stage, ...] = ()
    char_filters: tuple[Stage, ...] = ()
    substring_tokens: bool = False
    query: "Analyzer | None" = None  # how query texts are analysed, if otherwise

    def tokens(self, c: Column) -> Column:
        for f in self._stages():
            c = f(c)
        return c

    def tokens_inside(self, c: Column) -> Column:
        """As ``tokens``, for a text that belongs to a lambda."""
        for f in self._stages():
            c = getattr(f, "inside", f)(c)
        return c

    def _stages(self) -> tuple[Stage, ...]:
        return (*self.char_filters, self.tokenizer, *self.filters)

    def words(self, text: str) -> list[str]:
        """The words of a query text, by the same chain (one-row query)."""
        return _query_words(self.query or self, text)


@lru_cache(maxsize=4096)
def _query_words(chain: Analyzer, text: str) -> list[str]:
    one_row = SparkSession.active().sql("SELECT 1 AS one")
    return list(one_row.select(chain.tokens(F.lit(text)).alias("words")).head().words)


def _lower_first(tokenizer: Stage) -> Stage:
    # Lower-casing the whole text is one built-in call instead of one per token.
    return lambda c: tokenizer(F.lower(c))


STANDARD = Analyzer(_lower_first(standard), substring_tokens=True)
SIMPLE = Analyzer(lowercase_letter, substring_tokens=True)
WHITESPACE = Analyzer(whitespace)
KEYWORD = Analyzer(keyword)
# Words with all their beginnings; a query's words are looked up as typed.
AS_YOU_TYPE = Analyzer(_lower_first(standard), (token_edge_ngram(1, 20),), substring_tokens=True, query=STANDARD)
PATTERN = Analyzer(_lower_first(pattern()), substring_tokens=True)

TOKENIZERS: dict[str, Stage] = {
    "standard": standard,
    "letter": letter,
    "lowercase": lowercase_letter,
    "whitespace": whitespace,
    "keyword": keyword,
    "pattern": pattern(),
    "ngram": ngram(),
    "edge_ngram": edge_ngram(),
    "path_hierarchy": path_hierarchy,
    "uax_url_email": url_email,
}

TOKEN_FILTERS: dict[str, Stage] = {
    "lowercase": lowercase,
    "uppercase": uppercase,
    "stop": stop(),
    "porter_stem": porter_stem,
    "stemmer": porter_stem,
    "unique": unique,
    "reverse": reverse,
    "ngram": token_ngram(),
    "edge_ngram": token_edge_ngram(),
    "asciifolding": asciifolding,
    "trim": trim,
    "word_delimiter": word_delimiter,
}

CHAR_FILTERS: dict[str, Stage] = {"html_strip": html_strip}


def language(name: str) -> Analyzer:
    """Standard words without the stop words of the language."""
    return Analyzer(_lower_first(standard), (stop(STOP_WORDS[name]),), substring_tokens=True)


def named_analyzer(name: str) -> Analyzer:
    fixed = {"standard": STANDARD, "simple": SIMPLE, "whitespace": WHITESPACE, "keyword": KEYWORD, "pattern": PATTERN}
    if name in fixed:
        return fixed[name]
    if name in STOP_WORDS:
        return language(name)
    raise ValueError(f"unknown analyzer: {name}")


def tokenizer(
    type: str,
    max_token_length: int | None = None,
    min_gram: int | None = None,
    max_gram: int | None = None,
    token_chars: tuple[str, ...] = (),
    pattern_regex: str = r"\W+",
) -> Stage:
    """A tokenizer with options. ``token_chars`` keeps only runs of the named
    character classes before gram cutting."""
    if type == "standard" and max_token_length:
        return standard_limited(max_token_length)
    if type in ("ngram", "edge_ngram"):
        lo = 1 if min_gram is None else min_gram
        hi = 2 if max_gram is None else max_gram
        grams = ngram(lo, hi) if type == "ngram" else edge_ngram(lo, hi)
        if not token_chars:
            return grams
        runs = "[" + "".join(TOKEN_CHARS[x] for x in token_chars) + "]+"
        return lambda c: F.flatten(F.transform(F.regexp_extract_all(c, F.lit(runs), F.lit(0)), grams))
    base = pattern(pattern_regex) if type == "pattern" else TOKENIZERS[type]
    if not max_token_length:
        return base

    def split_long(t: Column) -> Column:
        pieces = F.sequence(F.lit(1), F.length(t), F.lit(max_token_length))
        return F.transform(pieces, lambda i: F.substring(t, i, F.lit(max_token_length)))

    return lambda c: F.flatten(F.transform(base(c), split_long))


# Character classes a tokenizer may be limited to.
TOKEN_CHARS = {"letter": r"\p{L}", "digit": r"\p{N}", "whitespace": r"\s", "punctuation": r"\p{P}", "symbol": r"\p{S}"}


def analyzer(
    tokenizer: str | Stage = "standard",
    filters: tuple[str | Stage, ...] = (),
    char_filters: tuple[str | Stage, ...] = (),
) -> Analyzer:
    """A custom chain from names or stage functions."""
    pick = lambda table, x: table[x] if isinstance(x, str) else x
    return Analyzer(
        pick(TOKENIZERS, tokenizer),
        tuple(pick(TOKEN_FILTERS, f) for f in filters),
        tuple(pick(CHAR_FILTERS, f) for f in char_filters),
    )
