"""Text analysis: char filters, tokenizers, token filters and chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from catalog.tables import WORDS
from siftframe.functions import analysis as a


def shown(df, id: str, tokens: Column):
    """Token lists as text, so that rows compare as plain values."""
    out = df.select(id, tokens.alias("_t"))
    return out.select(id, F.array_join("_t", "|").alias("tokens"), F.size("_t").cast("bigint").alias("n"))


def shown_sql(table: str, id: str, tokens: str) -> str:
    return (
        f"WITH x AS (SELECT {id}, {tokens} AS t FROM {table})"
        f" SELECT {id}, array_to_string(t, '|') AS tokens, CAST(len(t) AS BIGINT) AS n FROM x"
    )


def over_documents(stage):
    return lambda spark, sf: shown(t.load(spark, sf, "documents"), "doc_id", stage(F.col("text")))


def over_words(stage):
    """A token filter on the standard words of every document."""
    return over_documents(lambda c: stage(a.standard(c)))


def over_pages(stage, column: str = "html"):
    return lambda spark, sf: shown(t.load(spark, sf, "pages"), "page_id", stage(F.col(column)))


def over_names(stage):
    return lambda spark, sf: shown(t.load(spark, sf, "part"), "p_partkey", stage(F.col("p_name")))


RAW_WORDS = r"regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+')"


def doc_sql(tokens: str) -> str:
    return shown_sql("documents", "doc_id", tokens)


def word_sql(step: str) -> str:
    """SQL for a token filter; ``step`` works on the list ``w``."""
    return (
        f"WITH w AS (SELECT doc_id, {RAW_WORDS} AS w FROM documents), x AS (SELECT doc_id, {step} AS t FROM w)"
        " SELECT doc_id, array_to_string(t, '|') AS tokens, CAST(len(t) AS BIGINT) AS n FROM x"
    )


# --- tokenizers -----------------------------------------------------------

query("tok_standard", doc_sql(RAW_WORDS))(over_documents(a.standard))
query("tok_letter", doc_sql(r"regexp_extract_all(text, '\p{L}+')"))(over_documents(a.letter))
query("tok_lowercase", doc_sql(r"regexp_extract_all(lower(text), '\p{L}+')"))(over_documents(a.lowercase_letter))
query("tok_whitespace", doc_sql(r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"))(
    over_documents(a.whitespace)
)
query("tok_keyword", doc_sql("[text]"))(over_documents(a.keyword))
query("tok_pattern", doc_sql(r"list_filter(regexp_split_to_array(text, '\W+'), lambda x: x <> '')"))(
    over_documents(a.pattern())
)
query(
    "tok_ngram",
    shown_sql(
        "part",
        "p_partkey",
        "flatten([[p_name[i:i + n - 1] for i in range(1, length(p_name) - n + 2)] for n in range(2, 4)])",
    ),
)(over_names(a.ngram(2, 3)))
query(
    "tok_edge_ngram",
    shown_sql("part", "p_partkey", "[p_name[1:n] for n in range(1, least(6, length(p_name)) + 1)]"),
)(over_names(a.edge_ngram(1, 6)))
query(
    "tok_path",
    "WITH p AS (SELECT page_id, list_filter(string_split(regexp_replace(url, '^https?:/', ''), '/'), lambda x: x <> '') AS p"
    " FROM pages), x AS (SELECT page_id, ['/' || array_to_string(p[1:i], '/') for i in range(1, len(p) + 1)] AS t FROM p)"
    " SELECT page_id, array_to_string(t, '|') AS tokens, CAST(len(t) AS BIGINT) AS n FROM x",
)(over_pages(lambda c: a.path_hierarchy(F.regexp_replace(c, "^https?:/", "")), "url"))
query(
    "tok_url_email",
    doc_sql(
        r"""regexp_extract_all(text, 'https?://[^\s<>"'']+|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|[\p{L}\p{M}\p{N}_]+')"""
    ),
)(over_documents(a.url_email))
query("tokenizer_options", doc_sql(r"regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]{1,5}')"))(
    over_documents(a.tokenizer("standard", max_token_length=5))
)
query(
    "tokenizer_options_grams",
    shown_sql(
        "customer",
        "c_custkey",
        "flatten([[w[1:n] for n in range(2, least(4, length(w)) + 1)] for w in regexp_extract_all(c_name, '[\\p{L}\\p{N}]+')])",
    ),
)(
    lambda spark, sf: shown(
        t.load(spark, sf, "customer"),
        "c_custkey",
        a.tokenizer("edge_ngram", min_gram=2, max_gram=4, token_chars=("letter", "digit"))(F.col("c_name")),
    )
)


@query("token_count", f"SELECT doc_id, CAST(len({WORDS}) AS BIGINT) AS n FROM documents")
def token_count(spark, sf):
    tokens = a.STANDARD.tokens(F.col("text"))
    return t.load(spark, sf, "documents").select("doc_id", F.size(tokens).cast("bigint").alias("n"))


# --- char filters ---------------------------------------------------------


def html_sql(column: str = "html") -> str:
    steps = [
        (r"<script\b[^>]*>.*?</script\s*>", "gis"),
        (r"<style\b[^>]*>.*?</style\s*>", "gis"),
        (r"<!--.*?-->", "gs"),
        (r"<[^>]+>", "g"),
    ]
    sql = column
    for pattern, flags in steps:
        sql = f"regexp_replace({sql}, '{pattern}', ' ', '{flags}')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&amp;", "&")):
        sql = f"replace({sql}, '{entity}', '{char}')"
    return rf"trim(regexp_replace({sql}, '[ \t\r\n]+', ' ', 'g'))"


@query("char_html_strip", f"SELECT page_id, {html_sql()} AS text FROM pages")
def char_html_strip(spark, sf):
    return t.load(spark, sf, "pages").select("page_id", a.html_strip(F.col("html")).alias("text"))


@query("char_mapping", "SELECT doc_id, replace(replace(replace(text, '&', ' and '), '%', ' percent '), '***', '') AS text FROM documents")
def char_mapping(spark, sf):
    rules = a.char_mapping({"&": " and ", "%": " percent ", "***": ""})
    return t.load(spark, sf, "documents").select("doc_id", rules(F.col("text")).alias("text"))


@query("char_pattern_replace", r"SELECT doc_id, regexp_replace(text, '([0-9]+)\.([0-9]+)', '\1_\2', 'g') AS text FROM documents")
def char_pattern_replace(spark, sf):
    rule = a.pattern_replace(r"([0-9]+)\.([0-9]+)", "$1_$2")
    return t.load(spark, sf, "documents").select("doc_id", rule(F.col("text")).alias("text"))


# --- token filters --------------------------------------------------------

STOPS = ", ".join(f"'{w}'" for w in a.ENGLISH_STOP)

query("tf_case", word_sql("[lower(x) for x in w] || [upper(replace(x, 'ß', 'SS')) for x in w]"))(
    over_words(lambda w: F.concat(a.lowercase(w), a.uppercase(w)))
)
query("tf_stop", word_sql(f"list_filter(w, lambda x: x NOT IN ({STOPS}))"))(over_words(a.stop()))
query("tf_unique", word_sql("list_filter(w, lambda x, i: list_position(w, x) = i)"))(over_words(a.unique))
query("tf_truncate", word_sql("[x[1:4] for x in w]"))(over_words(a.truncate(4)))
query("tf_limit", word_sql("w[1:20]"))(over_words(a.limit(20)))
query("tf_reverse", word_sql("[reverse(x) for x in w]"))(over_words(a.reverse))
query("tf_length", word_sql("list_filter(w, lambda x: length(x) BETWEEN 4 AND 8)"))(over_words(a.length(4, 8)))
query(
    "tf_ngram",
    word_sql("flatten([flatten([[x[i:i + n - 1] for i in range(1, length(x) - n + 2)] for n in range(2, 4)]) for x in w])"),
)(over_words(a.token_ngram(2, 3)))
query("tf_edge_ngram", word_sql("flatten([[x[1:n] for n in range(2, least(4, length(x)) + 1)] for x in w])"))(
    over_words(a.token_edge_ngram(2, 4))
)
query("tf_trim", doc_sql("[trim(x) for x in string_split(text, ',')]"))(
    over_documents(lambda c: a.trim(F.split(c, ",")))
)
query(
    "tf_asciifolding",
    word_sql("[replace(replace(strip_accents(x), 'ß', 'ss'), 'œ', 'oe') for x in w]"),
)(over_words(a.asciifolding))
query(
    "tf_word_delimiter",
    word_sql(r"flatten([regexp_extract_all(x, '\p{Lu}*[\p{Ll}\p{M}]+|\p{Lu}+|\p{Lo}+|\p{N}+') for x in w])"),
)(over_words(a.word_delimiter))
query("tf_porter_stem")(over_documents(a.analyzer("lowercase", ("porter_stem",)).tokens))
query(
    "tf_synonym",
    word_sql(
        "flatten([CASE WHEN x = 'the' THEN ['the', 'this'] WHEN x = 'and' THEN ['and', 'plus', 'also'] ELSE [x] END for x in w])"
    ),
)(over_words(a.synonym({"the": ["this"], "and": ["plus", "also"]})))


def lemma_rules(spark, sf):
    """A rules table with one form per distinct part name word and mktsegment."""
    words = t.load(spark, sf, "documents").select(F.explode(a.lowercase_letter(F.col("text"))).alias("word"))
    return words.where(F.length("word") > 6).distinct().withColumn("form", F.substring("word", 1, 6))


@query(
    "tf_dictionary",
    r"WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents),"
    " x AS (SELECT doc_id, [CASE WHEN length(x) > 6 THEN x[1:6] ELSE x END for x in w] AS t FROM w)"
    " SELECT doc_id, array_to_string(t, '|') AS tokens, CAST(len(t) AS BIGINT) AS n FROM x",
)
def tf_dictionary(spark, sf):
    docs = t.load(spark, sf, "documents").select("doc_id", a.lowercase_letter(F.col("text")).alias("words"))
    found = a.expand_tokens(docs, "doc_id", "words", lemma_rules(spark, sf), keep=False, out="forms")
    return shown(found, "doc_id", F.col("forms"))


# Stems by the paper's rules of the words of these columns that change.
STEMS = {
    "automobile": "automobil", "building": "build", "economy": "economi", "furniture": "furnitur", "large": "larg",
    "machinery": "machineri",
}


@query(
    "tf_stem_vocabulary",
    "WITH w AS (SELECT 'p' || p_partkey AS _id, regexp_extract_all(lower(p_type || ' ' || p_name), '[a-z]+') AS w FROM part"
    " UNION ALL SELECT 'c' || c_custkey, regexp_extract_all(lower(c_mktsegment), '[a-z]+') FROM customer),"
    f" x AS (SELECT _id, [CASE x {' '.join(f"WHEN '{w}' THEN '{s}'" for w, s in STEMS.items())} ELSE x END for x in w] AS t FROM w)"
    " SELECT _id, array_to_string(t, '|') AS tokens, CAST(len(t) AS BIGINT) AS n FROM x",
)
def tf_stem_vocabulary(spark, sf):
    """The distinct words are stemmed once and looked up in every row."""
    parts = t.load(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("_id"), F.concat_ws(" ", "p_type", "p_name").alias("text"))
    people = t.load(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("_id"), F.col("c_mktsegment").alias("text"))
    rows = parts.unionByName(people).select("_id", a.lowercase_letter(F.col("text")).alias("words"))
    return shown(a.stem_tokens(rows, "words", "stems"), "_id", F.col("stems"))


PHRASES = "('of the', 'ofthe'), ('the', 'article'), ('of the end', 'last part'), ('in', 'inside')"


@query(
    "tf_phrases",
    r"WITH w AS (SELECT conv_id, turn, ' ' || array_to_string(regexp_extract_all(lower(text), '\p{L}+'), '  ') || ' ' AS t FROM conversations),"
    " x AS (SELECT conv_id, turn, replace(replace(replace(replace(t, ' of  the  end ', ' last  part '), ' of  the ', ' ofthe '),"
    " ' the ', ' article '), ' in ', ' inside ') AS t FROM w),"
    " y AS (SELECT conv_id, turn, list_filter(string_split(t, ' '), lambda x: x <> '') AS t FROM x)"
    " SELECT conv_id || '-' || turn AS _id, array_to_string(t, '|') AS tokens, CAST(len(t) AS BIGINT) AS n FROM y",
)
def tf_phrases(spark, sf):
    """Rules of one and of several words; the longest one at a place wins."""
    turns = t.conversations(spark, sf).df.select("_id", a.lowercase_letter(F.col("text")).alias("words"))
    rules = spark.sql(f"SELECT * FROM VALUES {PHRASES} AS t(phrase, form)")
    found = a.expand_phrases(turns, "words", rules, keep=False, out="forms")
    return shown(found, "_id", F.col("forms"))


# --- chains ---------------------------------------------------------------

query("analyze_custom", doc_sql(rf"list_filter([lower(x) for x in {RAW_WORDS}], lambda x: x NOT IN ({STOPS}))"))(
    over_documents(a.analyzer("standard", ("lowercase", "stop")).tokens)
)
query(
    "analyze_full",
    shown_sql(
        "pages",
        "page_id",
        rf"list_filter([lower(x) for x in regexp_extract_all(replace({html_sql()}, '&', ' and '), '[\p{{L}}\p{{M}}\p{{N}}_]+')],"
        f" lambda x: x NOT IN ({STOPS}) AND length(x) >= 3)",
    ),
)(
    over_pages(
        a.analyzer(
            "standard",
            ("lowercase", "stop", a.length(3)),
            ("html_strip", a.char_mapping({"&": " and "})),
        ).tokens
    )
)
FRENCH = ", ".join(f"'{w}'" for w in a.STOP_WORDS["french"])
query("analyze_language", doc_sql(f"list_filter({WORDS}, lambda x: x NOT IN ({FRENCH}))"))(
    over_documents(a.named_analyzer("french").tokens)
)
query("analyze_named", doc_sql(r"regexp_extract_all(lower(text), '\p{L}+') || list_filter(regexp_split_to_array(lower(text), '\W+'), lambda x: x <> '')"))(
    over_documents(lambda c: F.concat(a.SIMPLE.tokens(c), a.PATTERN.tokens(c)))
)
