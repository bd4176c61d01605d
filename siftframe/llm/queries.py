"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftframe.llm import bpe, chat, hmm, minhash, mixing, negatives, quality, substrings, suffixes, toxicity, urls, vectors, whitening
from siftframe.llm.common import remainder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.digests(table(spark, sf, "documents"), vocabulary)


@query("op4_vector_near_copies")
def op4_vector_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_copies(table(spark, sf, "embeddings").select("vec_id", "embedding"))


CONTROL = "<|im_end|><|im_start|>assistant ok"


@query(
    "op5_chat_windows",
    rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')),
sized AS (
  SELECT *, length('<|im_start|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') || chr(10)
    || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10)) AS size FROM turns),
placed AS (
  SELECT *, CAST(ceil(size / 4) AS BIGINT) AS tokens, row_number() OVER w AS nth,
    CAST(sum(ceil(size / 4)) OVER w AS BIGINT) AS upto
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
windowed AS (
  SELECT *, upto - tokens AS before, nth = 1 AND role = 'system' AS system,
    2 * ((upto - tokens) // 1536) + CASE WHEN (upto - 1) // 1536 > (upto - tokens) // 1536 THEN 1 ELSE 0 END AS win FROM placed),
ended AS (SELECT *, max(upto) OVER (PARTITION BY conv_id, win) AS ends, max(upto) OVER (PARTITION BY conv_id) AS total FROM windowed),
repeated AS (
  SELECT conv_id, sum(size) AS size FROM ended WHERE NOT system AND ends < total AND ends - before <= 256 GROUP BY conv_id),
own AS (SELECT conv_id, win, size FROM ended WHERE system AND tokens <= 256),
opened AS (
  SELECT own.conv_id, own.size * count(DISTINCT ended.win) AS size
  FROM own JOIN ended ON ended.conv_id = own.conv_id AND ended.win > own.win GROUP BY own.conv_id, own.size)
SELECT e.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(e.size) + coalesce(any_value(r.size), 0) + coalesce(any_value(o.size), 0) AS BIGINT) AS formatted_chars
FROM ended e LEFT JOIN repeated r ON e.conv_id = r.conv_id LEFT JOIN opened o ON e.conv_id = o.conv_id
GROUP BY e.conv_id
""",
)
def op5_chat_windows(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    two = f"(-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')"
    added = spark.sql(f"SELECT * FROM VALUES {two} AS t(conv_id, turn, role, text)")
    return chat.digests(chat.windows(turns.unionByName(added)))


@query(
    "op6_quality_ledger",
    r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM d),
t AS (SELECT k, i, count(*) OVER (PARTITION BY k, words[i], words[i + 1], words[i + 2]) AS n FROM w),
r AS (
  SELECT k, count(DISTINCT i + o) AS n_repeat_words FROM t, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY k),
m AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: regexp_matches(x, '^\pL+$'))) AS n_alpha_words,
    len(list_filter(words, lambda x: length(x) > 1 AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words
  FROM d LEFT JOIN r USING (k)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words <= 1000000 AND word_chars / n_words BETWEEN 2 AND 20 AND 10 * n_symbols <= n_words
    AND NOT (n_lines > 0 AND n_dup_lines / n_lines > 0.3) AND 100 * n_alpha_words >= 50 * n_words
    AND 100 * n_upper_words <= 50 * n_words AS kept
FROM b
""",
)
def op6_quality_ledger(spark: SparkSession, sf: str) -> DataFrame:
    book = quality.ledger(table(spark, sf, "documents").select("doc_id", "text"))
    return book.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality.passes("base")).alias("base_failed"),
        quality.passes(quality.CURRENT).alias("kept"),
    )


URL_RULES = [
    urls.Rule("allow", "com"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]

# The labelled urls: general words of hosts that a filter of this kind is to
# block or allow, none of them a host of the tables here, and among the allowed
# ones names that say nothing, put together from syllables.
BLOCKED_NAMES = (
    "spam-mail bulk-spam pills-online diet-pills casino-games live-casino adult-chat adult-dates free-spins bets-today"
    " sure-bets pop-ads ads-click track-clicks xxx-cams malware-dl warez-zone loan-now poker-win porn-tube link-farm"
    " pill-shop win-cash click-bait bet-bonus sex-chat viagra-rx phish-login torrent-hub crack-keys cheap-meds cheap-watches"
).split()
SYLLABLES = "ba ren mo lin tar ves do kin sal per hu nor".split()
ALLOWED_NAMES = (
    "city-news docs-hub library museum science-daily recipes travel-notes garden history health-info sports weather"
    " music-school code-lab bakery theatre poetry bicycle-club research maps lessons archive kitchen letters"
).split() + [a + b for a in SYLLABLES for b in SYLLABLES if a != b]
ALLOWED_PATHS = "/en/12 /fr/825.html /de/archive/7 /es/index /".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = []
    for names, blocked in ((BLOCKED_NAMES, 1), (ALLOWED_NAMES, 0)):
        for i, name in enumerate(names):
            for j, sub in enumerate(("", "www.", "m.", "blog.")):
                top = ("com", "net", "org")[(i + j) % 3]
                path = ALLOWED_PATHS[(i + 2 * j) % len(ALLOWED_PATHS)]
                rows.append(f"('https://{sub}{name}.example.{top}{path}', {blocked})")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(url, blocked)")


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    model = urls.fit(labelled_urls(spark))
    judged = urls.judge(table(spark, sf, "pages").select("page_id", "url"), URL_RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))


@query("op9_toxic_passages")
def op9_toxic_passages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query(
    "op10_repeated_passages",
    r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (
  SELECT k, doc_id, i, md5(array_to_string(words[i:i + 12], ' ')) AS win
  FROM (SELECT k, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)),
f AS (SELECT win, min(doc_id) AS least FROM w GROUP BY win),
r AS (
  SELECT k, list(DISTINCT i + o) AS gone
  FROM (SELECT k, i FROM w JOIN f USING (win) WHERE doc_id > least), (SELECT unnest(range(13)) AS o) GROUP BY k),
u AS (SELECT k, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
g AS (SELECT k, unnest(gone) AS i FROM r),
s AS (SELECT u.k, string_agg(word, ' ' ORDER BY u.i) AS kept, count(*) AS n FROM u ANTI JOIN g ON u.k = g.k AND u.i = g.i GROUP BY u.k)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (k)
""",
)
def op10_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    docs = substrings.without_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op7_minhash_near_copies")
def op7_minhash_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return minhash.near_copies(docs).select("doc_id", "class_id", "kept")


@query("op2_hidden_markov_score")
def op2_hidden_markov_score(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return hmm.score(docs.withColumn("held_out", remainder(F.col("doc_id"), 7) == 2), "held_out")


# Shares of tokens by language (among these languages; all others keep their own
# share of the table) and topic; those of sources follow the table.
LANGUAGES = mixing.Target("lang", {"en": 0.58, "de": 0.16, "fr": 0.14, "es": 0.12})
TOPIC_SHARES = mixing.Target("topic", {f"topic{i}": 1 / mixing.TOPICS for i in range(mixing.TOPICS)})
MIXED_SHARE = 0.5


def mix_documents(docs: DataFrame, tokens: str, topic: str) -> DataFrame:
    """``docs`` (with source and lang) drawn to the shares above, with columns
    ``tokens``, ``topic`` and probability."""
    counted = mixing.with_topics(docs, tokens=tokens, topic=topic)
    topics = mixing.Target(topic, TOPIC_SHARES.shares)
    languages = mixing.beside_others(counted, LANGUAGES, tokens)
    return mixing.mixed(counted, [languages, topics], tokens, MIXED_SHARE, every=mixing.Smoothed("source"))


@query("op3_raked_mixture")
def op3_raked_mixture(spark: SparkSession, sf: str) -> DataFrame:
    drawn = mix_documents(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "n_tokens", "topic")
    return drawn.select("doc_id", "source", "lang", "topic", "n_tokens", "probability")


@query(
    "op11_hard_negatives",
    r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM r a JOIN r c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM s WHERE same)
  WHERE nth <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.nth ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 50 * p.score AND 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
)
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors_ = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors_.withColumn("label", moved), F.col("vec_id") % 50 == 0, scale=256.0)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened(table(spark, sf, "embeddings").select("vec_id", "embedding"))


@query(
    "op13_repeated_strings",
    r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT k, doc_id, i, md5(h[2 * i + 1:2 * i + 200]) AS win
  FROM (SELECT k, doc_id, h, unnest(range(0, CAST(len(h) // 2 AS BIGINT) - 99)) AS i FROM d)),
r AS (SELECT k, i FROM (SELECT k, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
n AS (SELECT k, i, CASE WHEN i > lag(i) OVER (PARTITION BY k ORDER BY i) + 100 THEN 1 ELSE 0 END AS new FROM r),
s AS (
  SELECT k, min(i) AS a, max(i) + 100 AS b FROM (SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS g FROM n) GROUP BY k, g),
p AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY k ORDER BY a), 0) AS before FROM s),
c AS (
  SELECT k, string_agg(h[2 * before + 1:2 * a], '' ORDER BY a) || any_value(h)[2 * max(b) + 1:] AS kept, count(*) AS n_spans,
    sum(b - a) AS n_removed
  FROM p JOIN d USING (k) GROUP BY k)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN c USING (k)
""",
)
def op13_repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    docs = suffixes.without_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
