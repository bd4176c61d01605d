"""Conditions, boolean logic, relevance, sorting and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from catalog.tables import DOCS, PRODUCTS, TURNS
from siftframe.functions.geo import EARTH_RADIUS_M
from siftframe import Collection
from siftframe.functions.cells import write_in_cell_order
from siftframe.operators import paging, scoring, search as s
from siftframe.operators.index import TextIndex
from siftframe.operators.intervals import join_points
from siftframe.operators.sorting import SortKey, sort_keys
from siftframe.plans import conditions as q
from siftframe.session import scratch_path, stage
from siftframe.sources.mapping import Field, with_tokens


def hits(c, condition, *columns):
    """All rows of a condition, with a few columns."""
    return s.search(c, condition, sort=[], size=None, source=list(columns) or ["_id"])


def product_sql(test: str, columns: str = "_id") -> str:
    return f"WITH {PRODUCTS} SELECT {columns} FROM products WHERE {test}"


def document_sql(test: str, columns: str = "_id") -> str:
    return f"WITH {DOCS} SELECT {columns} FROM docs WHERE {test}"


# --- leaves ---------------------------------------------------------------


@query("match", document_sql("list_has_any(tokens, ['the', 'des'])", "_id, lang"))
def match(spark, sf):
    return hits(t.documents(spark, sf), q.match("text", "The des"), "lang")


@query(
    "match_phrase",
    f"WITH {TURNS} SELECT _id, role FROM turns WHERE contains(' ' || array_to_string(tokens, ' ') || ' ', ' of the ')",
)
def match_phrase(spark, sf):
    return hits(t.conversations(spark, sf), q.match_phrase("text", "of the"), "role")


@query("multi_match", product_sql("list_has_any(string_split(lower(title), ' '), ['small', 'promo']) OR category = 'small promo' OR brand = 'small promo'"))
def multi_match(spark, sf):
    return hits(t.products(spark, sf), q.multi_match("small promo", "title", "category", "brand"))


@query(
    "keyword_query",
    product_sql(
        "(list_contains(string_split(lower(title), ' '), 'small') OR category = 'small'"
        " OR list_contains(string_split(lower(title), ' '), 'red') OR category = 'red')"
        " AND (list_contains(string_split(lower(title), ' '), 'promo') OR category = 'PROMO')"
        " AND NOT (list_contains(string_split(lower(title), ' '), 'bolt') OR category = 'bolt')"
    ),
)
def keyword_query(spark, sf):
    tree = q.every(q.some("small", "red"), "PROMO", q.without("bolt"))
    return hits(t.products(spark, sf), q.keyword_query(tree, "title", "category"))


@query("term", product_sql("category = 'PROMO'", "_id, brand"))
def term(spark, sf):
    return hits(t.products(spark, sf), q.term("category", "PROMO"), "brand")


@query("term_list_field", product_sql("list_contains(tags, 'red')", "_id, title"))
def term_list_field(spark, sf):
    return hits(t.products(spark, sf), q.term("tags", "red"), "title")


@query("terms", product_sql("brand IN ('Brand#1', 'Brand#2', 'Brand#3')", "_id, brand"))
def terms(spark, sf):
    return hits(t.products(spark, sf), q.terms("brand", "Brand#1", "Brand#2", "Brand#3"), "brand")


@query(
    "terms_long_list",
    f"WITH {PRODUCTS} SELECT _id, title FROM products WHERE list_has_any(tags, ['large', 'steel', 'red'])",
)
def terms_long_list(spark, sf):
    """More values than are tested inline, on a list field."""
    values = ["large", "steel", "red", *(f"no such tag {i}" for i in range(1500))]
    return s.search(t.products(spark, sf), q.terms("tags", *values), size=None, source=["title"]).select("_id", "title")


@query(
    "terms_table",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_custkey FROM orders"
    " WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def terms_table(spark, sf):
    debtors = t.load(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")
    return hits(t.orders(spark, sf), q.all_of(q.terms("o_custkey", debtors)), "o_custkey")


@query(
    "should_ids_table",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_custkey FROM orders WHERE o_totalprice > 300000"
    " OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def should_ids_table(spark, sf):
    debtors = t.load(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")
    condition = q.any_of(q.terms("o_custkey", debtors), q.between("o_totalprice", gt=300_000))
    return hits(t.orders(spark, sf), condition, "o_custkey")


@query("range", product_sql("price >= 950.5 AND price <= 1050", "_id, price"))
def range_(spark, sf):
    return hits(t.products(spark, sf), q.between("price", 950.5, 1050), "price")


@query(
    "range_date",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderdate FROM orders"
    " WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'",
)
def range_date(spark, sf):
    import datetime as dt

    year = q.between("o_orderdate", dt.datetime(1996, 1, 1), lt=dt.datetime(1997, 1, 1))
    return hits(t.orders(spark, sf), year, "o_orderdate")


@query(
    "range_date_expression",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderdate FROM orders"
    " WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate <= TIMESTAMP '1998-03-15 10:00:00'",
)
def range_date_expression(spark, sf):
    import datetime as dt

    recent = q.between("o_orderdate", "now-1M/M", "now", now=dt.datetime(1998, 3, 15, 10))
    return hits(t.orders(spark, sf), recent, "o_orderdate")


@query(
    "search_as_you_type",
    f"WITH {TURNS} SELECT _id, role FROM turns WHERE len(list_filter(tokens, lambda x: starts_with(x, 'enth'))) > 0",
)
def search_as_you_type(spark, sf):
    from siftframe import Collection, Field, Mapping

    c = t.conversations(spark, sf)
    typed = Collection(c.df, Mapping({"text": Field("search_as_you_type"), "role": Field("keyword")}))
    return hits(typed, q.match("text", "Enth"), "role")


@query("exists", product_sql("rating IS NOT NULL", "_id, rating"))
def exists(spark, sf):
    return hits(t.products(spark, sf), q.exists("rating"), "rating")


@query("ids", "SELECT CAST(o_orderkey AS VARCHAR) AS _id FROM orders WHERE o_orderkey IN (SELECT c_custkey * 3 FROM customer)")
def ids(spark, sf):
    wanted = t.load(spark, sf, "customer").select((F.col("c_custkey") * 3).cast("string"))
    return hits(t.orders(spark, sf), q.all_of(q.ids(wanted)))


@query("wildcard", product_sql("category LIKE '_R%MO'", "_id, category"))
def wildcard(spark, sf):
    return hits(t.products(spark, sf), q.wildcard("category", "?R*MO"), "category")


@query("prefix", product_sql("starts_with(brand, 'Brand#1')", "_id, brand"))
def prefix(spark, sf):
    return hits(t.products(spark, sf), q.prefix("brand", "Brand#1"), "brand")


@query("regexp", product_sql("regexp_full_match(brand, 'Brand#[12][0-3]')", "_id, brand"))
def regexp(spark, sf):
    return hits(t.products(spark, sf), q.regexp("brand", "Brand#[12][0-3]"), "brand")


@query("fuzzy", product_sql("len(list_filter(tags, lambda x: levenshtein(x, 'boot') <= 1)) > 0", "_id, title"))
def fuzzy(spark, sf):
    return hits(t.products(spark, sf), q.fuzzy("tags", "boot"), "title")


HAVERSINE = (
    f"2 * {EARTH_RADIUS_M} * asin(least(1.0, sqrt(pow(sin(radians(lat - ({{lat}})) / 2), 2)"
    " + cos(radians(lat)) * cos(radians({lat})) * pow(sin(radians(lon - ({lon})) / 2), 2))))"
)


@query("geo_distance", product_sql(HAVERSINE.format(lat=48.85, lon=2.35) + " <= 2000000", "_id, lat, lon"))
def geo_distance(spark, sf):
    found = hits(t.products(spark, sf), q.geo_distance("location", 48.85, 2.35, "2000km"), "location")
    return found.select("_id", "location.lat", "location.lon")


@query("geo_bbox", product_sql("lat BETWEEN -20 AND 40 AND (lon >= 150 OR lon <= -120)", "_id, lat, lon"))
def geo_bbox(spark, sf):
    found = hits(t.products(spark, sf), q.geo_bounding_box("location", 40, 150, -20, -120), "location")
    return found.select("_id", "location.lat", "location.lon")


@query("geo_distance_cells", product_sql(HAVERSINE.format(lat=-70.0, lon=170.0) + " <= 2500000", "_id, lat, lon"))
def geo_distance_cells(spark, sf):
    """A circle over the date line, on a table written in cell order."""
    return _celled(spark, sf, q.geo_distance("location", -70.0, 170.0, "2500km"))


@query("geo_bbox_cells", product_sql("lat BETWEEN -20 AND 40 AND (lon >= 150 OR lon <= -120)", "_id, lat, lon"))
def geo_bbox_cells(spark, sf):
    return _celled(spark, sf, q.geo_bounding_box("location", 40, 150, -20, -120))


def _celled(spark, sf, condition):
    c, path = t.products(spark, sf), scratch_path(spark, "cells")
    write_in_cell_order(c.df, "location", path)
    found = hits(c.with_df(spark.read.parquet(path)), condition, "location")
    return found.select("_id", "location.lat", "location.lon")


def priced(spark, sf) -> Collection:
    """Orders with the range that a price may move in; some bounds are open."""
    c, price, key = t.orders(spark, sf), F.col("o_totalprice"), F.col("o_orderkey")
    low, high = F.when(key % 5 > 0, price * 0.9), F.when(key % 7 > 0, price * 1.1)
    df = c.df.withColumn("band", F.when(key % 11 > 0, F.struct(low.alias("gte"), high.alias("lte"))))
    return Collection(df, c.mapping.extended({"band": Field("double_range")}))


BANDS = (
    "WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderkey % 11 > 0 AS has,"
    " CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice * 0.9 END AS lo,"
    " CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice * 1.1 END AS hi FROM orders) SELECT _id FROM b WHERE has AND "
)


def _related(relation: str, test: str):
    @query(f"range_{relation}", BANDS + test)
    def rows(spark, sf):
        return hits(priced(spark, sf), q.range_relation("band", 100000.0, 130000.0, relation))


_related("intersects", "(lo IS NULL OR lo <= 130000) AND (hi IS NULL OR hi >= 100000)")
_related("within", "lo >= 100000 AND hi <= 130000")
_related("contains", "(lo IS NULL OR lo <= 100000) AND (hi IS NULL OR hi >= 130000)")


@query(
    "range_join",
    "WITH i AS (SELECT p_partkey, p_retailprice - p_size * CASE WHEN p_partkey % 50 = 0 THEN 500 ELSE 0.1 END AS lo,"
    " CASE WHEN p_partkey % 200 > 0 THEN p_retailprice + p_size * CASE WHEN p_partkey % 50 = 0 THEN 500 ELSE 0.1 END END AS hi"
    " FROM part) SELECT p_partkey, count(*) AS n, min(s_acctbal) AS lowest, max(s_suppkey) AS last"
    " FROM i JOIN supplier ON s_acctbal >= lo AND (hi IS NULL OR s_acctbal <= hi) GROUP BY p_partkey",
)
def range_join(spark, sf):
    """Balances in the price ranges of parts, most of them narrow, some wide or open."""
    wide = F.when(F.col("p_partkey") % 50 == 0, F.lit(500.0)).otherwise(F.lit(0.1)) * F.col("p_size")
    high = F.when(F.col("p_partkey") % 200 > 0, F.col("p_retailprice") + wide)
    parts = t.load(spark, sf, "part").select(
        "p_partkey", F.struct((F.col("p_retailprice") - wide).alias("gte"), high.alias("lte")).alias("band")
    )
    wanted = {"n": ("count", "*"), "lowest": ("min", "s_acctbal"), "last": ("max", "s_suppkey")}
    met = join_points(t.load(spark, sf, "supplier"), parts, "s_acctbal", "band", totals=wanted)
    return met.groupBy("p_partkey").agg(F.sum("n").alias("n"), F.min("lowest").alias("lowest"), F.max("last").alias("last"))


@query(
    "nested",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id FROM orders WHERE o_orderkey IN"
    " (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45 AND l_extendedprice < 60000)",
)
def nested(spark, sf):
    one_item = q.all_of(q.between("items.quantity", gte=45), q.between("items.price", lt=60000))
    return hits(t.orders_with_items(spark, sf), q.nested("items", one_item))


@query("match_all", f"WITH {PRODUCTS} SELECT _id, CAST(1.0 AS DOUBLE) AS _score FROM products")
def match_all(spark, sf):
    c = t.products(spark, sf)
    return s.search(c, q.match_all(), size=None, source=["_id"])


# --- boolean logic --------------------------------------------------------

TITLE_HAS = "list_contains(string_split(lower(title), ' '), '{}')"


@query(
    "bool_query",
    f"WITH {PRODUCTS} SELECT _id, price, brand FROM products WHERE category = 'PROMO' AND published"
    " AND price BETWEEN 900 AND 1800 AND (brand = 'Brand#1' OR brand = 'Brand#2' OR brand = 'Brand#12')"
    f" AND NOT {TITLE_HAS.format('bolt')} ORDER BY price DESC, _id LIMIT 10",
)
def bool_query(spark, sf):
    return flagship(t.products(spark, sf))


def flagship(c):
    condition = q.all_of(
        q.term("category", "PROMO"),
        q.term("published", True),
        q.between("price", 900, 1800),
        q.any_of(q.term("brand", "Brand#1"), q.term("brand", "Brand#2"), q.term("brand", "Brand#12")),
        ~q.match("title", "bolt"),
    )
    return s.search(c, condition, sort=[("price", "desc")], size=10, source=["price", "brand"])


@query("should", product_sql("(category = 'PROMO' AND price < 1200) OR views >= 45"))
def should(spark, sf):
    cheap = q.all_of(q.term("category", "PROMO"), q.between("price", lt=1200))
    return hits(t.products(spark, sf), q.any_of(cheap, q.between("views", gte=45)))


@query("match_should", product_sql(f"{TITLE_HAS.format('red')} OR {TITLE_HAS.format('ring')}"))
def match_should(spark, sf):
    return hits(t.products(spark, sf), q.any_of(q.match("title", "red"), q.match("title", "ring")))


@query("term_should", product_sql("brand = 'Brand#5' OR category = 'SMALL'"))
def term_should(spark, sf):
    return hits(t.products(spark, sf), q.any_of(q.term("brand", "Brand#5"), q.term("category", "SMALL")))


@query("range_should", product_sql("price BETWEEN 900 AND 950 OR rating > 4.5"))
def range_should(spark, sf):
    return hits(t.products(spark, sf), q.any_of(q.between("price", 900, 950), q.between("rating", gt=4.5)))


@query("must_not", product_sql("category <> 'PROMO'"))
def must_not(spark, sf):
    return hits(t.products(spark, sf), q.none_of(q.term("category", "PROMO")))


@query("match_must_not", document_sql("NOT list_has_any(tokens, ['the', 'and'])"))
def match_must_not(spark, sf):
    return hits(t.documents(spark, sf), ~q.match("text", "the and"))


@query("range_must_not", product_sql("rating IS NULL OR NOT (rating <= 3.0)"))
def range_must_not(spark, sf):
    return hits(t.products(spark, sf), q.none_of(q.between("rating", lte=3.0)))


@query(
    "min_should_match",
    product_sql(
        f"CAST({TITLE_HAS.format('red')} AS INT) + CAST(category = 'PROMO' AS INT) + CAST(price < 1200 AS INT)"
        " + CAST(coalesce(rating > 2, false) AS INT) >= 3"
    ),
)
def min_should_match(spark, sf):
    four = (q.match("title", "red"), q.term("category", "PROMO"), q.between("price", lt=1200), q.between("rating", gt=2.0))
    return hits(t.products(spark, sf), q.any_of(*four, min_match="75%"))


@query("count", f"WITH {DOCS} SELECT count(*) AS count FROM docs WHERE list_contains(tokens, 'the') AND lang = 'en'")
def count(spark, sf):
    return s.count(t.documents(spark, sf), q.match("text", "the") & q.term("lang", "en"))


# --- projections ----------------------------------------------------------


@query("source_filter", product_sql("category = 'LARGE'", "_id, title, lat"))
def source_filter(spark, sf):
    c = t.products(spark, sf)
    found = s.search(c, q.term("category", "LARGE"), sort=[], size=None, source=["title", "location.lat"])
    return found.withColumnRenamed("location.lat", "lat")


@query(
    "highlight",
    rf"WITH {DOCS} SELECT _id, regexp_replace(text, '(?i)\b(and|the)\b', '<em>\1</em>', 'g') AS fragment FROM docs"
    " WHERE list_has_any(tokens, ['and', 'the']) AND lang = 'en' ORDER BY n_chars DESC, _id LIMIT 20",
)
def highlight(spark, sf):
    c = t.documents(spark, sf)
    condition = q.match("text", "and the") & q.term("lang", "en")
    found = s.search(c, condition, sort=[("n_chars", "desc")], size=20, source=["_id"], highlight=["text"])
    return found.select("_id", F.col("highlight")["text"][0].alias("fragment"))


# --- relevance ------------------------------------------------------------


def bm25_sql(words: list[str], select: str, test: str = "true") -> str:
    listed = ", ".join(f"('{w}')" for w in words)
    return f"""WITH {DOCS},
      asked AS (SELECT * FROM (VALUES {listed}) v(word)),
      totals AS (SELECT count(*) AS n, avg(len(tokens)) AS avgdl FROM docs),
      weights AS (SELECT word, (SELECT count(*) FROM docs WHERE list_contains(tokens, word)) AS df FROM asked),
      parts AS (
        SELECT _id, n_chars, lang, len(list_filter(tokens, lambda x: x = word)) AS tf, len(tokens) AS dl, avgdl,
          ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf
        FROM docs, weights, totals WHERE {test}),
      scored AS (
        SELECT _id, sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS score
        FROM parts WHERE tf > 0 GROUP BY _id)
      {select}"""


@query(
    "hits_total",
    bm25_sql(["reention", "under"], "SELECT count(*) AS total, round(max(score), 4) AS max_score FROM scored"),
)
def hits_total(spark, sf):
    totals = s.hits_total(t.documents(spark, sf), q.match("text", "reention under"))
    return totals.select("total", F.round("max_score", 4).alias("max_score"))


@query(
    "term_stats",
    f"WITH {DOCS}, words AS (SELECT unnest(list_distinct(tokens)) AS term FROM docs)"
    " SELECT term, count(*) AS df, (SELECT count(*) FROM docs) AS n,"
    " (SELECT round(avg(len(tokens)), 4) FROM docs) AS avgdl FROM words GROUP BY term",
)
def term_stats(spark, sf):
    return scoring.term_stats(t.documents(spark, sf), "text").withColumn("avgdl", F.round("avgdl", 4))


@query(
    "postings",
    f"WITH {DOCS}, words AS (SELECT _id, len(tokens) AS dl, unnest(tokens) AS term FROM docs)"
    " SELECT term, _id, count(*) AS tf, CAST(any_value(dl) AS BIGINT) AS dl FROM words GROUP BY term, _id",
)
def postings(spark, sf):
    return scoring.postings(t.documents(spark, sf), "text")


@query(
    "bm25",
    bm25_sql(
        ["the", "reention", "under"],
        "SELECT _id, round(score, 4) AS _score FROM scored ORDER BY score DESC, _id LIMIT 50",
        "lang = 'en'",
    ),
)
def bm25(spark, sf):
    c = t.documents(spark, sf)
    found = s.search(c, q.match("text", "the reention under") & q.term("lang", "en"), size=50, source=["_id"])
    return found.select("_id", F.round("_score", 4).alias("_score"))


@query(
    "bm25_stored",
    bm25_sql(
        ["the", "reention", "under"],
        "SELECT _id, round(score, 4) AS _score FROM scored ORDER BY score DESC, _id LIMIT 50",
    ),
)
def bm25_stored(spark, sf):
    """The same over a table that keeps its words, with stored word statistics."""
    c = t.documents(spark, sf)
    c = c.with_df(stage(with_tokens(c.df, c.mapping), "tokens"))
    words = stage(scoring.term_stats(c, "text"), "terms")
    condition = q.match("text", "the reention under")
    found = s.search(c, condition, size=50, source=["_id"], term_tables={"text": words})
    return found.select("_id", F.round("_score", 4).alias("_score"))


BATCH_SQL = rf"""WITH {DOCS},
      asked AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}_]+')) AS term FROM benchmark),
      counted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
      words AS (SELECT _id, len(tokens) AS dl, unnest(tokens) AS term FROM docs),
      post AS (SELECT term, _id, count(*) AS tf, any_value(dl) AS dl FROM words
               WHERE term IN (SELECT term FROM counted) GROUP BY term, _id),
      freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
      totals AS (SELECT count(*) AS n, avg(len(tokens)) AS avgdl FROM docs),
      scored AS (
        SELECT item_id, _id, round(sum(times * ln(1 + (n - df + 0.5) / (df + 0.5))
          * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
        FROM post JOIN freq USING (term) JOIN counted USING (term), totals GROUP BY item_id, _id),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, _id) AS rank FROM scored)
      SELECT item_id, _id, round(score, 4) AS _score, CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 10"""


@query("bm25_batch", BATCH_SQL)
def bm25_batch(spark, sf):
    found = scoring.search_batch(
        t.documents(spark, sf), "text", t.load(spark, sf, "benchmark"), k=10, query_id="item_id"
    )
    return found.withColumn("_score", F.round("_score", 4))


# --- stored index -----------------------------------------------------------


def indexed(spark, c, field: str) -> TextIndex:
    return TextIndex.build(c, field, scratch_path(spark, "index"))


@query(
    "phrase_indexed",
    f"WITH {TURNS} SELECT _id, role FROM turns WHERE contains(' ' || array_to_string(tokens, ' ') || ' ', ' of the ')",
)
def phrase_indexed(spark, sf):
    """A phrase found by the positions of its words."""
    c = t.conversations(spark, sf)
    return indexed(spark, c, "text").rows(c, q.match_phrase("text", "of the")).select("_id", "role")


def _pattern(name: str, test: str, condition):
    @query(name, document_sql(f"len(list_filter(tokens, lambda x: {test})) > 0", "_id, lang"))
    def rows(spark, sf):
        c = t.documents(spark, sf)
        return indexed(spark, c, "text").rows(c, condition).select("_id", "lang")


# Patterns run on the vocabulary of the texts, not on the texts.
_pattern("wildcard_indexed", "x LIKE 'r%n_ion'", q.wildcard("text", "r*n?ion"))
_pattern("prefix_indexed", "starts_with(x, 'unde')", q.prefix("text", "unde"))
_pattern("regexp_indexed", "regexp_full_match(x, 're+.n[a-t]ion|sch.+en')", q.regexp("text", "re+.n[a-t]ion|sch.+en"))
_pattern("fuzzy_indexed", "levenshtein(x, 'reention') <= 2", q.fuzzy("text", "reention"))


@query("bm25_batch_indexed", BATCH_SQL)
def bm25_batch_indexed(spark, sf):
    """Best rows by blocks of postings, after rows were added to the index."""
    c = t.documents(spark, sf)
    index = indexed(spark, c.with_df(c.df.where("doc_id % 3 > 0")), "text")
    index = index.added(c.with_df(c.df.where("doc_id % 3 = 0")), "text")
    found = index.search_batch(t.load(spark, sf, "benchmark"), k=10, query_id="item_id").rows
    return found.select("item_id", F.col("id").alias("_id"), F.round("_score", 4).alias("_score"), "rank")


@query(
    "min_score",
    bm25_sql(["the", "under"], "SELECT _id, round(score, 4) AS _score FROM scored WHERE score >= 0.8"),
)
def min_score(spark, sf):
    c = t.documents(spark, sf)
    found = s.search(c, q.match("text", "the under"), size=None, min_score=0.8, source=["_id"])
    return found.select("_id", F.round("_score", 4).alias("_score"))


# --- sorting and paging ---------------------------------------------------


@query(
    "sort",
    f"WITH {PRODUCTS} SELECT _id, rating, price,"
    " row_number() OVER (ORDER BY rating DESC NULLS LAST, price ASC, _id) - 1 AS _position FROM products",
)
def sort(spark, sf):
    c = t.products(spark, sf)
    rows = s.sorted_rows_numbered(c, sort_keys(c, [("rating", "desc"), "price"]))
    return rows.select("_id", "rating", "price", "_position")


@query(
    "sort_by",
    f"WITH {PRODUCTS} SELECT _id, rating FROM products"
    " ORDER BY rating ASC NULLS FIRST, list_max(tags), coalesce(lat, 0) DESC, _id LIMIT 50",
)
def sort_by(spark, sf):
    keys = [
        SortKey("rating", missing="_first"),
        SortKey("tags", mode="max"),
        SortKey("location.lat", "desc", missing=0.0),
    ]
    return s.search(t.products(spark, sf), None, sort=keys, size=50, source=["rating"])


@query("page", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice FROM orders ORDER BY o_totalprice DESC, _id LIMIT 25 OFFSET 100")
def page(spark, sf):
    c = t.orders(spark, sf)
    return s.search(c, None, sort=[("o_totalprice", "desc")], from_=100, size=25, source=["o_totalprice"])


@query(
    "page_deep",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice FROM orders ORDER BY o_totalprice DESC, _id LIMIT 25 OFFSET 12000",
)
def page_deep(spark, sf):
    c = t.orders(spark, sf)
    return s.search(c, None, sort=[("o_totalprice", "desc")], from_=12000, size=25, source=["o_totalprice"])


@query("top_k", f"WITH {PRODUCTS} SELECT _id, price FROM products WHERE published ORDER BY price DESC, _id LIMIT 10")
def top_k(spark, sf):
    return s.search(t.products(spark, sf), q.term("published", True), sort=[("price", "desc")], source=["price"])


@query(
    "search_after",
    f"WITH {PRODUCTS} SELECT _id, rating, price FROM products"
    " WHERE rating IS NULL OR rating < 3.0 OR (rating = 3.0 AND price > 1000)"
    " OR (rating = 3.0 AND price = 1000 AND _id > '5') ORDER BY rating DESC NULLS LAST, price, _id LIMIT 40",
)
def search_after(spark, sf):
    c = t.products(spark, sf)
    found = paging.search_after(
        c, sort=[("rating", "desc"), "price"], values=(3.0, 1000.0, "5"), size=40, source=["rating", "price"]
    )
    return found.drop("sort")


@query(
    "search_after_highlight",
    rf"WITH {DOCS} SELECT _id, regexp_replace(text, '(?i)\b(and|the)\b', '<em>\1</em>', 'g') AS fragment FROM docs"
    " WHERE list_has_any(tokens, ['and', 'the']) AND lang = 'en' AND (n_chars < 900 OR (n_chars = 900 AND _id > '5'))"
    " ORDER BY n_chars DESC, _id LIMIT 20",
)
def search_after_highlight(spark, sf):
    c = t.documents(spark, sf)
    condition = q.match("text", "and the") & q.term("lang", "en")
    found = paging.search_after(
        c, condition, sort=[("n_chars", "desc")], values=(900, "5"), size=20, source=["_id"], highlight=["text"]
    )
    return found.select("_id", F.col("highlight")["text"][0].alias("fragment"))


@query(
    "search_after_next",
    "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice FROM orders WHERE o_orderstatus = 'O'"
    " ORDER BY o_totalprice, _id LIMIT 30 OFFSET 60",
)
def search_after_next(spark, sf):
    pager = paging.Pager(
        t.orders(spark, sf), q.term("o_orderstatus", "O"), sort=["o_totalprice"], size=30, source=["o_totalprice"]
    )
    pager.first()
    pager.next()
    return pager.next().drop("sort")


@query(
    "scroll_export",
    "WITH n AS (SELECT l_orderkey || '-' || l_linenumber AS _id, row_number() OVER () AS r FROM lineitem"
    " WHERE l_returnflag = 'R'),"
    " b AS (SELECT unnest(range(CAST(ceil(count(*) / 1000.0) AS BIGINT))) AS batch, count(*) AS n, count(DISTINCT _id) AS ids,"
    " sum(length(_id)) AS chars FROM n)"
    " SELECT batch, CAST(least(1000, n - batch * 1000) AS BIGINT) AS hits, ids, CAST(chars AS BIGINT) AS chars FROM b",
)
def scroll_export(spark, sf):
    """Sizes of the batches, and that together they hold every row once."""
    from siftframe import Collection

    rows = t.load(spark, sf, "lineitem").withColumn("_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    batches = paging.scroll_export(Collection(rows), q.term("l_returnflag", "R"), size=1000)
    ids = batches.agg(F.count_distinct("_id")).scalar()
    chars = batches.agg(F.sum(F.length("_id"))).scalar()
    sizes = batches.groupBy(F.col("_batch").alias("batch")).agg(F.count_distinct("_position").alias("hits"))
    return sizes.withColumns({"ids": ids, "chars": chars})


@query(
    "mget",
    f"WITH {PRODUCTS}, asked AS (SELECT l_orderkey * 8 + l_linenumber AS _pos, CAST(l_partkey + 700 AS VARCHAR) AS _id FROM lineitem)"
    " SELECT _pos, a._id, p._id IS NOT NULL AS found, title FROM asked a LEFT JOIN products p ON p._id = a._id",
)
def mget(spark, sf):
    asked = t.load(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_pos"),
        (F.col("l_partkey") + 700).cast("string").alias("_id"),
    )
    return s.mget(t.products(spark, sf), asked).select("_pos", "_id", "found", "title")
