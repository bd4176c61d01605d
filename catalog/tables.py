"""Views that the queries share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftframe import Collection, Field, Mapping
from siftframe.sources.documents import gather_objects, spread

PRODUCT_FIELDS = Mapping(
    {
        "title": Field("text", fields={"keyword": Field("keyword")}),
        "tags": Field("keyword"),
        "category": Field("keyword"),
        "brand": Field("keyword"),
        "price": Field("double"),
        "views": Field("integer"),
        "published": Field("boolean"),
        "rating": Field("double"),
        "location": Field("geo_point"),
    }
)


# Tables of texts, where work per row outweighs moving a small file's rows.
TEXTS = ("documents", "pages", "conversations")


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df) if name in TEXTS else df


def products(spark: SparkSession, sf: str) -> Collection:
    key = F.col("p_partkey")
    lat = (key * 37 % 18000).cast("double") / 100 - 90
    lon = (key * 91 % 36000).cast("double") / 100 - 180
    df = load(spark, sf, "part").select(
        key.cast("string").alias("_id"),
        F.col("p_name").alias("title"),
        F.split("p_name", " ").alias("tags"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("views"),
        (F.col("p_size") % 5 != 0).alias("published"),
        F.when(key % 7 != 0, F.col("p_size").cast("double") / 10).alias("rating"),
        F.when(key % 10 != 0, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("location"),
    )
    return Collection(df, PRODUCT_FIELDS)


PRODUCTS = r"""
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS _id, p_name AS title, string_split(p_name, ' ') AS tags,
    p_type AS category, p_brand AS brand, p_retailprice AS price, p_size AS views,
    (p_size % 5 <> 0) AS published,
    CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) / 10 END AS rating,
    CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey * 37 % 18000 AS DOUBLE) / 100 - 90 END AS lat,
    CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey * 91 % 36000 AS DOUBLE) / 100 - 180 END AS lon
  FROM part)"""


def documents(spark: SparkSession, sf: str) -> Collection:
    df = load(spark, sf, "documents").withColumn("_id", F.col("doc_id").cast("string"))
    return Collection(df, Mapping({"text": Field("text"), "lang": Field("keyword"), "source": Field("keyword")}))


WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')"

DOCS = rf"""
docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS _id, text, lang, source, n_chars, {WORDS} AS tokens FROM documents)"""


def conversations(spark: SparkSession, sf: str) -> Collection:
    df = load(spark, sf, "conversations")
    df = df.withColumn("_id", F.concat_ws("-", "conv_id", "turn"))
    return Collection(df, Mapping({"text": Field("text"), "role": Field("keyword")}))


TURNS = rf"""
turns AS (
  SELECT conv_id || '-' || turn AS _id, role, text, {WORDS} AS tokens FROM conversations)"""


def orders(spark: SparkSession, sf: str) -> Collection:
    df = load(spark, sf, "orders").withColumn("_id", F.col("o_orderkey").cast("string"))
    names = {"o_orderstatus": Field("keyword"), "o_orderpriority": Field("keyword"), "o_orderdate": Field("date")}
    return Collection(df, Mapping(names))


def events(spark: SparkSession, sf: str) -> Collection:
    df = load(spark, sf, "events").withColumn("_id", F.col("event_id").cast("string"))
    return Collection(df, Mapping({"event_type": Field("keyword"), "ts": Field("date")}))


def orders_with_items(spark: SparkSession, sf: str) -> Collection:
    items = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    c = orders(spark, sf)
    nested = {"items": Field("nested", properties={"partkey": Field("long"), "quantity": Field("double")})}
    rows = gather_objects(c.df, items, "o_orderkey", "items", "line")
    return Collection(rows, c.mapping.extended(nested))
