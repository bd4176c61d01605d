"""Mappings, aliases, nested documents and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from catalog.tables import PRODUCTS
from siftframe import Collection, Field, Mapping
from siftframe.functions.dates import epoch_micros
from siftframe.plans import conditions as q
from siftframe.sources import documents as d
from siftframe.sources import mapping as mp


@query("alias_filtered", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 1000")
def alias_filtered(spark, sf):
    d.alias_view(t.orders(spark, sf), "open_orders", q.term("o_orderstatus", "O"))
    return spark.table("open_orders").where("o_totalprice >= 1000").select("o_orderkey", "o_totalprice")


def raw_orders(spark, sf):
    """Orders as text: two date formats, some prices that are not numbers."""
    key = F.col("o_orderkey")
    millis = (epoch_micros(F.col("o_orderdate")) / 1000).cast("bigint").cast("string")
    return t.load(spark, sf, "orders").select(
        key.cast("string").alias("id"),
        F.when(key % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(key % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(millis).alias("created"),
        F.when(F.col("o_orderstatus") == "O", "true").otherwise("false").alias("open"),
        F.col("o_orderpriority").alias("note"),
    )


ORDER_FIELDS = Mapping(
    {
        "id": Field("long"),
        "price": Field("double"),
        "created": Field("date", formats=("yyyy-MM-dd HH:mm:ss", "epoch_millis")),
        "open": Field("boolean"),
        "note": Field("text"),
        "note_words": Field("token_count", path="note"),
    }
)


@query(
    "apply_mapping",
    "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price, o_orderdate AS created,"
    " o_orderstatus = 'O' AS open, o_orderpriority AS note,"
    r" CAST(len(regexp_extract_all(o_orderpriority, '[\p{L}\p{N}]+')) AS INT) AS note_words,"
    " CASE WHEN o_orderkey % 11 = 0 THEN 'price' ELSE '' END AS ignored FROM orders",
)
def apply_mapping(spark, sf):
    found = mp.apply_mapping(raw_orders(spark, sf), ORDER_FIELDS)
    return found.withColumn("ignored", F.array_join("_ignored", ",")).drop("_ignored")


@query(
    "extend_mapping",
    "SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name AS name, CAST(NULL AS INT) AS quality, CAST(NULL AS VARCHAR) AS note FROM customer"
    " UNION ALL SELECT 's' || s_suppkey, s_name, CAST(s_nationkey AS INT), 'supplier' FROM supplier",
)
def extend_mapping(spark, sf):
    old = t.load(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("_id"), F.col("c_name").alias("name"))
    declared = Mapping({"name": Field("text")})
    wider, _ = mp.extend_mapping(old, declared, {"quality": Field("integer"), "note": Field("keyword")})
    new = t.load(spark, sf, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("int").alias("quality"),
        F.lit("supplier").alias("note"),
    )
    return mp.append_rows(wider, new)


@query(
    "multi_field",
    f"WITH {PRODUCTS} SELECT _id, title, title AS title__keyword FROM products WHERE title = 'red ring' OR title = 'blue bolt'",
)
def multi_field(spark, sf):
    c = t.products(spark, sf)
    c = c.with_df(mp.with_multi_fields(c.df, c.mapping))
    exact = q.terms("title.keyword", "red ring", "blue bolt")
    return q.where(c.df, exact, c.scope).select("_id", "title", "title__keyword")


@query(
    "ignore_above",
    "SELECT doc_id, CASE WHEN length(text) <= 500 THEN text END AS text__keyword FROM documents",
)
def ignore_above(spark, sf):
    declared = Mapping({"text": Field("text", fields={"keyword": Field("keyword", ignore_above=500)})})
    return mp.with_multi_fields(t.load(spark, sf, "documents"), declared).select("doc_id", "text__keyword")


@query(
    "nested_struct",
    "SELECT event_id, user_id AS id, event_type AS kind, CAST(json_extract(props, '$.k') AS INT) AS k FROM events"
    " WHERE CAST(json_extract(props, '$.k') AS INT) >= 50",
)
def nested_struct(spark, sf):
    """Objects three levels deep, queried by dotted path."""
    user = Field(
        "object",
        properties={
            "id": Field("long"),
            "last": Field("object", properties={"kind": Field("keyword"), "props": Field("object", properties={"k": Field("integer")})}),
        },
    )
    last = d.document(kind=F.col("event_type"), props=F.from_json("props", "k int"))
    df = t.load(spark, sf, "events").select("event_id", d.document(id=F.col("user_id"), last=last).alias("user"))
    c = Collection(df, Mapping({"user": user}), id="event_id")
    found = q.where(c.df, q.between("user.last.props.k", gte=50), c.scope)
    return found.select("event_id", "user.id", "user.last.kind", "user.last.props.k")


@query(
    "build_documents",
    "SELECT conv_id, count(*) AS turns, sum(length(text)) AS characters, arg_min(role, turn) AS first_role,"
    " arg_max(text, turn) AS last_text FROM conversations GROUP BY conv_id",
)
def build_documents(spark, sf):
    """One document per conversation, its turns as a list of objects."""
    rows = t.load(spark, sf, "conversations")
    docs = d.gather_objects(rows.select("conv_id").distinct(), rows, "conv_id", "turns", "turn")
    sizes = F.aggregate("turns", F.lit(0).cast("bigint"), lambda total, x: total + F.length(x.text))
    return docs.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("turns"),
        sizes.alias("characters"),
        F.col("turns")[0].role.alias("first_role"),
        F.element_at("turns", -1).text.alias("last_text"),
    )


@query(
    "flattened_get",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract_string(props, '$.k') <> '7'",
)
def flattened_get(spark, sf):
    declared = Mapping({"props": Field("flattened")})
    df = mp.apply_mapping(t.load(spark, sf, "events").select("event_id", "props"), declared)
    c = Collection(df, declared, id="event_id")
    found = q.where(c.df, q.exists("props.k") & ~q.term("props.k", "7"), c.scope)
    return found.select("event_id", d.flattened_get("props", "k").alias("k"))
