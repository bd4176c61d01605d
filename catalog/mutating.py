"""Bulk operations and changes by condition.

The table is the customers; the operations come from the orders, several per
customer, some for customers that do not exist yet.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from catalog.tables import PRODUCTS
from siftframe import Collection
from siftframe.operators import mutate as w
from siftframe.plans import conditions as q
from siftframe.session import scratch_path, stage
from siftframe.sources.snapshots import Snapshots


def customers(spark, sf):
    return t.load(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("_id"),
        F.lit(1).cast("bigint").alias("_version"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("profile"),
    )


def operations(spark, sf, action: str | None = None):
    return as_operations(t.load(spark, sf, "orders"), action)


def as_operations(orders, action: str | None = None):
    """One operation per order; its priority decides on the action."""
    key = F.col("o_orderkey")
    chosen = F.create_map(
        *[F.lit(x) for pair in zip(PRIORITIES, ("index", "create", "update", "delete", "upsert")) for x in pair]
    )[F.col("o_orderpriority")]
    return orders.select(
        key.alias("seq"),
        (F.lit(action) if action else chosen).alias("action"),
        F.concat(F.when(F.col("o_orderstatus") == "P", "new-").otherwise(""), F.col("o_custkey").cast("string")).alias("_id"),
        F.struct(
            F.concat(F.lit("order "), key).alias("name"),
            F.col("o_totalprice").alias("balance"),
            F.struct((key % 25).cast("int").alias("nation"), F.col("o_orderstatus").alias("segment")).alias("profile"),
        ).alias("doc"),
        F.when(key % 3 == 0, F.array(F.lit("profile.segment")))
        .when(key % 3 == 1, F.array(F.lit("balance"), F.lit("name")))
        .otherwise(F.array(F.lit("profile")))
        .alias("set_fields"),
    )


# The order priorities of the test tables.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

_LAST = "last_value({x} IGNORE NULLS) OVER (PARTITION BY _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def bulk_sql(select: str, action: str | None = None) -> str:
    """The same running values in SQL. ``select`` reads ``items``, or ``final``
    for the resulting table."""
    chosen = f"'{action}'" if action else (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'index' WHEN '2-HIGH' THEN 'create' WHEN '3-MEDIUM' THEN 'update'"
        " WHEN '4-NOT SPECIFIED' THEN 'delete' ELSE 'upsert' END"
    )
    fields = {
        "name": ("'order ' || seq", "named_name"),
        "balance": ("price", "named_balance"),
        "nation": ("CAST(seq % 25 AS INT)", "named_nation"),
        "segment": ("status", "named_segment"),
    }
    writes = ", ".join(
        f"CASE WHEN NOT fails AND (whole OR {named}) THEN {{'v': CASE WHEN action <> 'delete' THEN {value} END}} END AS w_{f}"
        for f, (value, named) in fields.items()
    )
    before = ", ".join(f"{_LAST.format(x='w_' + f)} AS b_{f}" for f in fields)
    olds = {f: f"(CASE WHEN b_{f} IS NOT NULL THEN b_{f}.v ELSE old_{f} END)" for f in fields}
    same = " AND ".join(f"(w_{f} IS NULL OR w_{f}.v IS NOT DISTINCT FROM {olds[f]})" for f in fields)
    ends = ", ".join(f"CASE WHEN w_{f} IS NOT NULL THEN w_{f}.v ELSE {olds[f]} END AS {f}" for f in fields)
    return f"""
    WITH target AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name AS name, c_acctbal AS balance, c_nationkey AS nation,
        c_mktsegment AS segment FROM customer),
    ops AS (SELECT o_orderkey AS seq, {chosen} AS action,
        CASE WHEN o_orderstatus = 'P' THEN 'new-' ELSE '' END || o_custkey AS _id, o_totalprice AS price,
        o_orderstatus AS status, o_orderkey % 3 = 1 AS named_name, o_orderkey % 3 = 1 AS named_balance,
        o_orderkey % 3 = 2 AS named_nation, o_orderkey % 3 <> 1 AS named_segment FROM orders),
    joined AS (SELECT o.*, t._id IS NOT NULL AS had, t.name AS old_name, t.balance AS old_balance, t.nation AS old_nation,
        t.segment AS old_segment,
        CASE WHEN action IN ('index', 'create', 'upsert') THEN true WHEN action = 'delete' THEN false END AS sets
        FROM ops o LEFT JOIN target t ON t._id = o._id),
    a AS (SELECT *, coalesce({_LAST.format(x='sets')}, had) AS found FROM joined),
    b AS (SELECT *, (action = 'create' AND found) OR (action IN ('update', 'delete') AND NOT found) AS fails,
        action <> 'update' AND NOT (action = 'upsert' AND found) AS whole FROM a),
    c AS (SELECT *, {writes} FROM b),
    d AS (SELECT *, {before} FROM c),
    e AS (SELECT *, NOT whole AND NOT fails AND {same} AS noop, {ends} FROM d),
    f AS (SELECT *, CAST(NOT fails AND NOT noop AS INT) AS change FROM e),
    g AS (SELECT *, CAST(had AS INT) + sum(change) OVER (PARTITION BY _id ORDER BY seq) AS version FROM f),
    items AS (SELECT seq, action, _id, CASE WHEN NOT fails THEN CAST(version AS BIGINT) END AS _version,
        CASE WHEN fails AND action = 'create' THEN 'error' WHEN fails THEN 'not_found' WHEN noop THEN 'noop'
          WHEN action = 'delete' THEN 'deleted' WHEN found THEN 'updated' ELSE 'created' END AS result,
        CASE WHEN fails AND action = 'create' THEN 409 WHEN fails THEN 404 WHEN action <> 'delete' AND NOT found THEN 201
          ELSE 200 END AS status,
        CASE WHEN fails AND action = 'create' THEN 'document already exists' WHEN fails THEN 'document missing' END AS error
        FROM g),
    last AS (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY seq DESC) AS back FROM g),
    final AS (
        SELECT _id, CAST(version AS BIGINT) AS _version, name, balance, nation, segment FROM last
        WHERE back = 1 AND coalesce(sets, found)
        UNION ALL SELECT _id, CAST(1 AS BIGINT), name, balance, nation, segment FROM target
        WHERE _id NOT IN (SELECT _id FROM ops))
    {select}"""


ALL_ITEMS = "SELECT seq, action, _id, _version, result, CAST(status AS INT) AS status, error FROM items"
WHOLE_TABLE = "SELECT * FROM final"


def flat(table):
    return table.select("_id", "_version", "name", "balance", "profile.nation", "profile.segment")


def _single(name: str, action: str):
    @query(name, bulk_sql(WHOLE_TABLE, action))
    def table(spark, sf):
        return flat(w.bulk(customers(spark, sf), operations(spark, sf, action)).table)

    @query(f"{name}_items", bulk_sql(ALL_ITEMS, action))
    def items(spark, sf):
        return w.bulk(customers(spark, sf), operations(spark, sf, action)).items


for _name, _action in (
    ("bulk_index", "index"),
    ("bulk_create", "create"),
    ("bulk_update", "update"),
    ("upsert", "upsert"),
    ("bulk_delete", "delete"),
):
    _single(_name, _action)


@query("bulk_mixed", bulk_sql(WHOLE_TABLE))
def bulk_mixed(spark, sf):
    return flat(w.bulk(customers(spark, sf), operations(spark, sf)).table)


@query("bulk_mixed_items", bulk_sql(ALL_ITEMS))
def bulk_mixed_items(spark, sf):
    return w.bulk(customers(spark, sf), operations(spark, sf)).items


@query("bulk_mixed_crowded", bulk_sql(ALL_ITEMS))
def bulk_mixed_crowded(spark, sf):
    """The same with the operations of one id spread over several tasks."""
    return w.bulk(customers(spark, sf), operations(spark, sf), hot_ops=5).items


@query(
    "bulk_report",
    bulk_sql(
        "SELECT count(*) AS total, count(*) FILTER (error IS NULL) AS succeeded,"
        " count(*) FILTER (error IS NOT NULL) AS failed, count(error) > 0 AS has_errors FROM items"
    ),
)
def bulk_report(spark, sf):
    return w.bulk_report(w.bulk(customers(spark, sf), operations(spark, sf)).items)


FINISHED = "o_orderstatus = 'F'"


def _indexed(wanted: str, name: str) -> str:
    """Last operation per id of the orders that ``wanted`` admits, and their number."""
    return (
        f"SELECT '{name}' AS name, CAST(o_custkey AS VARCHAR) AS _id, count(*) AS n, 'order ' || max(o_orderkey) AS text,"
        f" max_by(o_totalprice, o_orderkey) AS balance, CAST(max(o_orderkey) % 25 AS INT) AS nation,"
        f" max_by(o_orderstatus, o_orderkey) AS segment FROM orders WHERE {wanted} GROUP BY o_custkey"
    )


@query(
    "bulk_multi_table",
    f"WITH i AS ({_indexed('NOT ' + FINISHED, 'customer')} UNION ALL {_indexed(FINISHED, 'finished')})"
    " SELECT i.name, i._id, CAST(n + CASE WHEN i.name = 'customer' AND c_custkey IS NOT NULL THEN 1 ELSE 0 END AS BIGINT)"
    " AS _version, text, balance, nation, segment FROM i LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = i._id"
    " UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), CAST(1 AS BIGINT), c_name, c_acctbal, c_nationkey,"
    " c_mktsegment FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT _id FROM i WHERE name = 'customer')",
)
def bulk_multi_table(spark, sf):
    ops = operations(spark, sf, "index")
    named = F.when(F.col("doc.profile.segment") == "F", "finished")
    ops = ops.withColumn("_index", named).withColumn("_id", F.regexp_replace("_id", "^new-", ""))
    table = customers(spark, sf)
    results = w.bulk_tables({"customer": table, "finished": table.limit(0)}, ops, default="customer")
    rows = [
        r.table.select(
            F.lit(n).alias("name"), "_id", "_version", F.col("name").alias("text"), "balance", "profile.nation",
            "profile.segment",
        )
        for n, r in results.items()
    ]
    return rows[0].unionByName(rows[1])


def _both(snapshot, moment: str):
    """All rows of both tables as a version has them."""
    rows = [
        snapshot.read(name).select(
            F.lit(moment).alias("moment"), F.lit(name).alias("name"), "_id", "_version", F.col("name").alias("text"), "balance"
        )
        for name in ("customer", "finished")
    ]
    return rows[0].unionByName(rows[1])


@query(
    "snapshot_pinned",
    f"WITH i AS ({_indexed('NOT ' + FINISHED, 'customer')} UNION ALL {_indexed(FINISHED, 'finished')})"
    " SELECT 'after' AS moment, i.name, i._id, CAST(n + CASE WHEN i.name = 'customer' AND c_custkey IS NOT NULL THEN 1 ELSE 0"
    " END AS BIGINT) AS _version, text, balance FROM i LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = i._id"
    " UNION ALL SELECT 'after', 'customer', CAST(c_custkey AS VARCHAR), CAST(1 AS BIGINT), c_name, c_acctbal FROM customer"
    " WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT _id FROM i WHERE name = 'customer')"
    " UNION ALL SELECT 'before', 'customer', CAST(c_custkey AS VARCHAR), CAST(1 AS BIGINT), c_name, c_acctbal FROM customer",
)
def snapshot_pinned(spark, sf):
    """A bulk over two tables is published at once: a reader that holds the
    version before it has the old rows of both, a new reader the new ones."""
    store = Snapshots(spark, scratch_path(spark, "tables"))
    table = customers(spark, sf)
    with store.commit() as commit:
        commit.append("customer", table)
        commit.append("finished", table.limit(0))
    pinned = store.pinned()
    named = F.when(F.col("doc.profile.segment") == "F", "finished")
    ops = operations(spark, sf, "index").withColumn("_index", named).withColumn("_id", F.regexp_replace("_id", "^new-", ""))
    w.publish_bulk(store, ops, default="customer")
    return _both(pinned, "before").unionByName(_both(store.pinned(), "after"))


@query(
    "bulk_null_object",
    "SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey % 3 <> 0 AS has_profile,"
    " CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment,"
    " CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 0.0 ELSE c_acctbal END AS balance FROM customer",
)
def bulk_null_object(spark, sf):
    """Updates of another field leave null objects null."""
    table = customers(spark, sf)
    table = table.withColumn("profile", F.when(F.col("_id").cast("long") % 3 != 0, F.col("profile")))
    ops = operations(spark, sf, "update").withColumn("_id", F.regexp_replace("_id", "^new-", ""))
    ops = ops.withColumn("doc", F.col("doc").withField("balance", F.lit(0.0)))
    found = w.bulk(table, ops.withColumn("set_fields", F.array(F.lit("balance")))).table
    return found.select("_id", F.col("profile").isNotNull().alias("has_profile"), "profile.segment", "balance")


@query(
    "bulk_generated_ids",
    "SELECT CAST(1 AS BIGINT) AS _version, 'order ' || o_orderkey AS name, o_totalprice AS balance,"
    " CAST(o_orderkey % 25 AS INTEGER) AS nation, o_orderstatus AS segment, count(*) OVER () AS ids FROM orders",
)
def bulk_generated_ids(spark, sf):
    """Operations without an id become one document each, all ids different."""
    ops = operations(spark, sf, "index").withColumn("_id", F.lit(None).cast("string"))
    found = stage(w.bulk(customers(spark, sf).limit(0), ops).table, "found")
    ids = found.agg(F.count_distinct("_id")).scalar()
    return flat(found).drop("_id").withColumn("ids", ids)


def versioned_products(spark, sf) -> Collection:
    c = t.products(spark, sf)
    return c.with_df(c.df.withColumn("_version", F.lit(1).cast("bigint")).drop("tags", "location"))


COLUMNS = "_id, title, category, brand, {price} AS price, {views} AS views, published, rating, CAST({version} AS BIGINT) AS _version"


@query(
    "update_by_query",
    f"WITH {PRODUCTS} SELECT "
    + COLUMNS.format(
        price="price",
        views="CASE WHEN category = 'PROMO' AND price >= 950 THEN 10 ELSE views END",
        version="CASE WHEN category = 'PROMO' AND price >= 950 AND views <> 10 THEN 2 ELSE 1 END",
    )
    + " FROM products",
)
def update_by_query(spark, sf):
    condition = q.term("category", "PROMO") & q.between("price", gte=950)
    return w.update_by_query(versioned_products(spark, sf), condition, {"views": 10})


IDS_TABLE = "_id IN (SELECT CAST(ps.p_partkey AS VARCHAR) FROM part ps WHERE ps.p_size < 30)"


def small_parts(spark, sf):
    return t.load(spark, sf, "part").where("p_size < 30").select(F.col("p_partkey").cast("string"))


@query(
    "update_by_ids_table",
    f"WITH {PRODUCTS} SELECT "
    + COLUMNS.format(
        price="price",
        views=f"CASE WHEN {IDS_TABLE} OR price >= 990 THEN 10 ELSE views END",
        version=f"CASE WHEN ({IDS_TABLE} OR price >= 990) AND views <> 10 THEN 2 ELSE 1 END",
    )
    + " FROM products",
)
def update_by_ids_table(spark, sf):
    condition = q.any_of(q.ids(small_parts(spark, sf)), q.between("price", gte=990))
    return w.update_by_query(versioned_products(spark, sf), condition, {"views": 10})


@query(
    "delete_by_ids_table",
    f"WITH {PRODUCTS} SELECT _id, rating, price FROM products"
    f" WHERE NOT ({IDS_TABLE} AND coalesce(rating >= 2, false)) AND coalesce(price < 990, true)",
)
def delete_by_ids_table(spark, sf):
    rated = q.ids(small_parts(spark, sf)) & q.between("rating", gte=2.0)
    kept = w.delete_by_query(t.products(spark, sf), rated | q.between("price", gte=990))
    return kept.select("_id", "rating", "price")


@query(
    "script_update",
    f"WITH {PRODUCTS} SELECT "
    + COLUMNS.format(
        price="CASE WHEN rating > 2 THEN round(price * 0.9, 4) ELSE price END",
        views="CASE WHEN rating > 2 THEN views + 50 ELSE views END",
        version="CASE WHEN rating > 2 THEN 2 ELSE 1 END",
    )
    + " FROM products",
)
def script_update(spark, sf):
    computed = {"views": "views + 50", "price": "round(price * 0.9, 4)"}
    return w.script_update(versioned_products(spark, sf), q.between("rating", gt=2.0), computed)


@query(
    "delete_by_query",
    f"WITH {PRODUCTS} SELECT _id, rating, price FROM products WHERE NOT (coalesce(rating >= 2, false) AND price < 1050)",
)
def delete_by_query(spark, sf):
    kept = w.delete_by_query(t.products(spark, sf), q.between("rating", gte=2.0) & q.between("price", lt=1050))
    return kept.select("_id", "rating", "price")
