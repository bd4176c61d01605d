"""Metrics, buckets, nested buckets, geo aggregations and pipelines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import tables as t
from catalog.registry import query
from catalog.searching import HAVERSINE
from catalog.tables import PRODUCTS
from siftframe import Collection
from siftframe.operators import buckets as b
from siftframe.operators import metrics as m
from siftframe.operators import pipelines as p
from siftframe.operators import sketches as sk
from siftframe.operators.sketches import Distinct, Quantiles
from siftframe.plans import conditions as q
from siftframe.session import stage


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 4) for n in names})


def lineitem(spark, sf) -> Collection:
    df = t.load(spark, sf, "lineitem").withColumn("_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return Collection(df)


# --- metrics --------------------------------------------------------------


@query(
    "agg_with_query",
    "SELECT round(avg(l_extendedprice), 4) AS price, round(sum(l_quantity), 4) AS quantity FROM lineitem"
    " WHERE l_returnflag = 'R' AND l_discount BETWEEN 0.02 AND 0.06",
)
def agg_with_query(spark, sf):
    condition = q.term("l_returnflag", "R") & q.between("l_discount", 0.02, 0.06)
    found = m.aggregate(
        lineitem(spark, sf), {"price": m.avg("l_extendedprice"), "quantity": m.sum_of("l_quantity")}, condition
    )
    return rounded(found, "price", "quantity")


@query("agg_avg", "SELECT round(avg(c_acctbal), 4) AS balance FROM customer")
def agg_avg(spark, sf):
    return rounded(m.aggregate(Collection(t.load(spark, sf, "customer")), {"balance": m.avg("c_acctbal")}), "balance")


@query("agg_sum", "SELECT round(sum(o_totalprice), 4) AS total FROM orders")
def agg_sum(spark, sf):
    return rounded(m.aggregate(t.orders(spark, sf), {"total": m.sum_of("o_totalprice")}), "total")


@query("agg_min", "SELECT min(c_acctbal) AS low FROM customer")
def agg_min(spark, sf):
    return m.aggregate(Collection(t.load(spark, sf, "customer")), {"low": m.min_of("c_acctbal")})


@query("agg_max", "SELECT max(l_shipdate) AS last FROM lineitem")
def agg_max(spark, sf):
    return m.aggregate(lineitem(spark, sf), {"last": m.max_of("l_shipdate")})


@query("agg_value_count", f"WITH {PRODUCTS} SELECT count(rating) AS ratings, sum(len(tags)) AS tags FROM products")
def agg_value_count(spark, sf):
    return m.aggregate(t.products(spark, sf), {"ratings": m.value_count("rating"), "tags": m.value_count("tags")})


@query(
    "agg_stats",
    "SELECT count(value) AS v_count, min(value) AS v_min, max(value) AS v_max, round(avg(value), 4) AS v_avg,"
    " round(sum(value), 4) AS v_sum FROM events",
)
def agg_stats(spark, sf):
    return rounded(m.aggregate(t.events(spark, sf), {"v": m.stats("value")}), "v_avg", "v_sum")


@query(
    "agg_extended_stats",
    "SELECT count(c_acctbal) AS b_count, min(c_acctbal) AS b_min, max(c_acctbal) AS b_max,"
    " round(avg(c_acctbal), 4) AS b_avg, round(sum(c_acctbal), 4) AS b_sum,"
    " round(sum(c_acctbal * c_acctbal), 2) AS b_sum_of_squares,"
    " round(var_pop(c_acctbal), 2) AS b_variance_population, round(var_samp(c_acctbal), 2) AS b_variance_sampling,"
    " round(stddev_pop(c_acctbal), 4) AS b_std_population, round(stddev_samp(c_acctbal), 4) AS b_std_sampling,"
    " round(avg(c_acctbal) + 2 * stddev_pop(c_acctbal), 4) AS b_upper,"
    " round(avg(c_acctbal) - 2 * stddev_pop(c_acctbal), 4) AS b_lower FROM customer",
)
def agg_extended_stats(spark, sf):
    found = m.aggregate(Collection(t.load(spark, sf, "customer")), {"b": m.extended_stats("c_acctbal")})
    squares = ["b_sum_of_squares", "b_variance_population", "b_variance_sampling"]
    others = ["b_avg", "b_sum", "b_std_population", "b_std_sampling", "b_upper", "b_lower"]
    return rounded(found.withColumns({n: F.round(n, 2) for n in squares}), *others)


@query(
    "agg_list_metrics",
    "SELECT round(sum(l_quantity), 4) AS q_sum, count(l_quantity) AS q_count, min(l_quantity) AS q_min,"
    " max(l_quantity) AS q_max, round(avg(l_quantity), 4) AS q_avg FROM lineitem"
    " WHERE l_orderkey IN (SELECT o_orderkey FROM orders)",
)
def agg_list_metrics(spark, sf):
    """Metrics over a list field see every element."""
    found = m.aggregate(t.orders_with_items(spark, sf), {"q": m.stats("items.quantity")})
    return rounded(found, "q_sum", "q_avg")


@query("agg_cardinality", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def agg_cardinality(spark, sf):
    wanted = {"parts": m.cardinality("l_partkey", exact=True), "suppliers": m.cardinality("l_suppkey", exact=True)}
    return m.aggregate(lineitem(spark, sf), wanted)


@query("agg_cardinality_approx", "SELECT count(DISTINCT l_partkey) AS parts, true AS near FROM lineitem")
def agg_cardinality_approx(spark, sf):
    """The sketch beside the exact count: within five standard errors."""
    wanted = {"sketch": m.cardinality("l_partkey", rsd=0.01), "parts": m.cardinality("l_partkey", exact=True)}
    found = m.aggregate(lineitem(spark, sf), wanted)
    near = F.abs(F.col("sketch") - F.col("parts")) <= 0.05 * F.col("parts")
    return found.select("parts", near.alias("near"))


# A day has fewer users and values than the sketches hold one by one, and a
# month's merge is read against the exact figures.
DAILY = {"users": Distinct("user_id", lg_k=18), "value": Quantiles("value", (5, 50, 95), k=60_000)}
EXACT_SKETCHES = (
    "SELECT date_trunc('{unit}', ts){cast} AS key, event_type, count(*) AS rows, count(DISTINCT user_id) AS users,"
    " quantile_disc(value, 0.05) AS value_p5, quantile_disc(value, 0.5) AS value_p50, quantile_disc(value, 0.95) AS value_p95"
    " FROM events GROUP BY 1, 2"
)


def _day(ts: str = "ts"):
    return F.date_trunc("day", ts).cast("timestamp_ntz")


@query("sketch_months", EXACT_SKETCHES.format(unit="month", cast="::TIMESTAMP"))
def sketch_months(spark, sf):
    """Stored daily sketches, merged into months."""
    days = sk.sketched(t.load(spark, sf, "events"), {"day": _day(), "event_type": F.col("event_type")}, DAILY)
    days = stage(days, "sketches")
    months = {"key": F.date_trunc("month", "day").cast("timestamp_ntz"), "event_type": F.col("event_type")}
    return sk.estimates(sk.merged(days, months, DAILY), DAILY)


COARSE = {"users": Distinct("user_id", lg_k=11), "value": Quantiles("value", (5, 50, 95), k=200)}


@query(
    "sketch_error",
    "WITH e AS (SELECT count(*) AS rows, count(DISTINCT user_id) AS users FROM events WHERE value IS NOT NULL)"
    " SELECT rows, users, 0 AS users_off, 0 AS p5_off, 0 AS p50_off, 0 AS p95_off FROM e",
)
def sketch_error(spark, sf):
    """Coarse sketches of all events beside the exact figures: by how many
    stated errors the count and the ranks are off, whole ones, four at least."""
    events = t.load(spark, sf, "events").where("value IS NOT NULL")
    found = sk.estimates(sk.merged(sk.sketched(events, {"day": _day()}, COARSE), {}, COARSE), COARSE)
    guess = found.select(F.struct("*")).scalar()
    exact = events.select("user_id", "value", guess.alias("g"))
    below = {p: F.sum((F.col("value") <= F.col(f"g.value_p{p}")).cast("long")) for p in (5, 50, 95)}
    sums = exact.agg(
        F.count("*").alias("rows"), F.count_distinct("user_id").alias("users"), F.any_value("g").alias("g"),
        *[c.alias(f"below{p}") for p, c in below.items()],
    )
    off = lambda found, true, error: F.floor(F.abs(found - true) / (4 * error)).cast("int")
    ranks = [off(F.col(f"below{p}"), F.col("rows") * p / 100, F.col("rows") * COARSE["value"].error).alias(f"p{p}_off") for p in (5, 50, 95)]
    users = off(F.col("g.users"), F.col("users"), F.col("users") * COARSE["users"].error).alias("users_off")
    return sums.select("rows", "users", users, *ranks)


PERCENTS = (1, 5, 25, 50, 75, 95, 99, 99.9)


@query(
    "agg_percentiles",
    "SELECT "
    + ", ".join(
        f"round(quantile_cont(l_extendedprice, {x / 100}), 4) AS p_{m.percent_label(x)}" for x in PERCENTS
    )
    + " FROM lineitem",
)
def agg_percentiles(spark, sf):
    found = m.exact_percentiles(lineitem(spark, sf), "l_extendedprice", *PERCENTS)
    return rounded(found, *found.columns)


# Percent of rows that the sketch may be off by.
SLACK = 0.05


@query(
    "agg_percentiles_approx",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS INTEGER) AS percent, quantile_disc(l_extendedprice, {(p - SLACK) / 100:.6f}) AS least,"
        f" quantile_disc(l_extendedprice, {(p + SLACK) / 100:.6f}) AS most, true AS near FROM lineitem"
        for p in m.DEFAULT_PERCENTS
    ),
)
def agg_percentiles_approx(spark, sf):
    """Default percentiles from the sketch, each between the exact ones just
    below and above it."""
    c = lineitem(spark, sf)
    found = m.aggregate(c, {"p": m.percentiles("l_extendedprice")}).select(F.struct("*").alias("p")).scalar()
    sides = {p: (round(p - SLACK, 4), round(p + SLACK, 4)) for p in m.DEFAULT_PERCENTS}
    exact = m.discrete_percentiles(c, "l_extendedprice", *[x for pair in sides.values() for x in pair], name="e")
    at = lambda x: F.col(f"e_{m.percent_label(x)}")
    ends = {p: F.struct(at(low).alias("least"), at(high).alias("most")) for p, (low, high) in sides.items()}
    row = exact.select(*[e.alias(f"e{p}") for p, e in ends.items()]).withColumn("p", found)
    each = [
        F.struct(
            F.lit(p).alias("percent"),
            F.col(f"e{p}.least").alias("least"),
            F.col(f"e{p}.most").alias("most"),
            F.col("p")[f"p_{p}"].between(F.col(f"e{p}.least"), F.col(f"e{p}.most")).alias("near"),
        )
        for p in m.DEFAULT_PERCENTS
    ]
    return row.select(F.inline(F.array(*each)))


# --- buckets --------------------------------------------------------------


@query(
    "agg_terms",
    f"WITH {PRODUCTS}, g AS (SELECT brand AS key, count(*) AS doc_count, round(avg(price), 4) AS price FROM products GROUP BY brand),"
    " top AS (SELECT * FROM g ORDER BY doc_count DESC, key LIMIT 5)"
    " SELECT *, CAST((SELECT count(*) FROM products) - sum(doc_count) OVER () AS BIGINT) AS sum_other_doc_count FROM top",
)
def agg_terms(spark, sf):
    found = b.buckets(t.products(spark, sf), b.Terms("brand", 5), {"price": m.avg("price")})
    return rounded(found, "price")


@query(
    "agg_terms_list",
    f"WITH {PRODUCTS}, e AS (SELECT _id, unnest(list_distinct(tags)) AS key FROM products),"
    " g AS (SELECT key, count(*) AS doc_count FROM e GROUP BY key), top AS (SELECT * FROM g ORDER BY doc_count DESC, key LIMIT 8)"
    " SELECT *, CAST((SELECT count(*) FROM e) - sum(doc_count) OVER () AS BIGINT) AS sum_other_doc_count FROM top",
)
def agg_terms_list(spark, sf):
    return b.buckets(t.products(spark, sf), b.Terms("tags", 8))


@query(
    "agg_terms_order",
    "WITH g AS (SELECT l_suppkey AS key, count(*) AS doc_count, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1),"
    " top AS (SELECT * FROM g ORDER BY revenue DESC, key LIMIT 12)"
    " SELECT *, CAST((SELECT count(*) FROM lineitem) - sum(doc_count) OVER () AS BIGINT) AS sum_other_doc_count FROM top",
)
def agg_terms_order(spark, sf):
    spec = b.Terms("l_suppkey", 12, order_by="revenue")
    found = b.buckets(lineitem(spark, sf), spec, {"revenue": m.sum_of("l_extendedprice")})
    return found.withColumn("revenue", F.round("revenue", 2))


PRICE_STEPS = b.Histogram("o_totalprice", 2500)


@query(
    "agg_histogram",
    "WITH g AS (SELECT CAST(floor(o_totalprice / 2500) AS BIGINT) AS k, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1),"
    " s AS (SELECT unnest(range((SELECT min(k) FROM g), (SELECT max(k) FROM g) + 1)) AS k)"
    " SELECT CAST(k * 2500.0 AS DOUBLE) AS key, coalesce(n, 0) AS doc_count, top FROM s LEFT JOIN g USING (k)",
)
def agg_histogram(spark, sf):
    return b.buckets(t.orders(spark, sf), PRICE_STEPS, {"top": m.max_of("o_totalprice")})


def calendar_sql(unit: str, table: str, column: str, step: str) -> str:
    return (
        f"WITH g AS (SELECT CAST(date_trunc('{unit}', {column}) AS TIMESTAMP) AS key, count(*) AS n FROM {table} GROUP BY 1),"
        f" s AS (SELECT unnest(generate_series((SELECT min(key) FROM g), (SELECT max(key) FROM g), INTERVAL {step})) AS key)"
        " SELECT key, coalesce(n, 0) AS doc_count FROM s LEFT JOIN g USING (key)"
    )


for _name, _interval, _unit, _step in (
    ("agg_date_histogram", "1M", "month", "1 MONTH"),
    ("agg_date_histogram_week", "1w", "week", "7 DAYS"),
    ("agg_date_histogram_quarter", "1q", "quarter", "3 MONTHS"),
    ("agg_date_histogram_year", "1y", "year", "1 YEAR"),
    ("agg_date_histogram_day", "1d", "day", "1 DAY"),
):
    query(_name, calendar_sql(_unit, "orders", "o_orderdate", _step))(
        lambda spark, sf, i=_interval: b.buckets(t.orders(spark, sf), b.DateHistogram("o_orderdate", i))
    )


@query(
    "agg_date_histogram_fixed",
    "WITH g AS (SELECT epoch_us(ts) // 900000000 AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1),"
    " s AS (SELECT unnest(range((SELECT min(k) FROM g), (SELECT max(k) FROM g) + 1)) AS k)"
    " SELECT make_timestamp(k * 900000000) AS key, coalesce(n, 0) AS doc_count, total FROM s LEFT JOIN g USING (k)",
)
def agg_date_histogram_fixed(spark, sf):
    spec = b.FixedDateHistogram("ts", "15m")
    return rounded(b.buckets(t.events(spark, sf), spec, {"total": m.sum_of("value")}), "total")


def cases_sql(table: str, cases: dict[str, str], metrics: str = "", prefix: str = "") -> str:
    parts = [
        f"SELECT '{key}' AS key, count(*) FILTER ({test}) AS doc_count{metrics.format(test=test)} FROM {table}"
        for key, test in cases.items()
    ]
    return prefix + " UNION ALL ".join(parts)


@query(
    "agg_range",
    cases_sql(
        "orders",
        {
            "*-50000": "o_totalprice < 50000",
            "50000-150000": "o_totalprice >= 50000 AND o_totalprice < 150000",
            "100000-300000": "o_totalprice >= 100000 AND o_totalprice < 300000",
            "big": "o_totalprice >= 300000",
            "900000-*": "o_totalprice >= 900000",
        },
        ", round(avg(o_totalprice) FILTER ({test}), 4) AS price",
    ),
)
def agg_range(spark, sf):
    spec = b.ranges(
        "o_totalprice",
        {"to": 50000},
        {"from": 50000, "to": 150000},
        {"from": 100000, "to": 300000},
        {"key": "big", "from": 300000},
        {"from": 900000},
    )
    return rounded(b.buckets(t.orders(spark, sf), spec, {"price": m.avg("o_totalprice")}), "price")


@query(
    "agg_date_range",
    cases_sql(
        "orders",
        {
            "last_week": "o_orderdate >= TIMESTAMP '1998-05-25' AND o_orderdate < TIMESTAMP '1998-06-01 12:00:00'",
            "last_months": "o_orderdate >= TIMESTAMP '1998-04-01' AND o_orderdate < TIMESTAMP '1998-06-01'",
            "*-1995-01-01": "o_orderdate < TIMESTAMP '1995-01-01'",
        },
    ),
)
def agg_date_range(spark, sf):
    spec = b.date_ranges(
        "o_orderdate",
        {"key": "last_week", "from": "now-7d/d", "to": "now"},
        {"key": "last_months", "from": "now-2M/M", "to": "now/M"},
        {"to": "1995-01-01"},
        now=dt.datetime(1998, 6, 1, 12),
    )
    return b.buckets(t.orders(spark, sf), spec)


@query(
    "agg_filter",
    "SELECT count(*) AS doc_count, round(avg(o_totalprice), 4) AS price FROM orders WHERE o_orderstatus = 'F'",
)
def agg_filter(spark, sf):
    found = b.filter_bucket(t.orders(spark, sf), q.term("o_orderstatus", "F"), {"price": m.avg("o_totalprice")})
    return rounded(found, "price")


@query(
    "agg_filters",
    cases_sql(
        "orders",
        {
            "finished": "o_orderstatus = 'F'",
            "urgent": "o_orderpriority = '1-URGENT'",
            "large": "o_totalprice >= 400000 AND NOT o_orderstatus = 'P'",
        },
        ", round(sum(o_totalprice) FILTER ({test}), 2) AS revenue",
    ),
)
def agg_filters(spark, sf):
    spec = b.Filters(
        {
            "finished": q.term("o_orderstatus", "F"),
            "urgent": q.term("o_orderpriority", "1-URGENT"),
            "large": q.all_of(q.between("o_totalprice", gte=400000), ~q.term("o_orderstatus", "P")),
        }
    )
    found = b.buckets(t.orders(spark, sf), spec, {"revenue": m.sum_of("o_totalprice")})
    return found.withColumn("revenue", F.round("revenue", 2))


@query(
    "agg_missing",
    f"WITH {PRODUCTS} SELECT count(*) AS doc_count, round(avg(price), 4) AS price FROM products WHERE rating IS NULL",
)
def agg_missing(spark, sf):
    return rounded(b.missing(t.products(spark, sf), "rating", {"price": m.avg("price")}), "price")


# --- nested buckets -------------------------------------------------------


@query(
    "sub_agg_metric",
    "SELECT l_returnflag AS flag, count(*) AS flag_count, round(avg(l_extendedprice), 4) AS flag_price,"
    " round(sum(l_quantity), 4) AS flag_quantity_sum, min(l_quantity) AS flag_quantity_min,"
    " max(l_quantity) AS flag_quantity_max, round(avg(l_quantity), 4) AS flag_quantity_avg,"
    " count(l_quantity) AS flag_quantity_count FROM lineitem GROUP BY 1",
)
def sub_agg_metric(spark, sf):
    metrics = {"price": m.avg("l_extendedprice"), "quantity": m.stats("l_quantity")}
    found = b.nested_buckets(lineitem(spark, sf), [b.Level("flag", b.Terms("l_returnflag"), metrics)])
    return rounded(found, "flag_price", "flag_quantity_sum", "flag_quantity_avg")


@query(
    "sub_agg_terms_in_terms",
    f"""WITH {PRODUCTS},
      one AS (SELECT category, count(*) AS n, avg(price) AS price FROM products GROUP BY 1 ORDER BY n DESC, category LIMIT 3),
      two AS (SELECT category, brand, count(*) AS n, max(price) AS top FROM products GROUP BY 1, 2),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, brand) AS r FROM two)
      SELECT category, one.n AS category_count, round(one.price, 4) AS category_price, brand, ranked.n AS brand_count,
        top AS brand_top FROM ranked JOIN one USING (category) WHERE r <= 4""",
)
def sub_agg_terms_in_terms(spark, sf):
    levels = [
        b.Level("category", b.Terms("category", 3), {"price": m.avg("price")}),
        b.Level("brand", b.Terms("brand", 4), {"top": m.max_of("price")}),
    ]
    return rounded(b.nested_buckets(t.products(spark, sf), levels), "category_price")


@query(
    "sub_agg_in_date_histogram",
    """WITH g AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, count(*) AS n,
        round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1),
      two AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, o_orderpriority AS priority, count(*) AS n
        FROM orders GROUP BY 1, 2),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY n DESC, priority) AS r FROM two)
      SELECT month, g.n AS month_count, revenue AS month_revenue, priority, ranked.n AS priority_count
      FROM ranked JOIN g USING (month) WHERE r <= 2""",
)
def sub_agg_in_date_histogram(spark, sf):
    levels = [
        b.Level("month", b.DateHistogram("o_orderdate", "1M"), {"revenue": m.sum_of("o_totalprice")}),
        b.Level("priority", b.Terms("o_orderpriority", 2)),
    ]
    found = b.nested_buckets(t.orders(spark, sf), levels)
    return found.withColumn("month_revenue", F.round("month_revenue", 2))


@query(
    "sub_agg_histogram_in_terms",
    """WITH one AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3),
      two AS (SELECT event_type, CAST(floor(value / 20) AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2),
      ends AS (SELECT event_type, min(k) AS lo, max(k) AS hi FROM two GROUP BY 1),
      spine AS (SELECT event_type, unnest(range(lo, hi + 1)) AS k FROM ends)
      SELECT event_type AS kind, one.n AS kind_count, CAST(k * 20.0 AS DOUBLE) AS value, coalesce(two.n, 0) AS value_count
      FROM spine JOIN one USING (event_type) LEFT JOIN two USING (event_type, k)""",
)
def sub_agg_histogram_in_terms(spark, sf):
    levels = [b.Level("kind", b.Terms("event_type", 3)), b.Level("value", b.Histogram("value", 20))]
    return b.nested_buckets(t.events(spark, sf), levels)


@query(
    "sub_agg_list_in_range",
    f"""WITH {PRODUCTS},
      r AS (SELECT *, unnest(list_filter([CASE WHEN price < 1000 THEN 'low' END, CASE WHEN price >= 950 THEN 'high' END],
        lambda x: x IS NOT NULL)) AS band FROM products),
      one AS (SELECT band, count(*) AS n FROM r GROUP BY 1),
      e AS (SELECT band, unnest(list_distinct(tags)) AS tag, price FROM r),
      two AS (SELECT band, tag, count(*) AS n, round(avg(price), 4) AS price FROM e GROUP BY 1, 2),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY n DESC, tag) AS rk FROM two)
      SELECT band, one.n AS band_count, tag, ranked.n AS tag_count, price AS tag_price FROM ranked JOIN one USING (band) WHERE rk <= 5""",
)
def sub_agg_list_in_range(spark, sf):
    bands = b.ranges("price", {"key": "low", "to": 1000}, {"key": "high", "from": 950})
    levels = [b.Level("band", bands), b.Level("tag", b.Terms("tags", 5), {"price": m.avg("price")})]
    return rounded(b.nested_buckets(t.products(spark, sf), levels), "tag_price")


@query(
    "agg_terms_large",
    "WITH g AS (SELECT l_orderkey AS key, count(*) AS doc_count FROM lineitem GROUP BY 1),"
    " s AS (SELECT * FROM g ORDER BY doc_count DESC, key LIMIT 12000)"
    " SELECT *, CAST((SELECT sum(doc_count) FROM g) - (SELECT sum(doc_count) FROM s) AS BIGINT) AS sum_other_doc_count FROM s",
)
def agg_terms_large(spark, sf):
    """More buckets than one task keeps."""
    return b.buckets(lineitem(spark, sf), b.Terms("l_orderkey", 12_000))


EVENT_R = "CASE WHEN event_type <> 'click' THEN value END"


def partly_measured(spark, sf) -> Collection:
    """Events; those of one type have no value in ``r`` and no ``who``."""
    c = t.events(spark, sf)
    measured = F.col("event_type") != "click"
    columns = {"r": F.when(measured, F.col("value")), "who": F.when(measured, F.col("user_id") % 7)}
    return c.with_df(c.df.withColumns(columns))


@query(
    "sub_agg_null_parent_metric",
    f"""WITH one AS (SELECT event_type, count(*) AS n, round(avg({EVENT_R}), 4) AS r FROM events GROUP BY 1),
      two AS (SELECT event_type, CAST(floor(value / 20) AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2),
      spine AS (SELECT event_type, unnest(range(min(k), max(k) + 1)) AS k FROM two GROUP BY 1)
      SELECT event_type AS kind, one.n AS kind_count, r AS kind_r, CAST(k * 20.0 AS DOUBLE) AS value,
        coalesce(two.n, 0) AS value_count FROM spine JOIN one USING (event_type) LEFT JOIN two USING (event_type, k)""",
)
def sub_agg_null_parent_metric(spark, sf):
    levels = [b.Level("kind", b.Terms("event_type"), {"r": m.avg("r")}), b.Level("value", b.Histogram("value", 20))]
    return rounded(b.nested_buckets(partly_measured(spark, sf), levels), "kind_r")


@query(
    "sub_agg_same_metric_name",
    """WITH one AS (SELECT l_returnflag AS flag, count(*) AS n, round(avg(l_quantity), 4) AS m FROM lineitem GROUP BY 1)
      SELECT flag, one.n AS flag_count, one.m AS flag_m, l_linestatus AS status, count(*) AS status_count,
        max(l_extendedprice) AS status_m FROM lineitem JOIN one ON l_returnflag = flag GROUP BY ALL""",
)
def sub_agg_same_metric_name(spark, sf):
    levels = [
        b.Level("flag", b.Terms("l_returnflag"), {"m": m.avg("l_quantity")}),
        b.Level("status", b.Terms("l_linestatus"), {"m": m.max_of("l_extendedprice")}),
    ]
    return rounded(b.nested_buckets(lineitem(spark, sf), levels), "flag_m")


@query(
    "sub_agg_empty_ranges",
    f"""WITH {PRODUCTS},
      one AS (SELECT category, count(*) AS n FROM products GROUP BY 1 ORDER BY n DESC, category LIMIT 3)
      SELECT category, one.n AS category_count, band,
        (SELECT count(*) FROM products p WHERE p.category = one.category AND p.price >= lo AND p.price < hi) AS band_count
      FROM one, (VALUES ('low', 0, 950), ('mid', 940, 1000), ('none', 5000, 9000)) AS v(band, lo, hi)""",
)
def sub_agg_empty_ranges(spark, sf):
    bands = b.ranges(
        "price", {"key": "low", "from": 0, "to": 950}, {"key": "mid", "from": 940, "to": 1000},
        {"key": "none", "from": 5000, "to": 9000},
    )
    return b.nested_buckets(t.products(spark, sf), [b.Level("category", b.Terms("category", 3)), b.Level("band", bands)])


@query(
    "sub_agg_childless_parent",
    """WITH one AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
      two AS (SELECT event_type, user_id % 7 AS who, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1, 2),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, who) AS r FROM two)
      SELECT event_type AS kind, one.n AS kind_count, who, coalesce(ranked.n, 0) AS who_count
      FROM one LEFT JOIN (SELECT * FROM ranked WHERE r <= 3) ranked USING (event_type)""",
)
def sub_agg_childless_parent(spark, sf):
    levels = [b.Level("kind", b.Terms("event_type")), b.Level("who", b.Terms("who", 3))]
    return b.nested_buckets(partly_measured(spark, sf), levels)


@query(
    "sub_agg_terms_in_filled_histogram",
    f"""WITH {PRODUCTS}, p AS (SELECT *, views // 5 AS k FROM products WHERE views < 10 OR views > 30),
      spine AS (SELECT unnest(range(min(k), max(k) + 1)) AS k FROM p),
      one AS (SELECT k, count(*) AS n FROM p GROUP BY 1),
      two AS (SELECT k, brand, count(*) AS n FROM p GROUP BY 1, 2),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, brand) AS r FROM two)
      SELECT CAST(k * 5.0 AS DOUBLE) AS views, coalesce(one.n, 0) AS views_count, brand, coalesce(ranked.n, 0) AS brand_count
      FROM spine LEFT JOIN one USING (k) LEFT JOIN (SELECT * FROM ranked WHERE r <= 2) ranked USING (k)""",
)
def sub_agg_terms_in_filled_histogram(spark, sf):
    levels = [b.Level("views", b.Histogram("views", 5)), b.Level("brand", b.Terms("brand", 2))]
    condition = q.between("views", lt=10) | q.between("views", gt=30)
    return b.nested_buckets(t.products(spark, sf), levels, condition)


# --- geo ------------------------------------------------------------------


@query(
    "agg_geo_bounds",
    f"WITH {PRODUCTS} SELECT max(lat) AS box_top, min(lon) AS box_left, min(lat) AS box_bottom, max(lon) AS box_right FROM products",
)
def agg_geo_bounds(spark, sf):
    return m.aggregate(t.products(spark, sf), {"box": m.geo_bounds("location")})


@query(
    "agg_geo_centroid",
    f"WITH {PRODUCTS} SELECT round(avg(lat), 4) AS c_lat, round(avg(lon), 4) AS c_lon, count(lat) AS c_count FROM products",
)
def agg_geo_centroid(spark, sf):
    return rounded(m.aggregate(t.products(spark, sf), {"c": m.geo_centroid("location")}), "c_lat", "c_lon")


DISTANCE = HAVERSINE.format(lat=10.0, lon=20.0)


@query(
    "agg_geo_distance",
    cases_sql(
        "products",
        {
            "*-2000000": f"{DISTANCE} < 2000000",
            "2000000-8000000": f"{DISTANCE} >= 2000000 AND {DISTANCE} < 8000000",
            "far": f"{DISTANCE} >= 8000000",
        },
        prefix=f"WITH {PRODUCTS} ",
    ),
)
def agg_geo_distance(spark, sf):
    rings = b.geo_rings(
        "location", (10.0, 20.0), {"to": 2000000}, {"from": 2000000, "to": 8000000}, {"key": "far", "from": "8000km"}
    )
    return b.buckets(t.products(spark, sf), rings)


# --- pipelines ------------------------------------------------------------

MONTHLY = b.DateHistogram("o_orderdate", "1M")
MONTHS_SQL = (
    "WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS key, count(*) AS doc_count,"
    " sum(o_totalprice) AS revenue FROM orders GROUP BY 1) "
)


def monthly(spark, sf):
    return b.buckets(t.orders(spark, sf), MONTHLY, {"revenue": m.sum_of("o_totalprice")})


@query("avg_bucket", MONTHS_SQL + "SELECT round(avg(revenue), 6) AS value FROM m")
def avg_bucket(spark, sf):
    return p.avg_bucket(monthly(spark, sf), "revenue").withColumn("value", F.round("value", 6))


@query("sum_bucket", MONTHS_SQL + "SELECT round(sum(revenue), 2) AS value FROM m")
def sum_bucket(spark, sf):
    return p.sum_bucket(monthly(spark, sf), "revenue").withColumn("value", F.round("value", 2))


@query("max_bucket", MONTHS_SQL + "SELECT key, doc_count AS value FROM m WHERE doc_count = (SELECT max(doc_count) FROM m)")
def max_bucket(spark, sf):
    return p.max_bucket(monthly(spark, sf))


@query("min_bucket", MONTHS_SQL + "SELECT key, doc_count AS value FROM m WHERE doc_count = (SELECT min(doc_count) FROM m)")
def min_bucket(spark, sf):
    return p.min_bucket(monthly(spark, sf))


@query(
    "moving_avg",
    MONTHS_SQL + "SELECT key, round(avg(revenue) OVER (ORDER BY key ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 4) AS value FROM m",
)
def moving_avg(spark, sf):
    found = p.moving_avg(monthly(spark, sf), "revenue", 6, MONTHLY)
    return rounded(found.select("key", "value"), "value")


@query("derivative", MONTHS_SQL + "SELECT key, round(revenue - lag(revenue) OVER (ORDER BY key), 2) AS value FROM m")
def derivative(spark, sf):
    found = p.derivative(monthly(spark, sf), "revenue", MONTHLY).select("key", "value")
    return found.withColumn("value", F.round("value", 2))


@query("cumulative_sum", MONTHS_SQL + "SELECT key, CAST(sum(doc_count) OVER (ORDER BY key) AS BIGINT) AS value FROM m")
def cumulative_sum(spark, sf):
    return p.cumulative_sum(monthly(spark, sf), "doc_count", MONTHLY).select("key", "value")
