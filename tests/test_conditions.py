"""Boolean logic, null and list behaviour of every leaf."""

import pytest
from pyspark.sql import functions as F

from siftframe import Collection, Field, Mapping
from siftframe.operators.search import count, search
from siftframe.plans import conditions as q

SHOP = Mapping(
    {
        "title": Field("text"),
        "content": Field("text"),
        "category": Field("keyword"),
        "tags": Field("keyword"),
        "price": Field("double"),
        "views": Field("integer"),
        "published": Field("boolean"),
        "location": Field("geo_point"),
        "hidden": Field("keyword", index=False),
    }
)
ROWS = [
    ("1", "Red running shoes", "Light and fast", "sport", ["red", "new"], 80.0, 5, True, (48.85, 2.35), "x"),
    ("2", "Blue shoes", "For running", "sport", ["blue"], 120.0, 50, True, (51.5, -0.12), "x"),
    ("3", "Refurbished phone", None, "electronics", [], 300.0, None, False, None, "x"),
    ("4", "Phone case, red", "Fits a phone", "electronics", None, 15.0, 7, True, (0.0, 179.9), "x"),
    ("5", None, "nothing here", None, ["red", "sale"], None, 0, None, (0.0, -179.9), "x"),
]
SCHEMA = (
    "_id string, title string, content string, category string, tags array<string>, price double, views int,"
    " published boolean, location struct<lat:double,lon:double>, hidden string"
)


@pytest.fixture(scope="module")
def shop(spark):
    return Collection(spark.createDataFrame(ROWS, SCHEMA), SHOP)


def found(c, condition):
    rows = search(c, condition, sort=[], size=None, source=["_id"]).collect()
    return "".join(sorted(r["_id"] for r in rows))


LEAVES = [
    (q.match("title", "RED phone"), "134"),
    (q.match("category", "sport"), "12"),
    (q.match("title", "..."), ""),
    (q.match_phrase("title", "running shoes"), "1"),
    (q.match_phrase("title", "shoes running"), ""),
    (q.match_phrase("title", "phone case red"), "4"),
    (q.multi_match("running", "title", "content"), "12"),
    (q.term("category", "sport"), "12"),
    (q.term("tags", "red"), "15"),
    (q.term("title", "red"), "14"),
    (q.term("title", "Red"), ""),
    (q.term("published", True), "124"),
    (q.terms("tags", "blue", "sale"), "25"),
    (q.terms("category", "sport", "food"), "12"),
    (q.between("price", 80, 120), "12"),
    (q.between("price", gt=80, lt=300), "2"),
    (q.between("price"), "1234"),
    (q.exists("tags"), "125"),
    (q.exists("views"), "1245"),
    (q.ids("1", "5", "9"), "15"),
    (q.wildcard("category", "elec*"), "34"),
    (q.wildcard("title", "sho?s"), "12"),
    (q.wildcard("tags", "sal?"), "5"),
    (q.prefix("title", "run"), "1"),
    (q.prefix("tags", "re"), "15"),
    (q.regexp("category", "s.*t"), "12"),
    (q.regexp("category", "port"), ""),
    (q.fuzzy("tags", "rad"), "15"),
    (q.fuzzy("title", "phonne"), "34"),
    (q.fuzzy("category", "sprot", 1), ""),
    (q.fuzzy("category", "sprot", 2), "12"),
    (q.geo_distance("location", 48.85, 2.35, "400km"), "12"),
    (q.geo_distance("location", 0.0, 180.0, "50km"), "45"),
    (q.geo_bounding_box("location", 52, -1, 48, 3), "12"),
    (q.geo_bounding_box("location", 10, 179, -10, -179), "45"),
    (q.match_all(), "12345"),
    (q.keyword_query(q.every(q.some("red", "blue"), "shoes"), "title"), "12"),
    (q.keyword_query("running"), "12"),
    (q.keyword_query(q.every("phone", q.without("refurbished")), "title"), "4"),
]


@pytest.mark.parametrize("number", range(len(LEAVES)))
def test_leaf_and_its_negation(shop, number):
    condition, expected = LEAVES[number]
    assert found(shop, condition) == expected
    # A row is either found or not, also when the field is missing.
    rest = "".join(i for i in "12345" if i not in expected)
    assert found(shop, ~condition) == rest
    assert found(shop, ~~condition) == expected


def test_must_filter_should(shop):
    sport = q.term("category", "sport")
    assert found(shop, q.Bool(filter=(sport,), should=(q.term("tags", "red"),))) == "12"
    assert found(shop, q.Bool(should=(sport, q.term("tags", "sale")))) == "125"
    assert found(shop, q.any_of(q.all_of(sport, q.between("price", lt=100)), q.term("tags", "sale"))) == "15"


def test_minimum_should_match_rules():
    assert q.required_matches(2, 4) == 2
    assert q.required_matches(-1, 4) == 3
    assert q.required_matches("75%", 4) == 3
    assert q.required_matches("75%", 3) == 2
    assert q.required_matches("-25%", 4) == 3
    assert q.required_matches("-25%", 3) == 3
    assert q.required_matches("2<75%", 2) == 2
    assert q.required_matches("2<75%", 4) == 3
    assert q.required_matches("2<-25% 9<-3", 12) == 9


def test_minimum_above_number_of_clauses_matches_nothing(shop):
    assert found(shop, q.any_of(q.term("category", "sport"), min_match=2)) == ""


def test_not_searchable_and_unknown_fields(shop):
    with pytest.raises(ValueError):
        found(shop, q.term("hidden", "x"))
    with pytest.raises(ValueError):
        found(shop, q.term("nope", "x"))


def test_long_lists_become_joins(shop):
    values = ["sport"] + [f"v{i}" for i in range(2000)]
    condition = q.all_of(q.terms("category", *values))
    assert found(shop, condition) == "12"
    assert found(shop, q.none_of(q.terms("category", *values))) == "345"
    assert found(shop, q.any_of(q.terms("category", *values), q.term("tags", "sale"))) == "125"
    plan = q.where(shop.df, condition, shop.scope)._jdf.queryExecution().toString()
    assert "LeftSemi" in plan


def test_columns_stand_in_for_conditions(shop):
    cheap = F.col("price") < 100
    assert found(shop, cheap) == "14"
    assert found(shop, q.all_of(cheap, q.term("category", "sport"))) == "1"
    assert found(shop, q.none_of(cheap)) == "235"
    assert count(shop, cheap).head()["count"] == 2


def test_table_of_values(spark, shop):
    listed = spark.createDataFrame([("sport",), (None,)], "v string")
    assert found(shop, q.all_of(q.terms("category", listed))) == "12"
    assert found(shop, q.none_of(q.terms("category", listed))) == "345"


# The well-known small cases of boolean searching, with their exact counts.


def table(spark, column, type_, values, mapping="keyword"):
    rows = [(str(i), v) for i, v in enumerate(values)]
    return Collection(spark.createDataFrame(rows, f"_id string, {column} {type_}"), Mapping({column: Field(mapping)}))


def counted(c, condition):
    return count(c, condition).head()["count"]


def test_match_should_on_keywords(spark):
    c = table(spark, "category", "string", ["phone", "laptop", "tablet", "watch"])
    three = q.any_of(*[q.match("category", v) for v in ("phone", "laptop", "tablet")])
    assert counted(c, three) == 3


def test_term_should(spark):
    c = table(spark, "brand", "string", ["Apple", "Samsung", "Huawei", "Xiaomi"])
    assert counted(c, q.Bool(should=(q.term("brand", "Apple"), q.term("brand", "Samsung")))) == 2


def test_range_should(spark):
    c = table(spark, "price", "double", [100.0, 500.0, 1500.0, 2500.0], "float")
    assert counted(c, q.any_of(q.between("price", 0, 300), q.between("price", 1000, 2000))) == 2


def test_minimum_match_one_and_two(spark):
    c = table(spark, "tag", "string", ["new", "hot", "new", "hot"])
    both = (q.term("tag", "new"), q.term("tag", "hot"))
    assert counted(c, q.any_of(*both, min_match=1)) == 4
    assert counted(c, q.any_of(*both, min_match=2)) == 0


def test_must_not_kinds(spark):
    titles = table(spark, "title", "string", ["new phone", "refurbished phone", "a case", "new laptop"], "text")
    assert counted(titles, ~q.match("title", "refurbished")) == 3
    states = table(spark, "status", "string", ["active", "deleted", "pending", "active"])
    assert counted(states, ~q.term("status", "deleted")) == 3
    ages = table(spark, "age", "int", [15, 25, 35, 45], "integer")
    assert counted(ages, ~q.between("age", lte=17)) == 3


def test_and_or_not_together(spark):
    rows = [
        ("1", "electronics", "active", "Apple", 999.0, "new phone"),
        ("2", "electronics", "active", "Samsung", 799.0, "new tablet"),
        ("3", "electronics", "active", "Apple", 599.0, "refurbished phone"),
        ("4", "electronics", "inactive", "Apple", 899.0, "old phone"),
        ("5", "clothing", "active", "Nike", 99.0, "shoes"),
    ]
    schema = "_id string, category string, status string, brand string, price double, title string"
    c = Collection(spark.createDataFrame(rows, schema), Mapping({"title": Field("text")}))
    condition = q.Bool(
        filter=(q.term("category", "electronics"), q.term("status", "active"), q.between("price", 500, 1500)),
        should=(q.term("brand", "Apple"), q.term("brand", "Samsung")),
        must_not=(q.match("title", "refurbished"),),
        minimum_should_match=1,
    )
    assert counted(c, condition) == 2


def test_nested_needs_one_element(spark):
    rows = [("1", [("a", 1), ("b", 9)]), ("2", [("a", 9)]), ("3", []), ("4", None)]
    df = spark.createDataFrame(rows, "_id string, items array<struct<name:string,n:int>>")
    c = Collection(df, Mapping({"items": Field("nested")}))
    both = q.term("items.name", "a") & q.between("items.n", gte=5)
    assert found(c, q.nested("items", both)) == "2"
    assert found(c, both) == "12"  # without nested, different elements may satisfy it
    assert found(c, ~q.nested("items", both)) == "134"
