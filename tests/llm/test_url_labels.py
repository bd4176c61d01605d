"""The URL model judges hosts that its labelled table does not hold."""

from pyspark.sql import functions as F

from siftframe.llm import queries, urls

SPAM = ("spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track")


def test_unlisted_hosts_are_judged_by_what_their_names_share(spark):
    listed = {*queries.BLOCKED_NAMES, *queries.ALLOWED_NAMES}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    model = urls.fit(queries.labelled_urls(spark))
    judged = urls.judge(pages, queries.URL_RULES, model)
    named = judged.withColumn("name", F.regexp_extract("host", r"([a-z-]+)\.example", 1)).select("name", "blocked_score").collect()
    assert not listed & {r["name"] for r in named}
    spam = [r["blocked_score"] >= 0.5 for r in named if r["name"] in SPAM]
    others = [r["blocked_score"] >= 0.5 for r in named if r["name"] not in SPAM]
    assert len(spam) > 5 and sum(spam) >= 0.9 * len(spam)
    assert len(others) > 100 and sum(others) <= 0.01 * len(others)
    for row in [("https://www.best-casino.example.org/x", True), ("https://gardenclub.example.net/news", False), (None, False)]:
        found = urls.judge(spark.createDataFrame([(1, row[0])], "page_id long, url string"), [], model).first()
        assert (found["verdict"] == "block") == row[1]
