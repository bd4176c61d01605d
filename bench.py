"""Headline queries: seconds per query, as one JSON line.

Every query is written to Spark's no-op sink, so all rows and columns are
computed. One run warms up; the median of three follows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from catalog import QUERIES  # noqa: E402
from siftframe.session import tuned  # noqa: E402

HEADLINE = (
    "bool_query match match_phrase fuzzy geo_distance nested min_should_match highlight "
    "bm25 bm25_batch term_stats postings sort top_k page_deep search_after scroll_export mget "
    "analyze_custom analyze_full tf_porter_stem tf_dictionary "
    "agg_with_query agg_stats agg_cardinality agg_percentiles agg_terms agg_terms_order agg_histogram "
    "agg_date_histogram agg_date_histogram_fixed agg_range agg_filters sub_agg_terms_in_terms sub_agg_in_date_histogram "
    "agg_geo_distance moving_avg cumulative_sum bulk_mixed bulk_mixed_items update_by_query delete_by_query "
    "apply_mapping stream_bulk stream_date_histogram"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    builder = builder.config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
    spark = tuned(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
