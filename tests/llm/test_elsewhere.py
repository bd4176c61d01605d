"""Queries whose executors have no copy of the repository: the driver knows its
path, Python workers start in another folder and get the code with the task."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from siftframe.session import tuned

builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
spark = tuned(builder).getOrCreate()
spark.sparkContext.setLogLevel("OFF")


def there(_):
    import importlib.util

    return [importlib.util.find_spec("siftframe") is not None]


assert spark.sparkContext.parallelize([0], 1).mapPartitions(there).collect() == [False]

from siftframe.llm.queries import QUERIES
import corpus_pipeline

for name, query in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    n = query(spark, "/root/testdata/sf0.001").count()
    print("ran", name, n, flush=True)
"""


def test_every_query_runs_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    kept = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not Path(p).resolve().is_relative_to(REPO)]
    if kept:
        env["PYTHONPATH"] = os.pathsep.join(kept)
    script = tmp_path / "elsewhere.py"
    script.write_text(SCRIPT.format(repo=str(REPO)))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False)
    assert done.returncode == 0, done.stdout + done.stderr[-3000:]
    from siftframe.llm.queries import QUERIES

    assert sum(line.startswith("ran ") for line in done.stdout.splitlines()) == len(QUERIES) + 1
