"""Bulk operations against a sequential replay, and changes by condition."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from siftframe import Collection
from siftframe.operators import mutate as w
from siftframe.operators.search import search
from siftframe.plans import conditions as q
from siftframe.streaming import histogram, ingest

DOC = "name string, n int, user struct<city:string,address:struct<zip:string,street:string>>, tags array<string>"
TABLE = f"_id string, _version bigint, {DOC}"
OPS = f"seq bigint, action string, _id string, doc struct<{DOC.replace(' ', ':').replace(',:', ',')}>, set_fields array<string>"
LEAVES = ("name", "n", "user.city", "user.address.zip", "user.address.street", "tags")
NAMES = LEAVES + ("user", "user.address")


def random_doc(rng):
    text = lambda: rng.choice([None, "a", "b"])
    tags = rng.choice([None, [], ["t"]])
    return (text(), rng.choice([None, 1, 2]), (text(), (text(), text())), tags)


def random_ops(rng, count, ids, actions=w.ACTIONS):
    return [
        (i, rng.choice(actions), rng.choice(ids), random_doc(rng), rng.sample(NAMES, rng.randint(0, 3)))
        for i in range(count)
    ]


def leaves(doc):
    name, n, (city, (zip_, street)), tags = doc
    return dict(zip(LEAVES, (name, n, city, zip_, street, tags)))


def replay(table, ops):
    """One operation after the other on a dictionary."""
    docs = {i: (v, leaves((name, n, user, tags))) for i, v, name, n, user, tags in table}
    versions = {i: v for i, (v, _) in docs.items()}
    items = []
    for seq, action, i, doc, named in sorted(ops):
        have = i in docs
        new = leaves(doc)
        if action not in w.ACTIONS:
            items.append((seq, None, "error", 400))
        elif action == "create" and have:
            items.append((seq, None, "error", 409))
        elif action in ("update", "delete") and not have:
            items.append((seq, None, "not_found", 404))
        elif action == "delete":
            versions[i] += 1
            del docs[i]
            items.append((seq, versions[i], "deleted", 200))
        elif have and action in ("update", "upsert"):
            old = docs[i][1]
            carried = {p: v for p, v in new.items() if any(p == x or p.startswith(x + ".") for x in named)}
            merged = old | carried
            if merged == old:
                items.append((seq, versions[i], "noop", 200))
            else:
                versions[i] += 1
                docs[i] = (versions[i], merged)
                items.append((seq, versions[i], "updated", 200))
        else:
            versions[i] = versions.get(i, 0) + 1
            docs[i] = (versions[i], new)
            items.append((seq, versions[i], "updated" if have else "created", 200 if have else 201))
    return {(i, v, *map(str, d.values())) for i, (v, d) in docs.items()}, items


def observed(result):
    flat = result.table.select("_id", "_version", *[F.col(x).alias(x.replace(".", "_")) for x in LEAVES])
    table = {(r[0], r[1], *map(str, r[2:])) for r in flat.collect()}
    items = result.items.select("seq", "_version", "result", "status").orderBy("seq").collect()
    return table, [tuple(r) for r in items]


@pytest.mark.parametrize("seed, hot_ops", [(1, 100_000), (2, 100_000), (3, 6), (4, 25)])
def test_bulk_equals_replay(spark, seed, hot_ops):
    rng = random.Random(seed)
    ids = [str(i) for i in range(12)]
    start = [(i, rng.randint(1, 4), *random_doc(rng)) for i in ids[:7]]
    # One id takes a third of all operations.
    ops = random_ops(rng, 200, ids + ["3"] * 6, w.ACTIONS + ("bogus",))
    target = spark.createDataFrame(start, TABLE)
    result = w.bulk(target, spark.createDataFrame(ops, OPS).repartition(3), hot_ops=hot_ops)
    table, items = observed(result)
    want_table, want_items = replay(start, ops)
    assert items == want_items
    assert table == want_table


def test_create_create_delete(spark):
    doc = ("x", 1, ("c", ("z", "s")), [])
    ops = [(1, "create", "a", doc, []), (2, "create", "a", doc, []), (3, "delete", "a", doc, [])]
    result = w.bulk(spark.createDataFrame([], TABLE), spark.createDataFrame(ops, OPS))
    assert [r.status for r in result.items.orderBy("seq").collect()] == [201, 409, 200]
    assert result.table.count() == 0
    failed = w.failed_items(result.items).collect()
    assert [(r.seq, r.error) for r in failed] == [(2, "document already exists")]
    report = w.bulk_report(result.items).head()
    assert (report.total, report.succeeded, report.failed, report.has_errors) == (3, 2, 1, True)


def test_doc_may_lack_fields(spark):
    target = spark.createDataFrame([("a", 1, "x", 5)], "_id string, _version bigint, name string, n int")
    ops = spark.createDataFrame(
        [(1, "update", "a", (7,), ["n"]), (2, "index", "b", (8,), None)],
        "seq bigint, action string, _id string, doc struct<n:int>, set_fields array<string>",
    )
    rows = {tuple(r) for r in w.bulk(target, ops).table.collect()}
    assert rows == {("a", 2, "x", 7), ("b", 1, None, 8)}


def test_generated_ids_are_stable(spark):
    ops = spark.createDataFrame([(None, 1), ("x", 2), (None, 3)], "_id string, seq bigint")
    named = w.with_generated_ids(ops)
    first = {r.seq: r["_id"] for r in named.collect()}
    assert first == {r.seq: r["_id"] for r in named.collect()}
    assert first[2] == "x" and len(set(first.values())) == 3


def test_several_tables(spark):
    doc = ("x", 1, ("c", ("z", "s")), [])
    ops = spark.createDataFrame([(1, "index", "a", doc, []), (2, "index", "b", doc, [])], OPS)
    ops = ops.withColumn("_index", F.when(F.col("seq") == 1, "one"))
    empty = spark.createDataFrame([], TABLE)
    results = w.bulk_tables({"one": empty, "two": empty}, ops, default="two")
    assert [r["_id"] for r in results["one"].table.collect()] == ["a"]
    assert [r["_id"] for r in results["two"].table.collect()] == ["b"]
    with pytest.raises(ValueError):
        w.bulk_tables({"two": empty}, ops, default="two")


@pytest.fixture
def goods(spark):
    rows = [("1", 1, 100, 1.0), ("2", 1, 150, None), ("3", 1, None, 3.0)]
    return Collection(spark.createDataFrame(rows, "_id string, _version bigint, views int, price double"))


def test_update_by_query_counts_noops(goods):
    seen = Observation()
    changed = w.update_by_query(goods, q.exists("views"), {"views": 150}, observation=seen)
    assert {tuple(r) for r in changed.collect()} == {("1", 2, 150, 1.0), ("2", 1, 150, None), ("3", 1, None, 3.0)}
    assert seen.get == {"total": 2, "updated": 1, "noops": 1}


def test_script_update(goods):
    changed = w.script_update(goods, q.ids("1"), {"views": "views + 50", "discount": "price * 0.9"})
    rows = {r["_id"]: (r.views, r.discount) for r in changed.collect()}
    assert rows == {"1": (150, 0.9), "2": (150, None), "3": (None, None)}


def test_guards(goods):
    with pytest.raises(ValueError):
        w.update_by_query(goods, q.exists("views"), {})
    for empty in (None, q.match_all(), q.Bool()):
        with pytest.raises(ValueError):
            w.delete_by_query(goods, empty)


def test_delete_keeps_unknown(goods):
    left = w.delete_by_query(goods, q.between("price", gte=2.0))
    assert {r["_id"] for r in left.collect()} == {"1", "2"}
    both = w.delete_by_query(goods, q.exists("views") & q.between("price", lte=2.0))
    assert {r["_id"] for r in search(goods.with_df(both), sort=[]).collect()} == {"2", "3"}


def test_stream_of_batches(spark, tmp_path):
    """255 operations in batches of 50: five full batches and the rest."""
    rng = random.Random(9)
    ids = [str(i) for i in range(40)]
    start = [(i, 1, *random_doc(rng)) for i in ids[:15]]
    ops = random_ops(rng, 255, ids)
    for k in range(0, 255, 50):
        part = spark.createDataFrame(ops[k: k + 50], OPS).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    base = spark.createDataFrame(start, TABLE)
    stream = spark.readStream.schema(OPS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    log, seen = str(tmp_path / "log"), {}

    def on_batch(items, batch_id):
        seen[batch_id] = items.count()

    ingest.stream_bulk(stream, base, log, on_batch).awaitTermination()
    assert [seen[k] for k in sorted(seen)] == [50] * 5 + [5]
    want_table, want_items = replay(start, ops)
    result = w.BulkResult(ingest.current_table(spark, log), ingest.item_log(spark, log), None)
    assert observed(result) == (want_table, want_items)

    # A batch that comes again changes nothing; the states between are still there.
    store = ingest.Snapshots(spark, log)
    before = store.versions()
    ingest.apply_batch(store, spark.createDataFrame(ops[100:150], OPS), 2)
    assert store.versions() == before
    again = w.BulkResult(ingest.current_table(spark, log), ingest.item_log(spark, log), None)
    assert observed(again)[0] == want_table
    third = w.BulkResult(ingest.current_table(spark, log, before=3), result.items, None)
    assert observed(third)[0] == replay(start, ops[:150])[0]
    ingest.compact(store)
    assert len(store.pinned().folders("changes")) == 1
    compacted = w.BulkResult(ingest.current_table(spark, log), result.items, None)
    assert observed(compacted)[0] == want_table
    # Versions of deleted documents go on after a compaction.
    more = random_ops(rng, 40, ids)
    more = [(1000 + i, *op[1:]) for i, op in enumerate(more)]
    ingest.apply_batch(store, spark.createDataFrame(more, OPS), 6)
    last = w.BulkResult(ingest.current_table(spark, log), result.items, None)
    assert observed(last)[0] == replay(start, ops + more)[0]


def test_files_read_per_batch_stay_few_over_fifty_batches(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    base = spark.createDataFrame([(str(i), 1, *random_doc(rng)) for i in range(30)], TABLE)
    store = ingest.open_log(base, str(tmp_path / "log"), buckets=2)
    # What a batch does to the rows is tested above; here each writes one row anew.
    monkeypatch.setattr(ingest, "bulk", lambda state, ops, *a, **k: w.BulkResult(None, ops, _touched(state)))
    read, runs = [], []
    for k in range(50):
        now = store.pinned()
        read.append(len(now.read("changes").inputFiles()))
        runs.append(len(now.folders("changes")))
        batch = spark.createDataFrame([(k, "index", str(k % 30))], "seq long, action string, _id string")
        ingest.apply_batch(store, batch, k, fanout=4)
    assert max(runs[25:]) <= 1 + 3 * 3 and max(read[25:]) <= 2 * (1 + 3 * 3)
    assert max(read[40:]) <= max(read[:16]) + 6  # one more level in four times as many batches
    rows = {r["_id"]: r["_version"] for r in ingest.current_table(spark, store.root).collect()}
    assert rows == {str(i): 1 + len(range(i, 50, 30)) for i in range(30)}


def _touched(state):
    return state.withColumn("_version", F.col("_version") + 1).withColumn("_deleted", F.lit(False))


def test_stream_histogram_drops_and_counts_late_rows(spark, tmp_path):
    schema = "ts timestamp_ntz, kind string"
    parts = [
        ["2024-01-01 00:00:10", "2024-01-01 00:00:40"],
        ["2024-01-01 00:10:00"],
        ["2024-01-01 00:10:05"],
        ["2024-01-01 00:00:20", "2024-01-01 00:10:10"],
        ["2024-01-01 00:30:00"],
    ]
    for part in parts:
        rows = spark.createDataFrame([(x, "a") for x in part], "ts string, kind string")
        rows = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)
        rows.write.mode("append").parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    buckets = histogram.windowed_counts(events, "ts", "30s", ["kind"], watermark="2 minutes")
    run = histogram.write_closed(buckets, str(tmp_path / "out"), str(tmp_path / "state"))
    run.awaitTermination()
    got = {(str(r.key), r.doc_count) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:30", 1), ("2024-01-01 00:10:00", 3)}
    assert histogram.late_rows(run) == 1


def test_many_operations_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    import siftframe.operators.mutate as mutate

    monkeypatch.setattr(mutate, "TASK_OPS", 20)
    ops = spark.range(200).selectExpr(
        "id AS seq", "'index' AS action", "CAST(id % 70 AS STRING) AS _id", "named_struct('v', id) AS doc", "CAST(NULL AS ARRAY<STRING>) AS set_fields"
    )
    target = spark.range(100).selectExpr("CAST(id AS STRING) AS _id", "1L AS _version", "-id AS v")
    result = mutate.bulk(target, ops, staged=True)
    # Four shuffle partitions are set: one task for every 20 operations comes before them.
    assert mutate._Fold("_id", ops, 1000).rows.rdd.getNumPartitions() == 10
    assert mutate._Fold("_id", ops.limit(20), 1000).rows.rdd.getNumPartitions() < 10
    last = {str(i % 70): i for i in range(200)}
    times = {k: sum(str(i % 70) == k for i in range(200)) for k in last}
    want = [(str(i), 1 + times.get(str(i), 0), last.get(str(i), -i)) for i in range(100)]
    assert sorted(map(tuple, result.table.select("_id", "_version", "v").collect())) == sorted(want)
    assert result.items.count() == 200
