"""Writes: ordered bulk operations, updates and deletes by condition.

Every function takes tables and returns tables; the caller decides where the
new table goes. A bulk takes a table of operations

    seq bigint, action string, _id string, doc struct<...>, set_fields array<string>

with the actions index, create, update, upsert and delete. ``set_fields`` names
the fields that an update or upsert carries, nested ones by dotted path; an
object's name stands for all of its fields.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.plans.collection import Collection
from siftframe.plans.conditions import Bool, Condition, MatchAll, lifted
from siftframe.session import stage
from siftframe.sources.snapshots import ConflictError, Snapshots

ACTIONS = ("index", "create", "update", "upsert", "delete")

# Operations on one id beyond this number are worked on in several tasks.
HOT_OPS = 100_000

# Operations that one task works on, about, when there are more than that.
TASK_OPS = 200_000

# HTTP-like codes of item results.
OK, CREATED, NOT_FOUND, CONFLICT = 200, 201, 404, 409


@dataclass(frozen=True)
class BulkResult:
    """The new table, one report row per operation, and the last state of every
    id that had an operation (``_deleted`` marks those that are gone)."""

    table: DataFrame
    items: DataFrame
    changes: DataFrame


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of the fields that are not objects themselves."""
    found = []
    for f in schema.fields:
        path = prefix + f.name
        found += leaf_paths(f.dataType, path + ".") if isinstance(f.dataType, T.StructType) else [path]
    return found


def object_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of the fields that are objects."""
    found = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            found += [prefix + f.name, *object_paths(f.dataType, prefix + f.name + ".")]
    return found


def _rebuilt(
    schema: T.StructType, value: Callable[[str], Column], there: Callable[[str], Column], prefix: str = ""
) -> list[Column]:
    """Columns of a schema put together from its leaves; an object that is not
    ``there`` is null."""
    columns = []
    for f in schema.fields:
        path = prefix + f.name
        if isinstance(f.dataType, T.StructType):
            inner = F.struct(*_rebuilt(f.dataType, value, there, path + "."))
            columns.append(F.when(there(path), inner).alias(f.name))
        else:
            columns.append(value(path).alias(f.name))
    return columns


def _named(path: str) -> Column:
    """Whether ``set_fields`` names the leaf or an object around it."""
    steps = path.split(".")
    names = [".".join(steps[: i + 1]) for i in range(len(steps))]
    return reduce(lambda a, b: a | b, [F.array_contains("set_fields", n) for n in names])


def _named_below(path: str) -> Column:
    """Whether ``set_fields`` names something inside the object."""
    return F.coalesce(F.exists("set_fields", lambda x: F.startswith(x, F.lit(path + "."))), F.lit(False))


def with_generated_ids(ops: DataFrame, id_col: str = "_id") -> DataFrame:
    """Give operations without an id a random one. The result is written once,
    so that a repeated task cannot invent other ids."""
    return stage(ops.withColumn(id_col, F.coalesce(id_col, F.expr("uuid()"))), "ids")


def bulk(
    target: DataFrame,
    ops: DataFrame,
    id_col: str = "_id",
    version_col: str = "_version",
    hot_ops: int = HOT_OPS,
    staged: bool = False,
    gone: DataFrame | None = None,
) -> BulkResult:
    """Apply operations in ``seq`` order; one that fails does not stop others.

    The state an operation finds is what the last effective operation before it
    left, so it is a running value over the operations of its id:

    1. whether the document exists: set by every action but update;
    2. each field: set by the last write that carried it;
    3. the version: the count of effective changes.

    Operations with the same ``seq`` follow each other in the order of a hash of
    their content. An object is null or there, as it was last written; writing a
    field inside makes it be there.

    Running values need no list of a group's operations. An id with very many
    operations is cut into stretches of ``seq``, each summarised on its own, and
    the summaries are carried forward. Rows of the table without an operation
    only pass an anti join on the ids. ``staged=True`` writes the worked-out
    operations once, for callers that use more than one of the results. ``gone``
    gives id and version of rows deleted earlier, whose versions go on counting.
    """
    if isinstance(ops.schema[id_col].dataType, T.StringType):
        # An operation without an id gets one from its own content and seq: the
        # same whenever a task or a streamed batch is repeated.
        ops = ops.withColumn(id_col, F.coalesce(F.col(id_col), F.sha2(F.to_json(F.struct(*ops.columns)), 256)))
    schema = T.StructType([f for f in target.schema.fields if f.name not in (id_col, version_col)])
    leaves = leaf_paths(schema)
    objects = object_paths(schema)
    given = {*leaf_paths(ops.schema["doc"].dataType), *object_paths(ops.schema["doc"].dataType)}
    touched = ops.select(id_col).distinct()
    base = target.join(touched, id_col, "left_semi")
    start = base.select(
        id_col,
        F.col(version_col).cast("bigint").alias("_start_version"),
        F.struct(
            *[F.col(p).alias(f"f{i}") for i, p in enumerate(leaves)],
            *[F.col(p).isNotNull().alias(f"f{i}") for i, p in enumerate(objects, len(leaves))],
        ).alias("_start"),
    )
    if gone is not None:
        ended = F.lit(None).cast(start.schema["_start"].dataType).alias("_start")
        start = start.unionByName(gone.select(id_col, F.col(version_col).alias("_start_version"), ended))
    fold = _Fold(id_col, ops, hot_ops)
    rows = fold.spread(fold.rows.join(start, id_col, "left"))
    action = F.col("action")

    # 1. Existence before each operation.
    sets = F.when(action.isin("index", "create", "upsert"), True).when(action == "delete", False)
    rows = fold.last_before(rows.withColumn("_sets", sets), {"_found": "_sets"})
    rows = rows.withColumn("_found", F.coalesce("_found", F.col("_start").isNotNull()))
    fails = (
        ~action.isin(*ACTIONS)
        | ((action == "create") & F.col("_found"))
        | (action.isin("update", "delete") & ~F.col("_found"))
    )
    # A whole document is written unless fields are merged into an existing one.
    whole = (action != "update") & ~((action == "upsert") & F.col("_found"))
    rows = rows.withColumns({"_fails": fails, "_whole": whole})

    # 2. Fields. A write is a one-field struct, so that a written null differs
    # from no write.
    fields = []
    for path in leaves:
        value = F.col(f"doc.{path}") if path in given else F.lit(None).cast(target.select(path).schema[0].dataType)
        fields.append((value, F.col("_whole") | F.coalesce(_named(path), F.lit(False))))
    for path in objects:
        written = F.col(f"doc.{path}").isNotNull() if path in given else F.lit(False)
        inside = ~F.col("_whole") & _named_below(path)
        fields.append((inside | written, inside | F.col("_whole") | F.coalesce(_named(path), F.lit(False))))
    writes, before = {}, []
    for i, (value, wanted) in enumerate(fields):
        carried = ~F.col("_fails") & wanted
        writes[f"_w{i}"] = F.when(carried, F.struct(F.when(action != "delete", value).alias("v")))
        found = F.col(f"_b{i}").isNotNull()
        before.append(F.when(found, F.col(f"_b{i}.v")).otherwise(F.col(f"_start.f{i}")))
    rows = fold.last_before(rows.withColumns(writes), {f"_b{i}": f"_w{i}" for i in range(len(fields))})
    same = [F.col(f"_w{i}").isNull() | F.col(f"_w{i}.v").eqNullSafe(b) for i, b in enumerate(before)]
    merges = ~F.col("_whole") & ~F.col("_fails")
    rows = rows.withColumn("_noop", merges & reduce(lambda a, b: a & b, same))

    # 3. Version.
    rows = rows.withColumn("_change", (~F.col("_fails") & ~F.col("_noop")).cast("bigint"))
    rows = fold.total_before(rows, "_changes", "_change")
    version = F.coalesce("_start_version", F.lit(0)) + F.coalesce("_changes", F.lit(0)) + F.col("_change")
    after = [F.when(F.col(f"_w{i}").isNotNull(), F.col(f"_w{i}.v")).otherwise(b) for i, b in enumerate(before)]
    rows = rows.select(
        "seq",
        "action",
        id_col,
        F.when(~F.col("_fails"), version).alias(version_col),
        _result_name().alias("result"),
        _status().alias("status"),
        _error().alias("error"),
        F.struct(
            F.coalesce("_sets", "_found").alias("found"),
            version.alias("version"),
            *[v.alias(f"f{i}") for i, v in enumerate(after)],
        ).alias("_end"),
        "_tie",
    )
    if staged:
        rows = stage(rows, "bulk")

    # max_by combines map-side: a crowded id costs one row per task.
    ends = rows.groupBy(id_col).agg(F.max_by("_end", F.struct("seq", "_tie")).alias("_end"))
    place = {path: f"_end.f{i}" for i, path in enumerate([*leaves, *objects])}
    rebuilt = _rebuilt(schema, lambda path: F.col(place[path]), lambda path: F.col(place[path]))
    columns = dict(zip(schema.names, rebuilt))
    columns[id_col] = F.col(id_col)
    columns[version_col] = F.col("_end.version").cast(target.schema[version_col].dataType).alias(version_col)
    changes = ends.select(*[columns[n] for n in target.columns], (~F.col("_end.found")).alias("_deleted"))
    written = changes.where(~F.col("_deleted")).drop("_deleted")
    table = target.join(touched, id_col, "left_anti").select(*target.columns).unionByName(written)
    return BulkResult(table, rows.drop("_end", "_tie"), changes)


class _Fold:
    """Running values over the earlier operations of the same id."""

    def __init__(self, id_col: str, ops: DataFrame, hot_ops: int):
        content = F.struct("doc", "set_fields")
        content = F.to_json(content) if "map<" in ops.schema.simpleString() else content
        ops = ops.withColumn("_tie", F.xxhash64("action", content))
        per_id = ops.groupBy(id_col).agg(F.count("*").alias("_ops"))
        most, total = (n or 0 for n in per_id.agg(F.max("_ops"), F.sum("_ops")).first())
        self.id = id_col
        self.hot = most > hot_ops
        if not self.hot:
            self.keys = [id_col]
            # Dealt out by their number: Spark would give each task a share that grows with the table.
            least = int(ops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            self.rows = ops.repartition(max(least, -(-total // TASK_OPS)), id_col) if total > TASK_OPS else ops
            return
        # Cut a crowded id at quantiles of its own seq, so that stretches hold
        # like numbers of operations; every other id is one stretch.
        n = -(-2 * most // hot_ops)
        crowded = ops.join(per_id.where(F.col("_ops") > hot_ops), id_col, "left_semi")
        cuts = F.percentile_approx("seq", [k / n for k in range(1, n)], 20 * n)
        spans = crowded.groupBy(id_col).agg(F.array_distinct(cuts).alias("_cuts"))
        stretch = F.size(F.filter("_cuts", lambda x: x < F.col("seq"))).cast("bigint")
        stretch = F.when(F.col("_cuts").isNotNull(), stretch).otherwise(-1)
        self.keys = [id_col, "_stretch"]
        self.rows = ops.join(spans, id_col, "left").withColumn("_stretch", stretch).drop("_cuts")

    def spread(self, rows: DataFrame) -> DataFrame:
        """Place stretches on different tasks. A table already placed by id
        would count as placed by (id, stretch) and keep a crowded id together."""
        return rows.repartition(*self.keys) if self.hot else rows

    def last_before(self, rows: DataFrame, names: dict[str, str]) -> DataFrame:
        """For each ``new: source`` the last source value that is not null."""
        return self._before(rows, names, lambda c: F.last(c, ignorenulls=True), _last_by_seq, F.coalesce)

    def total_before(self, rows: DataFrame, new: str, source: str) -> DataFrame:
        plus = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        return self._before(rows, {new: source}, F.sum, F.sum, plus)

    def _before(self, rows: DataFrame, names: dict[str, str], running, summary, combined) -> DataFrame:
        frame = W.partitionBy(*self.keys).orderBy("seq", "_tie").rowsBetween(W.unboundedPreceding, -1)
        if self.hot:
            # Read twice below; written once, it is worked out once.
            rows = self.spread(stage(rows, "fold"))
        inside = rows.withColumns({new: running(source).over(frame) for new, source in names.items()})
        if not self.hot:
            return inside
        summaries = rows.where(F.col("_stretch") >= 0).groupBy(*self.keys)
        summaries = summaries.agg(*[summary(source).alias(new) for new, source in names.items()])
        earlier = W.partitionBy(self.id).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
        carried = summaries.select(*self.keys, *[running(new).over(earlier).alias(f"_c{new}") for new in names])
        joined = inside.join(carried, self.keys, "left")
        merged = {new: combined(F.col(new), F.col(f"_c{new}")) for new in names}
        return joined.withColumns(merged).drop(*[f"_c{new}" for new in names])


def _last_by_seq(source: str) -> Column:
    return F.max_by(source, F.when(F.col(source).isNotNull(), F.struct("seq", "_tie")))


def _result_name() -> Column:
    action = F.col("action")
    return (
        F.when(F.col("_fails") & action.isin("update", "delete"), "not_found")
        .when(F.col("_fails"), "error")
        .when(F.col("_noop"), "noop")
        .when(action == "delete", "deleted")
        .when(F.col("_found"), "updated")
        .otherwise("created")
    )


def _status() -> Column:
    action = F.col("action")
    return (
        F.when(~action.isin(*ACTIONS), 400)
        .when(F.col("_fails") & (action == "create"), CONFLICT)
        .when(F.col("_fails"), NOT_FOUND)
        .when((action != "delete") & ~F.col("_found"), CREATED)
        .otherwise(OK)
    )


def _error() -> Column:
    action = F.col("action")
    return (
        F.when(~action.isin(*ACTIONS), "unknown action")
        .when(F.col("_fails") & (action == "create"), "document already exists")
        .when(F.col("_fails"), "document missing")
    )


# --- reports --------------------------------------------------------------


def failed_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("error").isNotNull())


def bulk_report(items: DataFrame) -> DataFrame:
    """One row: operations, successes, failures and whether there are any."""
    failed = F.count_if(F.col("error").isNotNull())
    return items.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        failed.alias("failed"),
        (failed > 0).alias("has_errors"),
    )


def bulk_tables(
    targets: dict[str, DataFrame], ops: DataFrame, default: str, table_col: str = "_index"
) -> dict[str, BulkResult]:
    """Operations for several tables; one without a table name goes to the
    default. A name that is not among the tables is refused."""
    routed = stage(ops.withColumn(table_col, F.coalesce(table_col, F.lit(default))), "ops")
    unknown = routed.where(~F.col(table_col).isin(list(targets))).select(table_col).limit(1).collect()
    if unknown:
        raise ValueError(f"no such table: {unknown[0][0]}")
    return {
        name: bulk(target, routed.where(F.col(table_col) == name).drop(table_col)) for name, target in targets.items()
    }


def publish_bulk(
    store: Snapshots, ops: DataFrame, default: str, table_col: str = "_index", id_col: str = "_id", version_col: str = "_version"
) -> DataFrame:
    """Apply operations to the tables of a store and publish all of them as one
    version. Returns the item reports with the table of each operation (written,
    so they stay what they were). If anything fails, no table has changed."""
    now = store.pinned()
    targets = {name: now.read(name) for name in now.tables}
    routed = stage(ops.withColumn(table_col, F.coalesce(table_col, F.lit(default))), "ops")
    # A name per table comes here, and the first that is none of them.
    used = {r[0] for r in routed.select(table_col).distinct().limit(len(targets) + 1).collect()}
    if used - set(targets):
        raise ValueError(f"no such table: {sorted(used - set(targets))[0]}")
    items = None
    used = used or {default}
    with store.commit() as commit:
        if commit.began.version != now.version:
            raise ConflictError(f"version {commit.began.version} was published meanwhile")
        for name in sorted(used):
            mine = routed.where(F.col(table_col) == name).drop(table_col)
            result = bulk(targets[name], mine, id_col, version_col, staged=True)
            commit.replace(name, result.table)
            report = result.items.withColumn(table_col, F.lit(name))
            items = report if items is None else items.unionByName(report)
        items = stage(items, "items")
    return items


# --- by condition ---------------------------------------------------------


def update_by_query(
    c: Collection,
    condition: Condition | None = None,
    changes: dict[str, object] | None = None,
    version_col: str = "_version",
    observation=None,
) -> DataFrame:
    """Set fields of the rows that satisfy the condition, all rows without one.

    Values are constants or Spark columns over the old row (a computed update).
    A row that already holds the values keeps its version. ``observation``
    collects total, updated and noops while the result is written.
    """
    if not changes:
        raise ValueError("an update by query needs at least one change")
    hit = F.lit(True) if condition is None else lifted(condition).truth(c.scope)
    types = {f.name: f.dataType for f in c.df.schema.fields}
    new = {}
    for name, value in changes.items():
        value = value if isinstance(value, Column) else F.lit(value)
        new[name] = value.cast(types[name]) if name in types else value
    rows = c.df.withColumns({"_hit": hit, **{f"_new_{n}": v for n, v in new.items()}})
    differs = [
        ~F.col(f"`{n}`").eqNullSafe(F.col(f"`_new_{n}`")) if n in types else F.lit(True) for n in new
    ]
    rows = rows.withColumn("_changed", F.col("_hit") & reduce(lambda a, b: a | b, differs))
    updated = {
        n: F.when(F.col("_changed"), F.col(f"`_new_{n}`")).otherwise(F.col(f"`{n}`") if n in types else F.lit(None))
        for n in new
    }
    if version_col in types:
        updated[version_col] = F.col(version_col) + F.col("_changed").cast(types[version_col])
    rows = rows.withColumns(updated)
    if observation is not None:
        rows = rows.observe(
            observation,
            F.count_if("_hit").alias("total"),
            F.count_if("_changed").alias("updated"),
            F.count_if(F.col("_hit") & ~F.col("_changed")).alias("noops"),
        )
    return rows.drop("_hit", "_changed", *[f"_new_{n}" for n in new])


def script_update(c: Collection, condition: Condition | None, expressions: dict[str, str], **options) -> DataFrame:
    """Computed update from SQL expressions: ``{"views": "views + 10"}``."""
    return update_by_query(c, condition, {n: F.expr(e) for n, e in expressions.items()}, **options)


def delete_by_query(c: Collection, condition: Condition, observation=None) -> DataFrame:
    """Drop the rows that satisfy the condition. A row for which the condition
    is unknown stays; an empty condition is refused. ``observation`` collects
    total (rows looked at) and deleted while the result is written."""
    if condition is None or isinstance(condition, MatchAll) or (isinstance(condition, Bool) and condition == Bool()):
        raise ValueError("a delete by query needs a condition")
    if observation is None:
        return c.df.where(lifted(condition).negation(c.scope))
    rows = c.df.withColumn("_hit", lifted(condition).truth(c.scope))
    rows = rows.observe(observation, F.count("*").alias("total"), F.count_if("_hit").alias("deleted"))
    return rows.where("NOT _hit").drop("_hit")
