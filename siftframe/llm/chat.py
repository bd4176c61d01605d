"""Conversations as training windows of a bounded number of tokens.

Prefix sums of turn tokens choose the windows. They cut a conversation into
stretches of the budget for new turns: the turns that lie inside a stretch are
one window, and a turn that straddles an end is a window of its own, so no
window passes the budget unless a single turn does, windows end at turns, and
none needs a scan from the start of the conversation. Each later window repeats
the system turn, if it keeps its share, and the last few turns before it; only
turns that are new in a window are trained on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftframe.session import stage

START, END = "<|im_start|>", "<|im_end|>"
# Rows of the same conversation and turn are ordered by role, then by text hash.
ORDER = ("conv_id", "turn", "role", "tie")


@dataclass(frozen=True)
class Budget:
    """Tokens of a window: for new turns, for repeated turns, for the system turn.
    A single new turn above its share is kept whole, alone in its window; a
    system turn above its share is not repeated."""

    new: int = 1536
    history: int = 256
    system: int = 256

    @property
    def total(self) -> int:
        return self.new + self.history + self.system


def escaped(text: Column) -> Column:
    """No ``<|`` is left in the text: a backslash goes in between, and
    backslashes are doubled."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escaped_role(role: Column) -> Column:
    """As ``escaped``; line feeds become backslash and ``n``, as a role ends at one."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    # A backslash-n that is no part of a doubled backslash.
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def tokens_by_length(piece: Column) -> Column:
    """A quarter of the code points, rounded up; the marks count, so no turn is
    free. Pass another function for a tokenizer's own counts (4 at least)."""
    return F.ceil(F.length(piece) / 4)


def _placed(turns: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    """Turns in order with ``place`` (increasing over all), ``first`` and the
    prefix sums ``before`` and ``upto``. The sums run inside sorted range
    partitions, so a long conversation is spread over several; what earlier
    partitions hold of it is carried in by a table of two rows per partition
    at most."""
    piece = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"), escaped(F.col("text")), F.lit(END + "\n"))
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("piece", piece)
    rows = rows.select("*", tokens(F.col("piece")).cast("long").alias("tokens"))
    rows = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    rows = rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    rows = stage(rows.drop("text", "tie"), "turns")

    parts = rows.groupBy("conv_id", "part").agg(F.sum("tokens").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("carried", F.sum("held").over(earlier)).where("carried is not null")
    carried = carried.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "carried")
    # Conversations that straddle a boundary: two per partition at most.
    here = Window.partitionBy("part", "conv_id").orderBy("place")
    rows = rows.withColumn("upto", F.sum("tokens").over(here)).withColumn("nth", F.row_number().over(here))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    rows = rows.join(F.broadcast(carried), same, "left")
    return rows.select(
        "conv_id",
        "role",
        "piece",
        "place",
        (F.col("carried").isNull() & (F.col("nth") == 1)).alias("first"),
        (F.col("upto") - F.col("tokens") + F.coalesce("carried", F.lit(0))).alias("before"),
        (F.col("upto") + F.coalesce("carried", F.lit(0))).alias("upto"),
    )


def windows(
    conversations: DataFrame, budget: Budget = Budget(), tokens: Callable[[Column], Column] = tokens_by_length
) -> DataFrame:
    """Training windows of (conv_id, turn, role, text): conv_id, window (increasing
    in a conversation), formatted, loss (spans of code points: start, length),
    n_turns (new ones) and n_context (repeated ones, which come first).

    Null roles and texts are empty. Null conv_ids are one conversation. Repeated
    rows are repeated turns. Rows of one turn are ordered by role, then hash.
    A first turn with role ``system`` opens every window of its conversation,
    unless it is longer than its share. A window has at most ``budget.total``
    tokens, but for a single new turn that is longer than ``budget.new``.
    Very long texts are turns like any other.
    Only assistant texts are under the loss, each in the one window where it is
    new. An empty table gives no windows; other columns are not read.
    """
    turns = stage(_placed(conversations, tokens), "placed")
    stretch, last = (F.floor(F.col(c) / budget.new) for c in ("before", "end"))
    turns = turns.withColumn("end", F.col("upto") - 1)
    turns = turns.withColumn("window", stretch * 2 + (last > stretch).cast("long"))
    in_window = Window.partitionBy("conv_id", "window")
    turns = turns.withColumn("ends", F.max("upto").over(in_window))
    is_system = F.col("first") & (F.col("role") == "system")
    small = F.col("upto") - F.col("before") <= budget.system

    new = turns.select("conv_id", "window", F.lit(2).alias("rank"), "place", "role", "piece")
    # The next window begins where this one ends.
    opened = turns.groupBy(F.col("conv_id").alias("c"), F.col("window").alias("following")).agg(F.min("before").alias("opens"))
    recent = turns.where(~is_system & (F.col("ends") - F.col("before") <= budget.history))
    history = recent.join(opened, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("ends") == F.col("opens"))).select(
        "conv_id", F.col("following").alias("window"), F.lit(1).alias("rank"), "place", "role", "piece"
    )
    system = turns.where(is_system & small).select(F.col("conv_id").alias("c"), F.col("window").alias("own"), "place", "role", "piece")
    later = turns.select("conv_id", "window").distinct()
    system = later.join(system, F.col("conv_id").eqNullSafe(F.col("c"))).where(F.col("window") > F.col("own")).select(
        "conv_id", "window", F.lit(0).alias("rank"), "place", "role", "piece"
    )
    order = in_window.orderBy("rank", "place")
    rows = new.unionByName(history).unionByName(system).withColumn("size", F.length("piece"))
    rows = rows.withColumn("starts", F.sum("size").over(order) - F.col("size"))
    header = F.length(F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")))
    span = F.struct(
        (F.col("starts") + header).cast("int").alias("start"),
        (F.col("size") - header - len(END + "\n")).cast("int").alias("length"),
    )
    trained = (F.col("rank") == 2) & (F.col("role") == "assistant")
    packed = F.sort_array(
        F.collect_list(F.struct("rank", "place", "piece", F.when(trained, span).alias("span")))
    )
    grouped = rows.groupBy("conv_id", "window").agg(
        packed.alias("t"), F.count_if(F.col("rank") == 2).alias("n_turns"), F.count_if(F.col("rank") < 2).alias("n_context")
    )
    return grouped.where("n_turns > 0").select(
        "conv_id",
        "window",
        F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss"),
        "n_turns",
        "n_context",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per window what the formatted text says: its new turns as one string of
    role, line feed, text, line feed each, and the text under the loss."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>"), F.col("n_context") + 2, 1 << 30)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END + "\n"))
        return F.concat(unescaped_role(role), F.lit("\n"), unescaped(body), F.lit("\n"))

    loss = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select(
        "conv_id",
        "window",
        F.size(parts).cast("long").alias("n_turns"),
        F.array_join(F.transform(parts, turn), "").alias("turns"),
        F.array_join(loss, "").alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: numbers and digests of what its windows say. Windows
    come sorted, so a digest is carried along and no conversation is gathered."""
    rows = read_back(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state, done = None, None, []

        def closed() -> tuple:
            n, turns, chars, loss, size = state
            return open_key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size

        def flushed() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*done, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if open_key is None or open_key[0] != row["conv_id"]:
                    if open_key is not None:
                        done.append(closed())
                    open_key, state = (row["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += row["n_turns"]
                state[1].update(row["turns"].encode("utf-8"))
                state[2] += len(row["loss"])
                state[3].update(row["loss"].encode("utf-8"))
                state[4] += row["chars"]
            yield flushed()
            done = []
        if open_key is not None:
            done.append(closed())
        yield flushed()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(run, schema)
