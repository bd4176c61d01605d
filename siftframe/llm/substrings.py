"""Repeated passages, by parsing every document relative to all the others.

The reference of this Lempel-Ziv parse is the corpus itself, cut into
overlapping blocks. Cuts follow the words: every 13-word window belongs to the
place of its least 4-word gram, and a block is the stretch of windows that
share that place. So a passage is cut the same way wherever it stands. Blocks
are indexed by their hash together with the document and place they stand at
first, and a document is factored by looking its blocks up: a factor goes on
as long as the next block continues the same reference document where the last
one ended. A factor's ends need not meet a cut. There, at blocks that are new
but share their gram with other blocks, the windows themselves are looked up,
which makes the result exact.

Only block hashes travel, about one for every five words. Before each shuffle a
batch keeps the smallest document of every block it has seen and settles the
others at once, so a passage that a third of all documents hold arrives in one
row per batch; and where a batch sees several blocks around one gram, it says so
to the gram in one row and sends the blocks elsewhere, so that a frequent gram
with many surroundings does not pile up either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import append_column, fresh, pieces, texts_of, with_outputs
from siftframe.llm.hashing import FACTORS, MIX, Words, mixed, runs
from siftframe.session import stage

WINDOW = 13  # words of a window
GRAM = 4  # words of the grams that place the cuts
PIECE = 1 << 22  # bytes of text handled at a time
SETTLE = 1 << 24  # bytes of text whose rows are settled before they travel


def blocks(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram, block hash, first window, number of windows) of each block of a
    text with word hashes ``h``; none below 13 words."""
    if len(h) < WINDOW:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    grams = runs(h, GRAM, 0)
    reach = WINDOW - GRAM + 1
    place = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(len(h) - WINDOW + 1)
    starts = np.concatenate([[0], np.nonzero(np.diff(place))[0] + 1])
    counts = np.diff(np.append(starts, len(place)))
    nth = np.arange(len(place)) - np.repeat(starts, counts)
    whole = np.add.reduceat(mixed(runs(h, WINDOW, 1) * FACTORS[2, nth]), starts)
    return grams[place[starts]], mixed(whole + counts.astype(np.uint64)), starts, counts


# Kinds of rows: nothing known, other blocks around the gram, repeated for certain.
OPEN, TORN, REPEATED = 0, 1, 2
_ROW = ["a", "b", "doc", "place", "span", "ref_doc", "ref_place"]
_ROWS = ", ".join(f"{c} long" for c in _ROW)


def _settled(a: np.ndarray, b: np.ndarray, doc: np.ndarray, place: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """Rows of one batch, ready to travel. A row whose key a smaller document of
    the batch has refers to that document; such rows are joined where they
    continue each other. ``place`` is the text's tag and the first window, a
    span the number of windows (above two bits) and the kind."""
    order = np.lexsort((place, doc, b, a))
    a, b, doc, place, count = (x[order] for x in (a, b, doc, place, count))
    gram = np.ones(len(a), bool)
    gram[1:] = a[1:] != a[:-1]
    block = gram.copy()
    block[1:] |= b[1:] != b[:-1]
    starts = np.nonzero(block)[0][np.cumsum(block) - 1] if len(a) else np.zeros(0, np.int64)
    later = doc > doc[starts]
    groups = np.cumsum(gram) - 1
    torn = np.bincount(groups, block)[groups] > 1 if len(a) else later
    kept = ~later
    key = np.where(kept & torn & ~gram, mixed(a * MIX + b), a)
    none = np.zeros(int(kept.sum()), np.int64)
    rows = [key[kept], b[kept], doc[kept], place[kept], ((count << 2) | np.where(torn, TORN, OPEN))[kept], none, none]
    if later.any():
        doc, place, count, ref_doc, ref_place = doc[later], place[later], count[later], doc[starts[later]], place[starts[later]]
        order = np.lexsort((place, doc))
        doc, place, count, ref_doc, ref_place = (x[order] for x in (doc, place, count, ref_doc, ref_place))
        apart = np.ones(len(doc), bool)
        apart[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + count[:-1])
        apart[1:] |= (ref_doc[1:] != ref_doc[:-1]) | (ref_place[1:] != ref_place[:-1] + count[:-1])
        at = np.nonzero(apart)[0]
        doc, place, ref_doc, ref_place, count = doc[at], place[at], ref_doc[at], ref_place[at], np.add.reduceat(count, at)
        key = mixed(doc.astype(np.uint64) * MIX + place.astype(np.uint64))
        more = (key, np.zeros(len(at), np.uint64), doc, place, (count << 2) | REPEATED, ref_doc, ref_place)
        rows = [np.concatenate(x) for x in zip(rows, more, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in rows], names=_ROW)


def _block_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, found, size = Words(), [], 0
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                keys = zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), strict=True)
                for text, (doc, tag) in zip(texts_of(batch, "text"), keys, strict=True):
                    gram, block, starts, counts = blocks(cache.hashes(text.split()))
                    found.append((gram, block, np.full(len(gram), doc, np.int64), (np.int64(tag) << 32) | starts, counts.astype(np.int64)))
                    size += len(text)
                if size > SETTLE:
                    yield _settled(*(np.concatenate(x) for x in zip(*found, strict=True)))
                    found, size = [], 0
        if found:
            yield _settled(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return docs.mapInArrow(run, _ROWS)


def _window_rows(docs: DataFrame) -> DataFrame:
    """Both hashes of the asked windows of each (doc, tag, text, asked), where
    ``asked`` holds first windows and numbers of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, found, size = Words(), [], 0
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                rows = zip(*(batch.column(c).to_pylist() for c in ("doc", "tag", "asked")), strict=True)
                for text, (doc, tag, asked) in zip(texts_of(batch, "text"), rows, strict=True):
                    h = cache.hashes(text.split())
                    first, count = np.array([[r["first"], r["count"]] for r in asked], np.int64).T
                    at = np.unique(np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
                    place = (np.int64(tag) << 32) | at
                    found.append((runs(h, WINDOW, 1)[at], runs(h, WINDOW, 2)[at], np.full(len(at), doc, np.int64), place, np.ones(len(at), np.int64)))
                    size += len(text)
                if size > SETTLE:
                    yield _settled(*(np.concatenate(x) for x in zip(*found, strict=True)))
                    found, size = [], 0
        if found:
            yield _settled(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return docs.mapInArrow(run, _ROWS)


def factors(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Factors (first word, end, reference document, first word there) of the
    repeated stretches (first window, number, reference document, first window
    there) of a text: a factor goes on while its reference does."""
    out: list[list[int]] = []
    for first, count, ref, at in sorted(found):
        end = first + count - 1 + WINDOW
        last = out[-1] if out else None
        if last and last[2] == ref and first - last[0] == at - last[3] and first + WINDOW <= last[1] + 1:
            last[1] = max(last[1], end)
        else:
            out.append([first, end, ref, at])
    return [tuple(x) for x in out]


def _repeats(docs: DataFrame) -> DataFrame:
    """(doc, tag, found): stretches of windows that a smaller document has too,
    with the place there. ``docs``: doc (not null), tag, text."""
    kind = F.col("span").bitwiseAND(3)
    tag = F.shiftright("place", 32).cast("int").alias("tag")
    first = F.col("place").bitwiseAND(0xFFFFFFFF).alias("first")
    count = F.shiftright("span", 2).alias("count")
    same, near = Window.partitionBy("a", "b"), Window.partitionBy("a")

    def referred(rows: DataFrame) -> DataFrame:
        """Rows with their reference: of the batch, or the smallest document of all."""
        rows = rows.withColumn("least", F.min(F.struct("doc", "place")).over(same))
        sure = (kind == REPEATED) | (F.col("doc") > F.col("least.doc"))
        for name in ("doc", "place"):
            given = F.when(kind == REPEATED, F.col(f"ref_{name}")).when(sure, F.col(f"least.{name}"))
            rows = rows.withColumn(f"ref_{name}", given)
        return rows.withColumn("sure", sure).drop("least")

    # One shuffle by gram serves both windows.
    rows = referred(_block_rows(docs).repartition("a"))
    torn = (F.min("b").over(near) != F.max("b").over(near)) | (F.max(kind).over(near) == TORN)
    rows = rows.withColumn("torn", torn).where("sure or torn")
    blocks_ = stage(rows.select("doc", "place", "span", "ref_doc", "ref_place", "sure"), "blocks")

    asked = blocks_.where("not sure").groupBy("doc", tag).agg(F.collect_list(F.struct(first, count)).alias("asked"))
    windows = referred(_window_rows(docs.join(asked, ["doc", "tag"]))).where("sure")
    spans = blocks_.where("sure").drop("sure").unionByName(windows.select("doc", "place", "span", "ref_doc", "ref_place"))
    there = F.col("ref_place").bitwiseAND(0xFFFFFFFF).alias("there")
    return spans.groupBy("doc", tag).agg(F.collect_list(F.struct(first, count, F.col("ref_doc").alias("ref"), there)).alias("found"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed, factors (removed word ranges: start,
    end, and the smaller document and word they were found at: ref_doc,
    ref_start) and kept (the words that stay, joined by one space).

    A word goes if a 13-word window over it also starts in a document with a
    smaller key; windows are those of the given texts. Rows of one key never
    remove each other's words. Rows with a null key keep all words and remove
    none. Null texts have no words. Texts below 13 words keep all. Factors may
    overlap where their references change. An empty table gives none. Texts of
    up to 2^31 words are parsed whole. Columns of these names in ``docs`` are
    replaced.
    """
    p = fresh(docs)
    tagged = docs.withColumn(p + "t", F.hash(F.coalesce(text, F.lit(""))))
    plain = tagged.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc"), F.col(p + "t").alias("tag"), F.coalesce(text, F.lit("")).alias("text")
    )
    spans = _repeats(plain).select(
        F.col("doc").alias(p + "d"), F.col("tag").alias(p + "g"), F.col("found").alias(p + "p")
    )
    joined = tagged.join(spans, (F.col(key) == F.col(p + "d")) & (F.col(p + "t") == F.col(p + "g")), "left")
    joined = joined.drop(p + "t", p + "d", p + "g")
    names = ("start", "end", "ref_doc", "ref_start")
    ints = (T.IntegerType(), T.IntegerType(), T.LongType(), T.IntegerType())
    span = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in zip(names, ints, strict=True)]))
    outputs = [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_removed", T.LongType(), False),
        T.StructField("factors", span, False),
        T.StructField("kept", T.StringType(), False),
    ]
    item = pa.struct(list(zip(names, (pa.int32(), pa.int32(), pa.int64(), pa.int32()), strict=True)))
    kinds = (pa.int64(), pa.int64(), pa.list_(item), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text, PIECE):
                rows = []
                for one, found in zip(texts_of(batch, text), batch.column(p + "p").to_pylist(), strict=True):
                    words = one.split()
                    cut = factors([(r["first"], r["count"], r["ref"], r["there"]) for r in found or []])
                    kept, upto = [], 0
                    for start, end, _, _ in cut:
                        kept += words[upto:start]
                        upto = max(upto, end)
                    kept = kept + words[upto:] if cut else words
                    ranges = [dict(zip(names, x, strict=True)) for x in cut]
                    rows.append((len(words), len(words) - len(kept), ranges, b" ".join(kept).decode("utf-8")))
                for field, kind, values in zip(outputs, kinds, zip(*rows, strict=True), strict=True):
                    batch = append_column(batch, field.name, pa.array(values, kind), p + "p")
                yield batch

    schema = T.StructType([f for f in joined.schema.fields if f.name != p + "p"])
    return joined.mapInArrow(run, with_outputs(schema, outputs))
