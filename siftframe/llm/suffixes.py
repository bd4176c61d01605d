"""Repeated byte strings, by externally sorted and induced suffixes.

A suffix array lists equal strings next to each other. Built by induction, only
a sample of the suffixes is sorted; the order of all others follows from it by
prepending one byte at a time. Here the sample is drawn by content, so that it
is the same in every document: each string of ``length`` bytes belongs to its
anchor, the place of its least gram. A block is a run of strings with one
anchor, and its suffix tuple is (gram, name of the block, document, place).

1. Tuples are shuffled by gram and sorted. The queue that the method asks for is
   Spark's external sort: it spills runs to disk and merges them by a priority
   queue, so a shard may be far larger than memory. Equal names stand together,
   and all but the first block of a name are repeats. Where all blocks of a gram
   bear one name, or its only block is alone, the gram is settled: there are no
   other strings around it.
2. Where names differ, the bytes around the anchors decide. The anchors' suffixes
   are sorted and get the common-prefix value of each with its predecessor.
   Then each layer is induced from the last: the suffixes that begin one byte
   earlier are the sorted ones in stable order of the prepended byte, and a
   common prefix grows by one where this byte is the same, from the least value
   between. Wherever the value reaches ``length``, strings are equal.
3. A gram with more than ``CROWD`` undecided tuples is not brought into one
   task: its strings are named by 128-bit hashes and aggregated by name.

Before each shuffle a task keeps the first tuple of every name and settles the
others of its batch, so a passage that a third of all documents hold arrives in
one row per ``SETTLE`` bytes of text. Names are 128-bit hashes; strings of step
2 are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import append_column, fresh, pieces, texts_of, with_outputs
from siftframe.llm.hashing import MIX, mixed
from siftframe.session import stage

LENGTH = 100  # bytes of a string
PIECE = 1 << 18  # bytes of text handled at a time; longer texts are cut, strings are not
SETTLE = 1 << 23  # bytes of text whose tuples are settled before they travel
CROWD = 20_000  # undecided tuples of one gram that a task may compare
TOGETHER = 1 << 13  # tuples compared at once
LOW = np.uint64(0xFFFFFFFF)

_draw = np.random.default_rng(20240607)
BYTES = _draw.integers(0, 1 << 63, 256, np.uint64)
STEPS = _draw.integers(0, 1 << 63, 8, np.uint64) | np.uint64(1)
BASE = int(STEPS[7])


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as far as they were needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, PIECE + 4096)
            for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                factors = np.full(size, factor, np.uint64)
                factors[0] = 1
                setattr(cls, name, np.cumprod(factors))
        return cls.up[:n], cls.down[:n]


def gram_size(length: int) -> int:
    """Bytes of a gram: the greatest power of two up to a third of a string."""
    size = 1
    while size * 2 <= max(1, length // 3):
        size *= 2
    return size


def _grams(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of all grams of ``size`` bytes, and of those of up to 8 with their size."""
    h, w, small, at = BYTES[data], 1, None, 0
    while w < size:
        h = h[:-w] * STEPS[at] + h[w:]
        w, at = 2 * w, at + 1
        if w == 8:
            h = mixed(h)
            small = h
    return mixed(h), (h if small is None else small), min(size, 8)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    w = 1
    n = len(values) - width + 1
    while 2 * w <= width:
        values = np.minimum(values[:-w], values[w:])
        w *= 2
    return values if w == width else np.minimum(values[:n], values[width - w :][:n])


def blocks(data: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram, name, anchor, first string, number of strings) of every block of
    ``data``, the bytes of several texts, ``text`` being the number of each byte's."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    size = gram_size(length)
    grams, small, width = _grams(data, size)
    place = np.arange(len(grams), dtype=np.uint64)
    # The leftmost gram with the least upper half: content alone decides.
    anchor = (_least((grams & ~LOW) | place, length - size + 1) & LOW).astype(np.int64)
    whole = np.nonzero(text[:n] == text[length - 1 :])[0]
    if not len(whole):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    new = np.nonzero(np.diff(anchor[whole], prepend=-1))[0]
    first = whole[new]
    count = np.diff(np.append(new, len(whole)))
    up, down = Powers.upto(len(small) + 1)
    total = np.zeros(len(small) + 1, np.uint64)
    np.cumsum(small * up[:-1], out=total[1:])
    end = first + count + length - width  # after the last small gram of the block
    name = (total[end] - total[first]) * down[first]
    return grams[anchor[first]], mixed(name + count.astype(np.uint64) * MIX), anchor[first], first, count


# Kinds of tuples: nothing known, other names beside it, a repeat for certain.
OPEN, TORN, REPEATED = 0, 1, 2


def _span(left: np.ndarray, count: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    """Strings before the anchor's own (8 bits and more), their number (32), kind (2)."""
    return (left.astype(np.int64) << 34) | (count.astype(np.int64) << 2) | kind


def _settled(a: np.ndarray, b: np.ndarray, doc: np.ndarray, place: np.ndarray, left: np.ndarray, count: np.ndarray) -> list:
    """Tuples of one batch, ready to travel. Repeats within the batch are joined
    to long spans. Where a gram has several names its first tuple goes to the
    gram and says so; the others go to their names, so that a gram with many
    surroundings does not pile up."""
    order = np.lexsort((place, doc, b, a))
    a, b, doc, place, left, count = (x[order] for x in (a, b, doc, place, left, count))
    gram = np.ones(len(a), bool)
    gram[1:] = a[1:] != a[:-1]
    name = gram.copy()
    name[1:] |= b[1:] != b[:-1]
    # Equal (document, place) are repeated rows: none comes before the other.
    starts = np.nonzero(name)[0][np.cumsum(name) - 1]
    later = (doc != doc[starts]) | (place != place[starts])
    groups = np.cumsum(gram) - 1
    torn = np.bincount(groups, name)[groups] > 1
    kept = ~later
    spread = kept & torn & ~gram
    key = np.where(spread, mixed(a * MIX + b), a)
    rows = [x[kept] for x in (key, b, a, doc, place, _span(left, count, np.where(torn, TORN, OPEN)))]
    doc, place, first, count = doc[later], place[later], (place - left)[later], count[later]
    order = np.lexsort((first, doc))
    doc, first, count = doc[order], first[order], count[order]
    if len(doc):
        apart = np.ones(len(doc), bool)
        apart[1:] = (doc[1:] != doc[:-1]) | (first[1:] != first[:-1] + count[:-1])
        at = np.nonzero(apart)[0]
        doc, first, count = doc[at], first[at], np.add.reduceat(count, at)
        key = mixed(doc.astype(np.uint64) * MIX + first.astype(np.uint64))
        more = (key, *np.zeros((2, len(at)), np.uint64), doc, first, _span(np.zeros(len(at)), count, REPEATED))
        rows = [np.concatenate(x) for x in zip(rows, more, strict=True)]
    return [x.view(np.int64) for x in rows]


_TUPLES = ["a", "b", "gram", "doc", "place", "span"]  # a: what a tuple is shuffled by, b: its name


def _joined(texts: list[bytes], keys: list[tuple[int, int]], length: int) -> Iterator[tuple]:
    """Texts put together to about ``PIECE`` bytes: (bytes, number of the text of
    each byte, and doc, tag and offset by number). Longer texts are cut so that
    every string lies in one part."""
    parts, about, size = [], [], 0

    def ready() -> tuple:
        data = np.frombuffer(b"".join(parts), np.uint8)
        number = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        return (data, number, *(np.array(x, np.int64) for x in zip(*about, strict=True)))

    for text, (doc, tag) in zip(texts, keys, strict=True):
        for at in range(0, len(text) - length + 1, PIECE):
            part = text[at : at + PIECE + length - 1]
            if parts and size + len(part) > PIECE + length:
                yield ready()
                parts, about, size = [], [], 0
            parts.append(part)
            about.append((doc, tag, at))
            size += len(part)
    if parts:
        yield ready()


def _tuples(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            columns = _settled(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_TUPLES)

        for whole in batches:
            for batch in pieces(whole, "text", SETTLE // 4):
                keys = list(zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), strict=True))
                for data, number, doc, tag, offset in _joined(texts_of(batch, "text"), keys, length):
                    gram, name, anchor, first, count = blocks(data, number, length)
                    # Places are counted within the text, not within the joined bytes.
                    begins = np.searchsorted(number, np.arange(len(doc)))
                    of = number[first]
                    place = (tag[of] << 32) | (offset[of] + anchor - begins[of])
                    held.append((gram, name, doc[of], place, anchor - first, count))
                    size += len(data)
                if size > SETTLE:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in _TUPLES))


def _around(docs: DataFrame, length: int) -> DataFrame:
    """The bytes of all strings of each asked block. ``docs``: doc, text, asked
    (null or a list of gram, place, span, crowded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", SETTLE // 4):
                lists, docs_, around = [], [], []
                rows = zip(texts_of(batch, "text"), batch.column("doc").to_pylist(), batch.column("asked"), strict=True)
                for text, doc, asked in rows:
                    if not asked.is_valid:
                        continue
                    asked = asked.values.flatten()
                    place, span = asked[1].to_numpy(), asked[2].to_numpy()
                    at, left, count = place & 0xFFFFFFFF, span >> 34, (span >> 2) & 0xFFFFFFFF
                    first = at - left
                    around += [text[i:j] for i, j in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)]
                    lists.append(asked)
                    docs_.append(np.full(len(place), doc, np.int64))
                if lists:
                    gram, place, span, crowded = (pa.concat_arrays(x) for x in zip(*lists, strict=True))
                    columns = [gram, pa.array(np.concatenate(docs_)), place, span, crowded, pa.array(around, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["gram", "doc", "place", "span", "crowded", "around"])

    return docs.mapInArrow(run, "gram long, doc long, place long, span long, crowded boolean, around binary")


def _sorted(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``rows`` (bytes) within their groups, and what each has in common
    with the row before it, -1 at the start of a group."""
    m, width = rows.shape
    keyed = np.empty((m, 4 + width), np.uint8)
    keyed[:, :4] = group.astype(">u4").view(np.uint8).reshape(m, 4)
    keyed[:, 4:] = rows
    order = np.argsort(keyed.view(f"S{4 + width}").ravel(), kind="stable")
    rows, group = rows[order], group[order]
    common = np.full(m, -1, np.int16)
    differ = rows[1:] != rows[:-1]
    least = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[1:] = np.where(group[1:] == group[:-1], least, -1)
    return order, common


def _least_between(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[start + 1 .. end] for each pair, start < end."""
    length = end - start
    level = np.frexp(length)[1] - 1
    out = np.empty(len(start), values.dtype)
    table, w = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            table = np.minimum(table[:-w], table[w:])
            w *= 2
        some = np.nonzero(level == k)[0]
        out[some] = np.minimum(table[start[some] + 1], table[end[some] + 1 - w])
    return out


def repeated_strings(group: np.ndarray, left: np.ndarray, count: np.ndarray, around: list[bytes], length: int) -> np.ndarray:
    """For rows in their order of age, group by group: a matrix that says for row
    r and layer l whether the string that begins l bytes before r's anchor
    equals one of an earlier row of its group. Row r has the strings of layers
    left[r] - count[r] + 1 to left[r], and ``around`` holds their bytes."""
    m, layers = len(group), int(left.max(initial=-1)) + 1
    sizes = np.array([len(x) for x in around])
    flat = np.frombuffer(b"".join(around), np.uint8)
    begins = np.cumsum(sizes) - sizes

    def matrix(start: np.ndarray, step: int, most: np.ndarray, width: int) -> np.ndarray:
        j = np.arange(width)
        inside = j[None, :] < most[:, None]
        at = np.where(inside, (begins + start)[:, None] + step * j[None, :], 0)
        return np.where(inside, flat[at], 0).astype(np.uint8)

    right = matrix(left, 1, np.minimum(sizes - left, length), length)
    before = matrix(left - 1, -1, left, max(1, layers - 1))  # column l: the byte that layer l + 1 prepends
    least_layer = left - count + 1
    found = np.zeros((m, layers), bool)
    order, common = _sorted(group, right)
    for layer in range(layers):
        # Suffixes of this layer stand in order, with their common prefixes.
        new = np.nonzero(common < length)[0]
        valid = (least_layer[order] <= layer) & (left[order] >= layer)
        oldest = np.minimum.reduceat(np.where(valid, order, m), new)
        classes = np.cumsum(common < length) - 1
        later = valid & (order > oldest[classes])
        found[order[later], layer] = True
        if layer + 1 == layers:
            break
        # Induce the next layer: stable order of the prepended byte within the group.
        going = np.nonzero(left[order] > layer)[0]
        byte = before[order[going], layer]
        turn = np.argsort(byte, kind="stable")
        turn = turn[np.argsort(_ranks(group[order[going]][turn]), kind="stable")]
        at = going[turn]
        row, byte = order[at], byte[turn]
        same = np.zeros(len(at), bool)
        same[1:] = (group[row[1:]] == group[row[:-1]]) & (byte[1:] == byte[:-1])
        grown = np.where(np.diff(group[row], prepend=-1) != 0, -1, 0).astype(np.int16)
        pairs = np.nonzero(same)[0]
        grown[pairs] = _least_between(common, at[pairs - 1], at[pairs]) + 1
        order, common = row, grown
    return found


def _ranks(group: np.ndarray) -> np.ndarray:
    """Groups as small numbers: their stable order is found by counting then."""
    return group.astype(np.uint16) if group.max(initial=0) < 1 << 16 else group


def _compared(rows: DataFrame, length: int) -> DataFrame:
    """(doc, tag, first, count): runs of repeated strings among rows sorted by
    gram and age inside their partitions."""

    def decide(columns: list) -> pa.RecordBatch:
        gram, doc, place, span = (np.concatenate(c) for c in columns[:4])
        around = [x for c in columns[4] for x in c]
        group = np.cumsum(np.diff(gram, prepend=gram[0]) != 0)
        left, count = span >> 34, (span >> 2) & 0xFFFFFFFF
        found = repeated_strings(group, left, count, around, length)
        # Equal (document, place, span) are repeated rows and count once.
        again = np.all([np.diff(x, prepend=x[0] - 1) == 0 for x in (doc, place, span >> 2)], axis=0)
        found[again] = False
        edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        r, low = np.nonzero(edges == 1)
        high = np.nonzero(edges == -1)[1]  # layers low to high - 1 of row r, in the same order
        at, tag = place[r] & 0xFFFFFFFF, place[r] >> 32
        columns = [doc[r], tag, at - high + 1, high - low]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "tag", "first", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(5)]
        n = 0
        for batch in batches:
            gram = batch.column("gram").to_numpy()
            # Whole grams only: the last one of a batch may go on in the next.
            last = int(np.searchsorted(gram[::-1] != gram[-1], True)) if len(gram) else 0
            cut = len(gram) - last
            for part in (batch.slice(0, cut), batch.slice(cut)):
                if not part.num_rows:
                    continue
                begins = part.column("gram")[0].as_py()
                if n >= TOGETHER and held[0][-1][-1] != begins:
                    yield decide(held)
                    held, n = [[] for _ in range(5)], 0
                for c, name in zip(held, ["gram", "doc", "place", "span"], strict=False):
                    c.append(part.column(name).to_numpy())
                held[4].append(part.column("around").to_pylist())
                n += part.num_rows
        if n:
            yield decide(held)

    return rows.mapInArrow(run, "doc long, tag long, first long, count long")


def _crowded(rows: DataFrame, length: int) -> DataFrame:
    """The same for grams that no task should hold: strings by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, docs, places = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("doc", "place", "span", "around"))
            for doc, place, span, around in zip(*columns, strict=True):
                first = place - (span >> 34)
                for i in range((span >> 2) & 0xFFFFFFFF):
                    names.append(xxhash.xxh3_128_digest(around[i : i + length]))
                    docs.append(doc)
                    places.append(first + i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(docs, pa.int64()), pa.array(places, pa.int64())], names=["name", "doc", "place"]
            )

    strings = rows.mapInArrow(run, "name binary, doc long, place long")
    oldest = strings.groupBy("name").agg(F.min(F.struct("doc", "place")).alias("oldest"))
    later = strings.join(oldest, "name").where(F.struct("doc", "place") > F.col("oldest"))
    return later.select(
        "doc",
        F.shiftright("place", 32).alias("tag"),
        F.col("place").bitwiseAND(0xFFFFFFFF).alias("first"),
        F.lit(1).cast("long").alias("count"),
    )


def _spans(keyed: DataFrame, length: int) -> DataFrame:
    """(doc, tag, spans): runs of repeated strings of every text, packed as
    first string and number. ``keyed``: doc, tag, text."""
    rows = _tuples(keyed.where("doc is not null"), length).repartition("a")
    near = Window.partitionBy("a")
    kind = F.col("span").bitwiseAND(3)
    rows = rows.withColumn("nth", F.rank().over(Window.partitionBy("a", "b").orderBy("doc", "place")))
    rows = rows.withColumn("names", F.min("b").over(near) != F.max("b").over(near)).withColumn("worst", F.max(kind).over(near))
    sure = (kind == REPEATED) | (F.col("nth") > 1)
    torn = F.col("names") | (F.col("worst") == TORN)
    found = stage(rows.where(sure | torn).select("gram", "doc", "place", "span", sure.alias("sure")), "tuples")
    tag = F.shiftright("place", 32).cast("int").alias("tag")
    first = F.col("place").bitwiseAND(0xFFFFFFFF) - F.shiftright("span", 34)
    count = F.shiftright("span", 2).bitwiseAND(0xFFFFFFFF)
    certain = found.where("sure").select("doc", tag, first.alias("first"), count.alias("count"))

    open_ = found.where("not sure")
    crowds = stage(open_.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("gram", F.lit(True).alias("crowded")), "crowds")
    some = not crowds.isEmpty()
    marked = open_.join(crowds, "gram", "left") if some else open_.withColumn("crowded", F.lit(False))
    tuples = F.struct("gram", "place", "span", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    asked = marked.groupBy("doc", tag).agg(F.collect_list(tuples).alias("asked"))
    # A left join, as in ``without_repeats``: the same shuffle of the texts serves both.
    around = _around(keyed.join(asked, ["doc", "tag"], "left").select("doc", "text", "asked"), length)
    few = around.where("not crowded").drop("crowded").repartition("gram").sortWithinPartitions("gram", "doc", "place", "span")
    every = certain.withColumn("tag", F.col("tag").cast("long")).unionByName(_compared(few, length))
    if some:
        every = every.unionByName(_crowded(around.where("crowded"), length))
    packed = F.shiftleft("first", 32).bitwiseOR(F.col("count")).alias("span")
    return every.groupBy("doc", F.col("tag").cast("int").alias("tag")).agg(F.collect_list(packed).alias("spans"))


def removed_runs(spans: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by strings, from packed runs of strings."""
    if not spans:
        return []
    packed = np.sort(np.array(spans, np.int64))
    first = packed >> 32
    end = np.maximum.accumulate(first + (packed & 0xFFFFFFFF) - 1 + length)
    new = np.nonzero(np.append(True, first[1:] > end[:-1]))[0]
    return list(zip(first[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist(), strict=True))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, spans (removed byte ranges:
    start, end) and kept (the bytes that stay; a cut may fall inside a
    character, so they are binary).

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes over it
    also starts earlier: in a document with a smaller key, or earlier in the
    same one; strings may overlap, are those of the given texts and never cross
    documents. Null texts are empty; texts below ``length`` keep all. Repeated
    rows (same key and text) are one document and have one result; rows of one
    key with other texts come in the order of a hash of these. Rows with a null
    key keep all bytes and remove none. An empty table gives none. Columns of
    these names in ``docs`` are replaced. A text may have up to 2^31 bytes.
    """
    p = fresh(docs)
    whole = F.coalesce(F.col(text), F.lit(""))
    others = [c for c in docs.columns if c not in (key, text)]
    keyed = docs.select(F.col(key).cast("long").alias(p + "d"), F.hash(whole).alias(p + "t"), F.col(text).alias(p + "x"), *others)
    plain = keyed.select(F.col(p + "d").alias("doc"), F.col(p + "t").alias("tag"), F.col(p + "x").alias("text"))
    spans = _spans(plain, length).select(F.col("doc").alias(p + "a"), F.col("tag").alias(p + "b"), F.col("spans").alias(p + "s"))
    joined = keyed.join(spans, (F.col(p + "d") == F.col(p + "a")) & (F.col(p + "t") == F.col(p + "b")), "left")
    order = [F.col(p + "d").cast(docs.schema[key].dataType).alias(key) if c == key else F.col(p + "x").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    joined = joined.select(*order, p + "s")
    pairs = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    outputs = [
        T.StructField("n_bytes", T.LongType(), False),
        T.StructField("n_removed", T.LongType(), False),
        T.StructField("n_spans", T.LongType(), False),
        T.StructField("spans", pairs, False),
        T.StructField("kept", T.BinaryType(), False),
    ]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text, SETTLE // 4):
                rows = []
                for one, packed in zip(texts_of(batch, text), batch.column(p + "s").to_pylist(), strict=True):
                    runs = removed_runs(packed or [], length)
                    kept, upto = [], 0
                    for start, end in runs:
                        kept.append(one[upto:start])
                        upto = end
                    kept = b"".join([*kept, one[upto:]]) if runs else one
                    rows.append((len(one), len(one) - len(kept), len(runs), [{"start": a, "end": b} for a, b in runs], kept))
                for field, kind, values in zip(outputs, kinds, zip(*rows, strict=True), strict=True):
                    batch = append_column(batch, field.name, pa.array(values, kind), p + "s")
                yield batch

    schema = T.StructType([f for f in joined.schema.fields if f.name != p + "s"])
    return joined.mapInArrow(run, with_outputs(schema, outputs))
