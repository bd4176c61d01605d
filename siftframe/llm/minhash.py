"""Near copies of documents, by improved consistent weighted sampling.

A document is the weighted set of its five-word shingles, each with its term
frequency times a smoothed inverse document frequency. Every sample picks one
shingle and one level of its weight such that two documents pick the same with
the probability of their weighted Jaccard similarity. Samples are banded; what
shares a band is a candidate, and candidates are verified on the full weights.

Document frequencies are counted over all documents in a fixed number of hashed
counters. A counter's load grows in proportion to the corpus, so the frequency
it stands for, as a share of all documents, is equally sharp at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftframe.llm.common import fold, fresh, pieces, texts_of
from siftframe.llm.components import Forest, connected_components
from siftframe.llm.hashing import Words, mixed, runs
from siftframe.session import stage, unstage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3  # a pair at 0.8 shares a band with probability 0.9998
COUNTERS = 1 << 16
# Fewer equal samples than this say that a pair is below SIMILARITY: at 0.8
# that errs about once in 10^5 pairs.
LEAST_EQUAL = (BANDS * ROWS) // 2
SPLIT = 512  # classes of a crowded band compared at a time
PIECE = 1 << 22
_TABLE = 1 << 16  # distinct random draws of a sample; ties go to the smaller shingle

_draw = np.random.default_rng(20100)
_R = _draw.gamma(2.0, 1.0, _TABLE)
_LN_C = np.log(_draw.gamma(2.0, 1.0, _TABLE))
_BETA = _draw.random(_TABLE)
_SPREAD = _draw.integers(1, 1 << 63, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)


def shingles(cache: Words, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each occurs. A text
    below five words has one shingle, all its words; without words it has none."""
    words = fold(text).split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(runs(cache.hashes(words), min(SHINGLE, len(words)), 0), return_counts=True)


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(48)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Per counter ln(1 + N / (df + N)): from 0.69 for what is rare to 0.41 for
    what every document has, so that a large group of near copies does not make
    its own text weightless. ``COUNTERS`` numbers, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, found, n = Words(), np.zeros(COUNTERS, np.int64), 0
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                for text in texts_of(batch, "text"):
                    found[np.unique(_counter(shingles(cache, text)[0]))] += 1
                    n += 1
        some = np.nonzero(found)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(found[some], n))], names=["counter", "n"]
        )

    rows = docs.mapInArrow(run, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    total = max(1, int(rows.loc[rows["counter"] == -1, "n"].sum()))
    frequency = np.zeros(COUNTERS)
    rows = rows[rows["counter"] >= 0]
    frequency[rows["counter"].to_numpy()] = rows["n"].to_numpy()
    return np.log1p(total / (frequency + total))


def samples(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One hash per sample: of the chosen shingle and its weight's level."""
    best = np.full(BANDS * ROWS, np.inf)
    out = np.zeros(BANDS * ROWS, np.uint64)
    every = np.arange(BANDS * ROWS)
    for at in range(0, len(hashes), 1 << 13):  # a long text in parts
        h, ln_w = hashes[at : at + (1 << 13)], np.log(weights[at : at + (1 << 13)])
        slot = ((h * _SPREAD) >> np.uint64(48)).astype(np.int64)
        r, beta = _R[slot], _BETA[slot]
        level = np.floor(ln_w / r + beta)
        ln_a = _LN_C[slot] - r * (level - beta + 1)
        k = ln_a.argmin(axis=1)
        low = ln_a[every, k]
        better = low < best
        best = np.where(better, low, best)
        picked = mixed(h[k] + mixed(level[every, k].astype(np.int64).astype(np.uint64)))
        out = np.where(better, picked, out)
    return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (ascending hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    union = a[1].sum() + b[1].sum() - common
    return float(common / union) if union else 0.0


def _identity(text: Column) -> tuple[Column, Column]:
    """128 bits that tell texts apart."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def _signed(rows: DataFrame, weights) -> DataFrame:
    """(h1, h2, least, size, signature) per distinct text with words: copies are
    counted inside a batch first, then across."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, idf = Words(), weights.value
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                seen: dict[tuple[int, int], list] = {}
                keys = zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "doc")), strict=True)
                for text, (h1, h2, doc) in zip(texts_of(batch, "text"), keys, strict=True):
                    if (h1, h2) in seen:
                        known = seen[h1, h2]
                        known[0], known[1] = min(known[0], doc), known[1] + 1
                        continue
                    hashes, n = shingles(cache, text)
                    if len(hashes):
                        picked = samples(hashes, n * idf[_counter(hashes)])
                        seen[h1, h2] = [doc, 1, picked.view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in seen], pa.int64()),
                        pa.array([k[1] for k in seen], pa.int64()),
                        pa.array([v[0] for v in seen.values()], pa.int64()),
                        pa.array([v[1] for v in seen.values()], pa.int64()),
                        pa.array([v[2] for v in seen.values()], pa.list_(pa.int64())),
                    ],
                    names=["h1", "h2", "least", "size", "signature"],
                )

    found = rows.mapInArrow(run, "h1 long, h2 long, least long, size long, signature array<long>")
    return found.groupBy("h1", "h2").agg(
        F.min("least").alias("least"), F.sum("size").alias("size"), F.any_value("signature").alias("signature")
    )


def _verified(pairs: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough. The text of b, which
    many pairs may share, joins last, so it is not carried through a shuffle."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, idf, last = Words(), weights.value, (None, None)

        def weighted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
            hashes, n = shingles(cache, text)
            return hashes, n * idf[_counter(hashes)]

        for whole in batches:
            for batch in pieces(whole, "left", PIECE):
                ids = list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True))
                good = []
                for (a, b), left, right in zip(ids, texts_of(batch, "left"), texts_of(batch, "right"), strict=True):
                    if last[0] != b:
                        last = (b, weighted(right))
                    good.append(weighted_jaccard(weighted(left), last[1]) >= SIMILARITY - 1e-9)
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _common(sets: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weight that each two of (hashes, counts, weights per occurrence) share.
    The n-th occurrences of a shingle are one feature, so the common weight is
    a product of 0/1 matrices over the features that several texts have."""
    features, owners, weights = [], [], []
    for i, (hashes, n, each) in enumerate(sets):
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        features.append(mixed(np.repeat(hashes, n) + mixed(nth.astype(np.uint64))))
        owners.append(np.full(len(nth), i))
        weights.append(np.repeat(each, n))
    features, owners, weights = map(np.concatenate, (features, owners, weights))
    _, first, number, held = np.unique(features, return_index=True, return_inverse=True, return_counts=True)
    shared = np.cumsum(held > 1) - 1
    weight = weights[first][held > 1]
    some = held[number] > 1
    number, owners = shared[number[some]], owners[some]
    common = np.zeros((len(sets), len(sets)))
    for at in range(0, len(weight), 4096):
        here = (number >= at) & (number < at + 4096)
        has = np.zeros((len(sets), min(4096, len(weight) - at)))
        has[owners[here], number[here] - at] = 1
        common += (has * weight[at : at + 4096]) @ has.T
    return common


def _alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose samples do not rule out that they are similar."""
    one = classes.select(F.col("node").alias("a"), F.col("signature").alias("left"))
    two = classes.select(F.col("node").alias("b"), F.col("signature").alias("right"))
    equal = F.aggregate(F.zip_with("left", "right", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return pairs.join(one, "a").join(two, "b").where(equal >= LEAST_EQUAL).select("a", "b")


def _apart(signature: np.ndarray, part: np.ndarray, block: np.ndarray, band: int, blocks_differ: bool) -> np.ndarray:
    """Which two rows of a band are to be verified in it: of different parts (and
    blocks), samples that may be similar, and no smaller band in common."""
    apart = part[:, None] != part[None, :]
    if blocks_differ:
        apart &= block[:, None] != block[None, :]
    for i in range(len(part)):
        equal = signature == signature[i]
        apart[i] &= equal.sum(axis=1) >= LEAST_EQUAL
        apart[i] &= equal.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
    return apart


def _columns(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(order of the distinct nodes, node, part, block, signature)."""
    node, part, block = (table.column(c).to_numpy() for c in ("node", "part", "block"))
    order = np.argsort(node, kind="stable")
    order = order[np.append(True, np.diff(node[order]) != 0)]
    flat = table.column("signature").combine_chunks().flatten().to_numpy()
    return order, node[order], part[order], block[order], flat.reshape(-1, BANDS * ROWS)[order]


_GROUP = ["band", "key", "one", "two"]


def _live(rows: DataFrame) -> DataFrame:
    """Members of each group that have someone to be verified with there."""

    def some(keys: tuple, table: pa.Table) -> pa.Table:
        _, node, part, block, signature = _columns(table)
        band, key, one, two = (k.as_py() for k in keys)
        node = node[_apart(signature, part, block, band, one != two).any(axis=1)]
        columns = [pa.array(np.full(len(node), x), pa.int64()) for x in (band, key, one, two)]
        return pa.table([*columns, pa.array(node)], names=[*_GROUP, "node"])

    return rows.groupBy(*_GROUP).applyInArrow(some, "band long, key long, one long, two long, node long")


def _crossing(rows: DataFrame, weights) -> DataFrame:
    """Edges (a, b) between similar members of different parts, inside each
    (band, key, one, two): those that connect the parts, not all pairs."""

    def compare(keys: tuple, table: pa.Table) -> pa.Table:
        order, node, part, block, signature = _columns(table)
        band, _, one, two = (k.as_py() for k in keys)
        apart = _apart(signature, part, block, band, one != two)
        live = np.nonzero(apart.any(axis=1))[0]
        left, right = [], []
        if len(live):
            cache, idf = Words(), weights.value
            texts = table.column("text").cast(pa.binary()).take(pa.array(order[live])).to_pylist()
            counted = [shingles(cache, t) for t in texts]
            sets = [(h, n, idf[_counter(h)]) for h, n in counted]
            common = _common(sets)
            total = np.array([(n * w).sum() for _, n, w in sets])
            near = common >= (SIMILARITY - 1e-9) * (total[:, None] + total[None, :] - common)
            near &= apart[np.ix_(live, live)]
            _, numbers = np.unique(part[live], return_inverse=True)
            forest = Forest(len(live))
            for i, j in zip(*np.nonzero(np.triu(near)), strict=True):
                if forest.join(int(numbers[i]), int(numbers[j])):
                    left.append(node[live[i]])
                    right.append(node[live[j]])
        return pa.table({"a": pa.array(right, pa.int64()), "b": pa.array(left, pa.int64())})

    return rows.groupBy(*_GROUP).applyInArrow(compare, "a long, b long")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with class_id, the smallest key of the group of near copies a
    row is in (its own if alone), and kept: the row has that key.

    Texts are linked at a weighted Jaccard similarity of 0.8 or more over
    shingles of five words, A-Z lower-cased; groups are connected by links.
    Equal texts are one class before anything is compared. Texts without words
    and null texts link with nothing. Rows with a null key link with nothing,
    have a null class_id and are kept. Rows that share a key are one document:
    repeated rows stay or go together. Columns of these names are replaced.

    A band's classes are first verified against its smallest one. Where that
    leaves several parts in a band, its members meet block by block in tasks of
    bounded size: those of different parts whose signatures may be similar are
    verified there, in the first band they share, and only edges that connect
    parts leave the task. Texts are sent only where signatures leave a question.
    No band is capped and no group is expanded into rows of pairs.

    An empty table gives none. Texts are compared whole, however long they are.
    """
    spark, p = docs.sparkSession, fresh(docs)
    h1, h2 = _identity(F.col(text))
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), h1.alias("h1"), h2.alias("h2"))
    weights = spark.sparkContext.broadcast(inverse_frequencies(rows.select("text")))
    classes = stage(_signed(rows, weights).withColumn("node", F.monotonically_increasing_id()), "signatures")

    band_keys = F.array(
        *[
            F.struct(F.lit(i).alias("band"), F.xxhash64(*[F.col("signature")[i * ROWS + j] for j in range(ROWS)]).alias("key"))
            for i in range(BANDS)
        ]
    )
    banded = classes.select("node", F.explode(band_keys).alias("b")).select("node", "b.*")
    leaders = banded.groupBy("band", "key").agg(F.min("node").alias("b"), F.count("*").alias("m")).where("m > 1")
    banded = stage(banded.join(leaders, ["band", "key"]), "bands")

    places = classes.select("node", "h1", "h2", F.col("least").alias("doc"))

    def with_texts(nodes: DataFrame) -> DataFrame:
        wanted = nodes.distinct().join(places, "node")
        return rows.join(wanted, ["h1", "h2", "doc"]).select("node", "text").dropDuplicates(["node"])

    # Signatures decide what is worth a look at the texts.
    pairs = banded.where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    pairs = stage(_alike(pairs, classes), "pairs")
    texts = stage(with_texts(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))), "texts")
    links = stage(_verified(pairs, texts, weights), "links")
    unstage(spark, pairs, texts)
    parts = stage(connected_components(links), "parts")

    held = banded.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component", "b")
    torn = held.groupBy("band", "key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    # Two members that are apart have been compared already: one led the other.
    held = held.where("m > 2").join(torn.where("low < high").select("band", "key"), ["band", "key"])
    held = held.join(classes.select("node", "signature"), "node")
    held = held.withColumn("blocks", F.ceil(F.col("m") / SPLIT))
    held = held.withColumn("block", F.pmod(F.xxhash64("node", "band"), F.col("blocks")))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    held = held.select(
        F.col("band").cast("long").alias("band"),
        "key",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        "node",
        "part",
        "block",
        "signature",
    )
    live = stage(_live(held), "live")
    texts = stage(with_texts(live.select("node")), "texts")
    held = held.join(live, [*_GROUP, "node"], "left_semi").join(texts, "node")
    more = stage(_crossing(held, weights), "links")
    unstage(spark, live, texts, parts, banded)
    parts = connected_components(links.unionByName(more))

    info = classes.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    smallest = info.groupBy("part").agg(F.min("least").alias("class_id"), F.sum("size").alias("n")).where("n > 1")
    info = info.join(smallest, "part").select(F.col("h1").alias(p + "1"), F.col("h2").alias(p + "2"), F.col("class_id").alias(p + "c"))
    info = stage(info, "classes")
    mine = docs.withColumns({p + "x": h1, p + "y": h2})
    same = (F.col(p + "x") == F.col(p + "1")) & (F.col(p + "y") == F.col(p + "2"))
    same &= F.col(key).isNotNull() & F.col(text).isNotNull()
    found = mine.join(info, same, "left")
    class_id = F.when(F.col(key).isNotNull(), F.coalesce(F.col(p + "c"), F.col(key).cast("long")))
    kept = F.coalesce(F.col(key).cast("long") == class_id, F.lit(True))
    found = found.withColumns({p + "k": kept, p + "i": class_id})
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("class_id", "kept")]
    return found.select(*keep, F.col(p + "i").alias("class_id"), F.col(p + "k").alias("kept"))
