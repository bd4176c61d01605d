"""Character grams of token lists, cut in bulk.

Inside a lambda Spark evaluates an expression and makes an object for every
gram. Here the bytes of many words are cut at once by array operations, in
Arrow batches. Texts stay where they are (no shuffle).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

# Bytes of grams of a part of a batch, about, and of what is cut at once, so that
# it stays in the processor's cache. A longer row is a part, a longer word a cut.
PART, CUT = 1 << 22, 1 << 18


def _cuts(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items, given by their bounds in bytes, of at most
    ``most`` bytes or one item."""
    start, last = 0, len(bounds) - 1
    while start < last:
        end = int(np.searchsorted(bounds, bounds[start] + most, "right")) - 1
        end = min(last, max(start + 1, end))
        yield start, end
        start = end


def word_grams(raw: np.ndarray, offsets: np.ndarray, min_gram: int, max_gram: int) -> tuple[pa.StringArray, np.ndarray]:
    """The grams of words, by length, then position, and how many each word
    has. Word i is the UTF-8 bytes from ``offsets[i]`` to ``offsets[i + 1]``."""
    data, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    starts = (data & 0xC0) != 0x80
    ascii = bool(starts.all())
    first = offsets
    if not ascii:
        chars = np.zeros(len(data) + 1, np.int64)
        np.cumsum(starts, out=chars[1:])
        first = chars[offsets]
    length = np.diff(first)
    sizes = np.arange(min_gram, min(max_gram, int(length.max(initial=0))) + 1)
    # One piece per word and length; its grams begin at neighbouring characters.
    pieces = np.maximum(length[:, None] - sizes + 1, 0)
    per = pieces.ravel()
    before = np.cumsum(per) - per
    total = int(per.sum())
    begin = np.arange(total)
    begin += np.repeat(np.repeat(first[:-1], len(sizes)) - before, per)
    left = np.repeat(np.tile(sizes, len(length)), per)
    if not ascii:
        at = np.append(np.flatnonzero(starts), len(data))
        left = at[begin + left]
        begin = at[begin]
        left -= begin
    bounds = np.zeros(total + 1, np.int64)
    np.cumsum(left, out=bounds[1:])
    out, to = np.empty(bounds[-1], np.uint8), bounds[:-1]
    # The first byte of every gram, then the second ones; shorter grams drop out.
    for k in range(int(left.max(initial=0))):
        if k >= min_gram:
            on = np.flatnonzero(left > k)
            to, begin, left = to[on], begin[on], left[on]
        out[k:][to] = data[k:][begin]
    ends = pa.array(bounds, pa.int32())  # fails rather than wrap around
    return pa.StringArray.from_buffers(total, ends.buffers()[1], pa.py_buffer(out)), pieces.sum(axis=1)


def gram_lists(lists: pa.ListArray, min_gram: int, max_gram: int) -> Iterator[pa.ListArray]:
    """For each list of words the list of their grams, in parts of bounded
    size. A null list, or one with a null word, gives null."""
    words = lists.values.cast(pa.string())
    offsets, raw = (np.frombuffer(b or b"", t) for b, t in zip(words.buffers()[1:], (np.int32, np.uint8)))
    offsets = offsets[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    rows = lists.offsets.to_numpy().astype(np.int64)
    nulls = np.zeros(len(words) + 1, np.int64)
    np.cumsum(words.is_null().to_numpy(zero_copy_only=False), out=nulls[1:])
    empty = lists.is_null().to_numpy(zero_copy_only=False) | (np.diff(nulls[rows]) > 0)
    each = max(1, max_gram * (max_gram - min_gram + 1))
    for a, b in _cuts(offsets[rows], PART // each):
        own = offsets[rows[a] : rows[b] + 1]
        cut = [word_grams(raw, own[i : j + 1], min_gram, max_gram) for i, j in _cuts(own, CUT // each)]
        ends = np.zeros(len(own), np.int64)
        np.cumsum(np.concatenate([n for _, n in cut] or [ends[:0]]), out=ends[1:])
        values = pa.concat_arrays([v for v, _ in cut] or [pa.array([], pa.string())])
        yield pa.ListArray.from_arrays(pa.array(ends[rows[a : b + 1] - rows[a]], pa.int32()), values, mask=pa.array(empty[a:b]))


def token_grams(tokens: Column, min_gram: int, max_gram: int) -> Column:
    # Ship this module with the function, so executors need no installed package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @arrow_udf("array<string>")
    def grams(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield from gram_lists(lists, min_gram, max_gram)

    return grams(tokens)
