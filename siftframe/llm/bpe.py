"""Byte-level BPE: texts to token ids and back.

Each text is cut into words by the vocabulary's pattern and each word is merged
on its own: a short word keeps the contiguous array of its parts with the ranks
of adjacent pairs beside it, looks for the smallest rank, deletes that boundary
and refreshes the two neighbouring ranks. Beyond ``LONG_WORD`` bytes, where the
repeated scan would be quadratic, the same merges come from a heap.

Ids are stored packed, as little-endian unsigned 32-bit integers: the form
training loaders map into memory.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.llm.common import append_column, pieces, with_outputs

# The public pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONG_WORD = 96  # bytes; longer words are merged by a heap
CACHED_WORDS = 100_000  # encoded words a worker remembers (under 25 MB); then it starts anew
PIECE = 1 << 20  # bytes of a batch handled at a time
CACHED_BYTES = 64  # longer words are not remembered
_NONE = 1 << 60


def load_vocabulary(path: str) -> dict:
    """The vocabulary of a byte-level BPE tokenizer file, read on the driver.
    Its size is that of the file, whatever the corpus."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    model = spec["model"]
    if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError("a byte-level BPE tokenizer file is needed")
    return {
        "vocab": model["vocab"],
        "merges": [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]],
        "special": {t["content"]: t["id"] for t in spec.get("added_tokens", [])},
    }


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """Packed ids by word; a missing word is merged and remembered."""

    def __init__(self, vocabulary: dict) -> None:
        super().__init__()
        vocab = vocabulary["vocab"]
        self.size = max(vocab.values(), default=0) + 1
        letters = byte_letters()
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(vocabulary["merges"]):
            self.ranks.setdefault(vocab[left] * self.size + vocab[right], rank)
            self.merged.append(vocab[left + right])
        self.special = {s: array("I", [i]).tobytes() for s, i in vocabulary["special"].items()}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.words = regex.compile(PATTERN).findall

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8")
        packed = array("I", self.merge(raw) if len(raw) <= LONG_WORD else self.merge_long(raw)).tobytes()
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = packed
        return packed

    def merge(self, word: bytes) -> list[int]:
        size, rank_of, merged = self.size, self.ranks.get, self.merged
        parts = [self.byte_ids[b] for b in word]
        ranks = [rank_of(a * size + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != _NONE:
            at = ranks.index(least)
            parts[at] = merged[least]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] * size + parts[at + 1], _NONE)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] * size + parts[at], _NONE)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges in n log n: live pairs wait in a heap by (rank, place)."""
        size, rank_of, merged = self.size, self.ranks.get, self.merged
        parts = [self.byte_ids[b] for b in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (rank, i) for i in range(n - 1) if (rank := rank_of(parts[i] * size + parts[i + 1], _NONE)) != _NONE
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or rank_of(parts[i] * size + parts[j], _NONE) != rank:
                continue
            parts[i], parts[j] = merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    near = rank_of(parts[left] * size + parts[after[left]], _NONE)
                    if near != _NONE:
                        heapq.heappush(heap, (near, left))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> bytes:
        find = self.__getitem__
        if self.cut is None or not self.cut.search(text):
            return b"".join(map(find, self.words(text)))
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out.append(self.special[part] if k % 2 else b"".join(map(find, self.words(part))))
        return b"".join(out)


class Decoder:
    """Text of packed ids; bytes that are no UTF-8 become U+FFFD, ids that the
    vocabulary lacks are skipped."""

    def __init__(self, vocabulary: dict) -> None:
        numbers = {c: b for b, c in byte_letters().items()}
        size = max([*vocabulary["vocab"].values(), *vocabulary["special"].values()], default=-1) + 1
        self.pieces = [b""] * size
        for token, i in vocabulary["vocab"].items():
            raw = [numbers.get(c) for c in token]
            self.pieces[i] = token.encode("utf-8") if None in raw else bytes(raw)
        for token, i in vocabulary["special"].items():
            self.pieces[i] = token.encode("utf-8")

    def decode(self, packed: bytes) -> str:
        ids = array("I", packed)
        try:
            raw = b"".join(map(self.pieces.__getitem__, ids))
        except IndexError:
            raw = b"".join(self.pieces[i] for i in ids if i < len(self.pieces))
        return raw.decode("utf-8", "replace")


def _mapped(df: DataFrame, column: str, outputs: list[T.StructField], arrow: list, keep: bool, make: Callable) -> DataFrame:
    """``df`` with the values that ``make()`` gives for each value of ``column``."""
    drop = None if keep or column in [f.name for f in outputs] else column
    schema = with_outputs(T.StructType([f for f in df.schema.fields if f.name != drop]), outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for whole in batches:
            for batch in pieces(whole, column, PIECE):
                found = [one(v) for v in batch.column(column).to_pylist()]
                for i, (field, kind) in enumerate(zip(outputs, arrow, strict=True)):
                    batch = append_column(batch, field.name, pa.array([f[i] for f in found], kind), drop)
                yield batch

    return df.mapInArrow(run, schema)


def _coders(df: DataFrame, vocabulary: dict) -> Callable[[], tuple[Encoder, Decoder]]:
    """How a task gets its encoder and decoder: they are built once in a worker
    and take the place of the vocabulary's own tables, which are dropped."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def get() -> tuple[Encoder, Decoder]:
        held = shared.value
        if "coders" not in held:
            held["coders"] = (Encoder(held), Decoder(held))
            for name in ("vocab", "merges", "special"):
                held.pop(name)
        return held["coders"]

    return get


def encode(
    df: DataFrame, vocabulary: dict, column: str = "text", into: str = "ids", keep: bool = True, packed: bool = True
) -> DataFrame:
    """``df`` with the token ids of ``column`` as column ``into``: packed as a
    binary, or with ``packed=False`` as array<int>.

    No token is added; the vocabulary's special strings become their ids. A
    null or empty text has no ids (an empty binary or array). Every row is
    encoded whole and on its own: repeated rows repeat, an empty table stays
    empty. A column already named ``into`` is replaced; other columns pass
    through (``keep=False`` drops the text).
    """
    get = _coders(df, vocabulary)

    def make() -> Callable[[str | None], tuple]:
        encoder = get()[0]
        if packed:
            return lambda text: (encoder.encode(text) if text else b"",)
        return lambda text: (array("I", encoder.encode(text) if text else b""),)

    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), True)
    arrow = pa.binary() if packed else pa.list_(pa.int32())
    return _mapped(df, column, [T.StructField(into, kind, not packed)], [arrow], keep, make)


def decode(df: DataFrame, vocabulary: dict, column: str = "ids", into: str = "text", keep: bool = True) -> DataFrame:
    """``df`` with the text of the packed ids in ``column``; null ids give ''."""
    get = _coders(df, vocabulary)

    def make() -> Callable[[bytes | None], tuple]:
        decoder = get()[1]
        return lambda ids: (decoder.decode(ids) if ids else "",)

    return _mapped(df, column, [T.StructField(into, T.StringType(), False)], [pa.string()], keep, make)


def digests(df: DataFrame, vocabulary: dict) -> DataFrame:
    """Per row of (doc_id, text): the number of tokens, the digest of its ids
    and of the text decoded from them. Ids and decoded text stay in the task."""
    get = _coders(df, vocabulary)

    def make() -> Callable[[str | None], tuple]:
        encoder, decoder = get()

        def one(text: str | None) -> tuple:
            ids = encoder.encode(text) if text else b""
            decoded = decoder.decode(ids).encode("utf-8") if ids else b""
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

        return one

    outputs = [T.StructField("n_tokens", T.LongType(), False)]
    outputs += [T.StructField(c, T.StringType(), False) for c in ("ids_sha256", "decoded_sha256")]
    return _mapped(df.select("doc_id", "text"), "text", outputs, [pa.int64(), pa.string(), pa.string()], False, make)
