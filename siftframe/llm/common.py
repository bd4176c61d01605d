"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words everywhere in this package: runs of anything but ASCII white space.
# ``bytes.split()`` splits at exactly these bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null texts are empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def fold(text: bytes) -> bytes:
    """Lower-case A-Z only."""
    return text.lower()


def fresh(*taken: DataFrame | list[str]) -> str:
    """A prefix for internal columns that no given table uses."""
    names = {n.lower() for t in taken for n in (t if isinstance(t, list) else t.columns)}
    while True:
        prefix = f"_{uuid.uuid4().hex[:8]}_"
        if not any(n.startswith(prefix) for n in names):
            return prefix


def with_outputs(schema: T.StructType, outputs: list[T.StructField]) -> T.StructType:
    """``schema`` with ``outputs`` at its end; an output replaces a column of its name."""
    names = {f.name.lower() for f in outputs}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + outputs)


def append_column(batch: pa.RecordBatch, name: str, values: pa.Array, drop: str | None = None) -> pa.RecordBatch:
    """``batch`` with one more column; columns named ``name`` or ``drop`` go."""
    gone = {n.lower() for n in (name, drop) if n}
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() not in gone]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in keep] + [values], names=[batch.schema.names[i] for i in keep] + [name]
    )


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``most_bytes`` of text each, one row at least."""
    start, size = 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key's text, modulo: the folds of training and held-out rows.
    A null key has no fold (null)."""
    return F.crc32(key.cast("string").cast("binary")) % modulus
