"""Small helpers for operators that read texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 4 << 20


def slices(
    batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``max_bytes`` of ``column``, one row at least.

    A batch counts rows, not bytes; this bounds what a worker holds at a time.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        block = np.cumsum(size.to_numpy(zero_copy_only=False)) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
        # A worker lives on after its task; what it no longer needs goes back.
        pa.default_memory_pool().release_unused()


def strings(column: pa.Array) -> pa.Array:
    """Texts as large strings, nulls as empty texts."""
    return pc.fill_null(column.cast(pa.large_string()), "")


#: A-Z to a-z, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """Large strings with every byte replaced as ``table`` says, which maps ASCII to ASCII
    and leaves other bytes alone. (``ascii_lower`` misreads sliced arrays.)"""
    _, offsets, data = texts.buffers()
    own = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    changed = bytes(data[own[0] : own[-1]]).translate(table) if data else b""
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer((own - own[0]).tobytes()), pa.py_buffer(changed)
    )


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs without ASCII white space of every text, one after the other, and how many
    each text has."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy())
    some = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    # Only the first and the last of a text can be empty.
    owner = np.repeat(np.arange(len(texts)), counts)
    return flat.filter(pa.array(some)), np.bincount(owner[some], minlength=len(texts))


def without(schema: T.StructType, names: Iterable[str]) -> list[T.StructField]:
    """Fields of ``schema`` but for ``names``, which an operator replaces."""
    own = {n.lower() for n in names}
    return [f for f in schema.fields if f.name.lower() not in own]


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts."""
    row = docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).first()
    return int(row["n"])
