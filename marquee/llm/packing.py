"""Cost-balanced packing of documents into training sequences.

Each task packs the documents it reads, block after block, so nothing is shuffled and a
task holds one block of tokens at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.batches import slices, strings
from marquee.llm.tokens import Encoder, default_tokenizer


def place(
    lengths: list[int], capacities: list[int], linear: float, quadratic: float
) -> Iterator[tuple[int, int, int, int, int]]:
    """Assign pieces to sequences: yields (document, start, length, sequence, offset).

    The longest piece goes first, to the sequence of the lowest cost that has room for
    all of it; a piece of n tokens costs ``linear * n + quadratic * n * n``. Where no
    sequence has room, the piece is cut to fill up the cheapest one that isn't full, and
    the rest waits its turn by its length. Ties go to the lower number.
    """
    room = np.array(capacities, np.int64)
    cost = np.zeros(len(room))
    heap = [(-n, k, 0) for k, n in enumerate(lengths) if n]
    heapq.heapify(heap)
    left = int(room.sum())
    while heap and left:
        n, k, start = heapq.heappop(heap)
        n = -n
        fits = room >= n
        if not fits.any():
            fits = room > 0
        j = int(np.argmin(np.where(fits, cost, np.inf)))
        take = min(n, int(room[j]))
        yield k, start, take, j, capacities[j] - int(room[j])
        room[j] -= take
        left -= take
        cost[j] += linear * take + quadratic * take * take
        if take < n:
            heapq.heappush(heap, (take - n, k, start + take))


def powers(n: int) -> list[int]:
    """Powers of two that add up to ``n``, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(
    docs: DataFrame,
    *,
    tokenizer_file: str | None = None,
    end_id: int = 2,
    capacity: int = 4096,
    block_tokens: int = 1 << 21,
    linear: float = 1.0,
    quadratic: float = 1.0 / 4096,
) -> DataFrame:
    """Pieces of all documents of (doc_id, text) and their places in sequences.

    Every document is its token ids and then ``end_id``. Result: doc_id, start (ids of
    the document before the piece), length, ids (binary, little-endian unsigned 32 bit),
    doc_tokens (with the end id), sequence_id, offset (in the sequence, without gaps).
    Each id is in exactly one piece. A document's full sequences are cut off first. A
    block of ``block_tokens`` opens as many sequences as it fills; what is left goes to
    the next block, and at the end of a task to sequences whose lengths are powers of
    two, so that no sequence needs padding.

    A null or empty text is its end id alone. Rows alike are packed as often as they
    occur; a null doc_id stays null. Other columns are left out. An empty table gives no
    rows. Sequence ids are unique: partition number times 2**32 and a counter.
    """
    with open(tokenizer_file or default_tokenizer(), encoding="utf-8") as f:
        rules = docs.sparkSession.sparkContext.broadcast(f.read())
    memory = docs.sparkSession.sparkContext.broadcast({})
    id_field = docs.schema["doc_id"]
    schema = T.StructType(
        [
            T.StructField("doc_id", id_field.dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(rules.value, memory.value)
        next_id = TaskContext.get().partitionId() << 32
        id_type = None
        pool: list[tuple] = []  # doc_id, its ids, start of what is not yet placed
        held = 0
        rows: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [id_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            out = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names=schema.names)

        def add(doc_id, ids, start, length, sequence, offset) -> None:
            part = ids[start : start + length].tobytes()
            rows.append((doc_id, start, length, part, len(ids), sequence, offset))

        def fill(capacities: list[int]) -> None:
            nonlocal pool, held, next_id
            done = [start for _, _, start in pool]
            lengths = [len(ids) - start for _, ids, start in pool]
            for k, at, n, j, offset in place(lengths, capacities, linear, quadratic):
                doc_id, ids, start = pool[k]
                add(doc_id, ids, start + at, n, next_id + j, offset)
                done[k] += n
            next_id += len(capacities)
            pool = [
                (d, ids, at) for (d, ids, _), at in zip(pool, done, strict=True) if at < len(ids)
            ]
            held = sum(len(ids) - at for _, ids, at in pool)

        for part in slices(batches, "text"):
            column = part.column("doc_id")
            id_type = column.type
            flat, bounds = encoder.encode(strings(part.column("text")))
            for doc_id, a, b in zip(column.to_pylist(), bounds, bounds[1:], strict=False):
                ids = np.append(flat[a:b], np.uint32(end_id)).astype("<u4")
                full = len(ids) // capacity
                for k in range(full):
                    add(doc_id, ids, k * capacity, capacity, next_id, 0)
                    next_id += 1
                if len(ids) > full * capacity:
                    pool.append((doc_id, ids, full * capacity))
                    held += len(ids) - full * capacity
                if held >= block_tokens:
                    fill([capacity] * (held // capacity))
                    yield emit()
            if rows:
                yield emit()
        if pool:
            fill([capacity] * (held // capacity) + powers(held % capacity))
            yield emit()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
