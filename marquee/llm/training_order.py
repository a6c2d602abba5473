"""Token ids in training order: every sequence gets a slot of a keyed permutation, and
ranges of slots become shards of records of one size."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.batches import slices, strings
from marquee.llm.tokens import Encoder, default_tokenizer
from marquee.session import scratch_path

ROUNDS = 6
#: Ids of a record are unsigned 16 bit, little-endian; the vocabulary must fit.
ID = "<u2"


def scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """Where a keyed permutation of 0 .. size - 1 sends ``index`` (or ``back`` again).

    A Feistel network over the smallest even number of bits that holds ``size`` is walked
    until it is below ``size`` again, which needs fewer than four steps on average.
    """
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = scatter(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key & (1 << 63) - 1))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (scatter(left + k) & mask), left
            else:
                left, right = right, left ^ (scatter(right + k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def sequences(docs: DataFrame, tokenizer_file: str | None, end_id: int, length: int) -> DataFrame:
    """(task, place, doc_id, start, n, ids): ids of every document and ``end_id``, cut into
    sequences of ``length``; place numbers them within the task."""
    with open(tokenizer_file or default_tokenizer(), encoding="utf-8") as f:
        rules = docs.sparkSession.sparkContext.broadcast(f.read())
    memory = docs.sparkSession.sparkContext.broadcast({})
    id_field = docs.schema["doc_id"]
    schema = T.StructType(
        [
            T.StructField("task", T.IntegerType()),
            T.StructField("place", T.LongType()),
            T.StructField("doc_id", id_field.dataType),
            T.StructField("start", T.LongType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    types = [pa.int32(), pa.int64(), None, pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(rules.value, memory.value)
        task, place = TaskContext.get().partitionId(), 0
        for part in slices(batches, "text"):
            column = part.column("doc_id")
            flat, bounds = encoder.encode(strings(part.column("text")))
            if len(flat) and int(flat.max()) > 0xFFFF:
                raise ValueError("ids of this tokenizer need more than 16 bits")
            # One end id after each document.
            ends = bounds[1:] + np.arange(len(bounds) - 1)
            joined = np.insert(flat, bounds[1:], end_id).astype(ID)
            rows: list[tuple] = []
            for doc_id, a, b in zip(column.to_pylist(), np.append(0, ends[:-1] + 1), ends + 1, strict=True):
                for start in range(a, b, length):
                    ids = joined[start : min(b, start + length)]
                    rows.append((task, place, doc_id, start - a, len(ids), ids.tobytes()))
                    place += 1
            kinds = [t or column.type for t in types]
            columns = zip(zip(*rows, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def order(
    docs: DataFrame,
    *,
    key: int = 1,
    length: int = 1024,
    per_shard: int = 1 << 14,
    end_id: int = 2,
    tokenizer_file: str | None = None,
) -> DataFrame:
    """All sequences of ``docs`` (doc_id, text) in training order.

    Result: slot (0 .. N - 1, each once), shard (slot // per_shard, one partition each),
    offset (byte of the record in its shard), doc_id, start (ids of the document before
    it), n (ids that count) and ids: a record of ``2 * length`` bytes, unsigned 16 bit,
    little-endian, filled up with zeros. Sequences are numbered in reading order; a
    Feistel permutation keyed with ``key`` gives the slots, so any slot's number can be
    computed back. Partitions are sorted by slot.

    A document is its ids and ``end_id``, so a null or empty text is one short sequence.
    Rows alike each have their own; a null doc_id stays null. Other columns are left out.
    An empty table gives no rows. Tokens are written once, then moved once.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "sequences")
    found = sequences(docs, tokenizer_file, end_id, length)
    found.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    # One row a task: as many as tasks read the documents.
    sizes = found.groupBy("task").agg(F.count(F.lit(1)).alias("m"))
    total = int(sizes.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n")).first()["n"])
    before = F.sum("m").over(Window.orderBy("task")) - F.col("m")
    first = sizes.select("task", before.alias("first"))

    @F.pandas_udf("long")
    def slot_of(index: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(), total, key))

    width = 2 * length
    shards = max(1, -(-total // per_shard))
    placed = (
        found.join(F.broadcast(first), "task")
        .withColumn("slot", slot_of(F.col("first") + F.col("place")))
        .withColumn("shard", F.floor(F.col("slot") / per_shard).cast("int"))
    )
    # Records are filled up after the shuffle.
    return (
        placed.select("slot", "shard", "doc_id", "start", "n", "ids")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("slot")
        .select(
            "slot",
            "shard",
            (F.col("slot") % per_shard * width).alias("offset"),
            "doc_id",
            "start",
            "n",
            F.rpad("ids", F.lit(width), F.lit(b"\x00")).alias("ids"),
        )
    )


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Write each partition of ``order`` as one file ``shard-<number>.bin`` of records.

    ``folder`` is a URI or path that all executors reach. A file appears under its name
    only when it is complete, and with the same bytes whichever attempt wrote it, so lost
    or repeated tasks do no harm.
    Result: shard, n_records, n_bytes, crc32.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        attempt = TaskContext.get().taskAttemptId()
        shard, n, size, crc, out, temporary = None, 0, 0, 0, None, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                shard = batch.column("shard")[0].as_py()
                temporary = f"{base}/.shard-{shard:08d}-{attempt}"
                out = store.open_output_stream(temporary)
            for record in batch.column("ids"):
                data = record.as_py()
                out.write(data)
                crc, n, size = zlib.crc32(data, crc), n + 1, size + len(data)
        if out is not None:
            out.close()
            store.move(temporary, f"{base}/shard-{shard:08d}.bin")
            columns = [[shard], [n], [size], [crc]]
            names = ["shard", "n_records", "n_bytes", "crc32"]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

    return ordered.select("shard", "ids").mapInArrow(
        run, "shard int, n_records long, n_bytes long, crc32 long"
    )


def read_records(data: bytes, offset: int, length: int, count: int = 1) -> np.ndarray:
    """``count`` records of a shard from ``offset`` on, one a row."""
    width = 2 * length
    return np.frombuffer(data[offset : offset + count * width], ID).reshape(-1, length)
