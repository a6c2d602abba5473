"""Size checks that decide between a broadcast and a shuffled join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import landed

BROADCAST_BYTES = 64 * 1024 * 1024


def serialized_bytes(df: DataFrame) -> int:
    """Exact size of the rows written out as JSON, computed as one aggregate."""
    row = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()
    return int(row["n"] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring ``df``.

    Above the bound ``df`` is returned unchanged: the same equi-join then runs as a
    shuffled join, whose hot keys adaptive execution splits.
    """
    return F.broadcast(df) if serialized_bytes(df) <= max_bytes else df


def settle(df: DataFrame, name: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Write a side that is expected to be small once, measure it, and hint a broadcast
    if it is; measuring and joining then read the result instead of computing it twice."""
    return broadcast_if_small(landed(df, name), max_bytes)


def block_count(df: DataFrame, rows_per_block: int) -> Column:
    """Number of blocks of about ``rows_per_block`` rows, as a scalar subquery."""
    return df.select(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(rows_per_block)))
        .cast("int")
        .alias("n_blocks")
    ).scalar()
