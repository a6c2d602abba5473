"""Chat formatting: logged snapshots of a conversation collapse to the longest one.

Built-in functions only. Every prefix of a conversation has a rolling hash: the sum of its
turns' hashes, each mixed with its place. Sums add up over blocks of turns, so even a
conversation with most of the rows is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import landed

#: Turn numbers of a block; also the turns of a rendered part.
BLOCK = 256


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): different turns, numbered from 0 by turn (null
    first), role and text, block after block of turn numbers."""
    rows = (
        conversations.filter("conv_id is not null")
        .select("conv_id", "turn", "role", "text")
        .distinct()
        .withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK))
    )
    sizes = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("block")) - F.col("n")
    starts = sizes.select("conv_id", "block", before.alias("first"))
    inside = Window.partitionBy("conv_id", "block").orderBy(
        *[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    )
    return rows.withColumn("k", F.row_number().over(inside) - 1).join(
        starts, ["conv_id", "block"]
    ).select("conv_id", (F.col("first") + F.col("k")).alias("place"), "role", "text")


def prefixes(placed: DataFrame) -> DataFrame:
    """(conv_id, place, h1, h2): two hashes of the conversation up to and with ``place``."""

    def one(seed: int) -> Column:
        # Decimal sums don't overflow; taking the rest keeps 62 bits.
        return F.pmod(F.xxhash64(F.lit(seed), "place", "role", F.isnull("text"), "text"), F.lit(1 << 62))

    rows = placed.select(
        "conv_id",
        "place",
        F.floor(F.col("place") / BLOCK).alias("block"),
        one(1).cast("decimal(20,0)").alias("h1"),
        one(2).cast("decimal(20,0)").alias("h2"),
    )
    names = ("h1", "h2")
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(h).alias(h) for h in names])
    earlier = Window.partitionBy("conv_id").orderBy("block")
    starts = blocks.select(
        "conv_id", "block", *[(F.sum(h).over(earlier) - F.col(h)).alias(f"{h}_before") for h in names]
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("place")
    limit = F.lit(1 << 62).cast("decimal(38,0)")
    return (
        rows.select("conv_id", "block", "place", *[F.sum(h).over(inside).alias(h) for h in names])
        .join(starts, ["conv_id", "block"])
        .select(
            "conv_id",
            "place",
            *[((F.col(h) + F.col(f"{h}_before")) % limit).cast("long").alias(h) for h in names],
        )
    )


def maximal(placed: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that begin no longer one; of equal ones the
    lowest conv_id."""
    hashed = landed(prefixes(placed), "prefixes")
    sizes = hashed.groupBy("conv_id").agg((F.max("place") + 1).alias("n_turns"))
    whole = hashed.join(sizes, "conv_id")
    last = F.col("place") == F.col("n_turns") - 1
    ends = whole.filter(last).groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    begun = whole.filter(~last).select("place", "h1", "h2").distinct()
    return ends.join(begun, ["place", "h1", "h2"], "left_anti").select(
        "conv_id", (F.col("place") + 1).alias("n_turns")
    )


def collapse(conversations: DataFrame) -> DataFrame:
    """Maximal conversations of (conv_id, turn, role, text), rendered.

    A conversation that is the beginning of another, turn by turn in role and text, goes;
    of equal ones the lowest conv_id stays. Result: conv_id, n_turns, part, text: turns as
    ``<|im_start|>role\\ntext<|im_end|>``, one on a line, ``BLOCK`` turns a part, so that
    a part is bounded and the parts of a conversation follow on from each other.

    Turns follow in order of turn number (null first), role and text; their numbers don't
    matter beyond that. Repeated rows count once. A null role is written ``unknown``, a
    null text as empty, though it isn't equal to an empty one. Rows without conv_id
    belong to no conversation and are left out, as are other columns. An empty table gives
    no rows.
    """
    placed = landed(turns(conversations), "turns")
    kept = maximal(placed)
    line = F.concat(
        F.lit("<|im_start|>"),
        F.coalesce("role", F.lit("unknown")),
        F.lit("\n"),
        F.coalesce("text", F.lit("")),
        F.lit("<|im_end|>"),
    )
    return (
        placed.join(kept, "conv_id")
        .select("conv_id", "n_turns", F.floor(F.col("place") / BLOCK).alias("part"), "place", line.alias("line"))
        .groupBy("conv_id", "n_turns", "part")
        .agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))
        .select("conv_id", "n_turns", "part", F.array_join(F.col("lines")["line"], "\n").alias("text"))
    )
