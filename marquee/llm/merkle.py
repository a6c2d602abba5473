"""Merkle manifest of a dataset: digests of rows, of groups and of the whole, with proofs.

Rows are ranked within their group. The digits of a rank, to the base of the tree's fan,
are grouped away one after the other, lowest first: each step nests the structs below in an
array of their parent's struct and takes its digest. This goes on within blocks of bounded
size; the blocks' own digests are the rows of the next round. Proofs come back down by
transforming and exploding the nested arrays, with no joins: a block gets the path above it
by being grouped with it.

Built-in functions only. Texts are read once; after that a row is its digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import landed

FAN = 16
#: Digits grouped away in one round: a block has FAN ** DIGITS rows at most.
DIGITS = 2
PATH = "array<struct<place:int,siblings:array<string>>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def spelled(value: Column) -> Column:
    """Length in bytes, colon and value; a null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row's values."""
    return digest(*[spelled(v) for v in values])


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows (group, ...) with ``rank`` from 0 in their group and the group's size ``n``.

    Rows are written in ranges of (group, order); a row's rank is the number of its group's
    rows in earlier ranges and its place in its own. No group is sorted in one task, and
    rows alike are dealt out too.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = landed(
        numbered.repartitionByRange(parts, "group", *order, "_row").withColumn(
            "_range", F.spark_partition_id()
        ),
        "merkle-ranges",
    )
    sizes = placed.groupBy("group", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("group").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = sizes.select(
        F.col("group").alias("_group"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("group")).alias("n"),
    )
    own = Window.partitionBy("group", "_range").orderBy(*order, "_row")
    return (
        placed.withColumn("_place", F.row_number().over(own) - 1)
        .join(sizes, F.col("group").eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
        .withColumn("rank", F.col("_before") + F.col("_place"))
        .drop("_row", "_range", "_place", "_group", "_of", "_before")
    )


def _nested(nodes: DataFrame, fan: int, digits: int) -> DataFrame:
    """Blocks (group, n, rank, value, below) of nodes (group, n, rank, value, item), where
    ``n`` counts the group's nodes. A level with a single node is the group's last one and
    isn't hashed again."""
    size = fan**digits
    level = nodes.select(
        "group",
        "n",
        F.floor(F.col("rank") / size).alias("block"),
        *[
            (F.floor(F.col("rank") / fan**k) % fan).cast("int").alias(f"d{k}")
            for k in range(digits)
        ],
        "value",
        F.col("item").alias("below"),
    ).repartition("group", "block")
    for k in range(digits):
        rest = [f"d{j}" for j in range(k + 1, digits)]
        run = F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("place"), "value", "below")))
        level = level.groupBy("group", "n", "block", *rest).agg(run.alias("below"))
        parent = digest(F.array_join(F.col("below.value"), ""))
        level = level.withColumn(
            "value", F.when(F.col("n") > fan**k, parent).otherwise(F.col("below")[0]["value"])
        )
    return level.select("group", "n", F.col("block").alias("rank"), "value", "below")


def _unfolded(blocks: DataFrame, fan: int, digits: int) -> DataFrame:
    """Nodes (group, rank, value, item, path, ...) of blocks with the ``path`` above them;
    further columns stay with every node."""
    more = [c for c in blocks.columns if c not in ("group", "n", "rank", "value", "below", "path")]
    level = blocks.select("group", "n", "rank", "path", "below", *more)
    for k in range(digits - 1, -1, -1):
        one = F.col("one")
        level = level.select(
            "group", "n", "rank", "path", "below", *more, F.explode("below").alias("one")
        )
        others = F.filter("below", lambda x: x["place"] != F.col("one.place"))
        step = F.array(
            F.struct(
                one["place"].alias("place"),
                F.transform(others, lambda x: x["value"]).alias("siblings"),
            )
        )
        level = level.select(
            "group",
            "n",
            (F.col("rank") * fan + one["place"]).alias("rank"),
            F.when(F.col("n") > fan**k, F.concat(step, "path")).otherwise(F.col("path")).alias("path"),
            one["below"].alias("below"),
            *([one["value"].alias("value")] if k == 0 else []),
            *more,
        )
    return level.withColumnRenamed("below", "item")


def _met(blocks: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks with the columns of ``above``, one row of each for a key, by grouping."""
    more = [c for c in above.columns if c not in keys]
    both = blocks.unionByName(above, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    grouped = both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rest])
    return grouped.select(*blocks.columns, *more)


def _climb(nodes: DataFrame, fan: int, digits: int) -> list[DataFrame]:
    """Blocks of all rounds, the last with one block a group; each is written once."""
    rounds = [landed(_nested(nodes, fan, digits), "merkle-blocks")]
    largest = rounds[0].agg(F.max("n").alias("n")).first()["n"] or 0
    size = fan**digits
    while largest > size:
        nodes = rounds[-1].select(
            "group",
            F.ceil(F.col("n") / size).alias("n"),
            "rank",
            "value",
            F.lit(None).cast("boolean").alias("item"),
        )
        rounds.append(landed(_nested(nodes, fan, digits), "merkle-blocks"))
        largest = -(-largest // size)
    return rounds


def _descend(rounds: list[DataFrame], tops: DataFrame, fan: int, digits: int) -> DataFrame:
    """Nodes of the first round with their whole path, from ``tops`` (group, path, ...)."""
    above = _met(rounds[-1], tops, ["group"])
    for blocks in reversed(rounds[:-1]):
        nodes = _unfolded(above, fan, digits).drop("item", "value", "n")
        above = _met(blocks, nodes, ["group", "rank"])
    return _unfolded(above, fan, digits)


def manifest(
    rows: DataFrame,
    *,
    group: str = "source",
    order: str = "doc_id",
    value: str = "leaf",
    carry: list[str] | None = None,
    fan: int = FAN,
    digits: int = DIGITS,
) -> DataFrame:
    """Digests and proofs for ``rows`` (order, group, value), where ``value`` is a digest.

    Result: ``order``, ``value``, the columns ``carry``, subroot, root and path. In every
    group the values ascend by ``order``, nulls first, ties by value; while several nodes
    are left, each run of ``fan`` neighbours (the last may be shorter) becomes the digest
    of their digests. What is left is the group's subroot. Subroots by group, null first,
    become the root alike. ``path`` has a step for every digest on the way from a row to
    the root: the node's ``place`` in its run and the ``siblings``, the run's others.

    Null groups are one group; rows alike are leaves of their own; other columns are left
    out, so their names can't clash; an empty table gives no rows. A group of any size is
    ranked by ranges and hashed by blocks of ``fan ** digits`` nodes.
    """
    carry = carry or []
    leaves = landed(
        rows.select(
            F.col(group).alias("group"),
            F.col(order).alias("key"),
            F.col(value).alias("value"),
            F.struct(F.col(order).alias("key"), *[F.col(c).alias(c) for c in carry]).alias("item"),
        ),
        "merkle-leaves",
    )
    rounds = _climb(_ranked(leaves, ["key", "value"]), fan, digits)
    groups = rounds[-1].select(
        F.lit(0).alias("group"),
        F.col("group").alias("key"),
        "value",
        F.struct(F.col("group").alias("key")).alias("item"),
    )
    over = _climb(_ranked(groups, ["key"]), fan, digits)
    top = over[-1].select(
        "group", F.array().cast(PATH).alias("path"), F.col("value").alias("root")
    )
    tops = _descend(over, top, fan, digits).select(
        F.col("item.key").alias("group"), "path", F.col("value").alias("subroot"), "root"
    )
    return _descend(rounds, tops, fan, digits).select(
        F.col("item.key").alias(order),
        F.col("value").alias(value),
        *[F.col("item")[c].alias(c) for c in carry],
        "subroot",
        "root",
        "path",
    )


def folded(value: Column, path: Column) -> Column:
    """The root that ``value`` leads to on a ``path``."""
    return F.aggregate(
        path,
        value,
        lambda own, step: digest(
            F.array_join(F.slice(step["siblings"], F.lit(1), step["place"]), ""),
            own,
            F.array_join(F.slice(step["siblings"], step["place"] + 1, F.size(step["siblings"])), ""),
        ),
    )


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.flatten(F.transform(path, lambda step: step["siblings"]))
