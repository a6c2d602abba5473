"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import landed


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of ``edges`` (a, b): one comp for each component.

    Every node takes its lowest neighbour's lowest neighbour, if lower than itself, as
    its label; labels become the nodes of a smaller graph, until no edge is left. Edges
    and labels of each round are written, so a lost executor costs no earlier round. Hot
    nodes are pre-aggregated in every task, and their joins split by adaptive execution.
    """
    edges = landed(edges.filter("a != b").select("a", "b").distinct(), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
        upper = up.select(F.col("a").alias("p"), F.col("p").alias("comp"))
        labels = landed(up.join(upper, "p").select(F.col("a").alias("node"), "comp"), "labels")
        rounds.append(labels)
        for side in ("a", "b"):
            moved = labels.select(F.col("node").alias(side), "comp")
            other = "b" if side == "a" else "a"
            edges = edges.join(moved, side).select(F.col("comp").alias(side), other)
        edges = landed(
            edges.filter("a != b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "edges",
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    found = rounds[0]
    for labels in rounds[1:]:
        moved = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        found = found.join(moved, "comp", "left").select(
            "node", F.coalesce("next", "comp").alias("comp")
        )
    return landed(found, "components")
