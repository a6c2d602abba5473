"""Recommendations per user: what is new, what is seen, and surprises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.functions import canonical_id
from marquee.operators.ranking import number_in_group, pick_one
from marquee.operators.search import documentaries


def _own_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id", canonical_id(F.col("item_id")).alias("_item")).agg(
        F.max("rating").alias("_rating")
    )


def exclude_seen(recs: DataFrame, ratings: DataFrame) -> DataFrame:
    """Recommendations of items the user has not rated, ids compared in canonical form."""
    seen = _own_ratings(ratings).select("user_id", "_item")
    return (
        recs.withColumn("_item", canonical_id(F.col("item_id")))
        .join(seen, ["user_id", "_item"], "left_anti")
        .drop("_item")
    )


def annotate_seen(recs: DataFrame, ratings: DataFrame) -> DataFrame:
    """Recommendations with ``seen`` and the user's own score as text (``?`` if none)."""
    return (
        recs.withColumn("_item", canonical_id(F.col("item_id")))
        .join(_own_ratings(ratings), ["user_id", "_item"], "left")
        .withColumn("seen", F.col("_rating").isNotNull())
        .withColumn("own_score", F.coalesce(F.col("_rating").cast("string"), F.lit("?")))
        .drop("_item", "_rating")
    )


def surprise(recs: DataFrame, ratings: DataFrame, seed: int | str = 42) -> DataFrame:
    """One random recommendation per user, an unseen one unless all are seen."""
    marked = annotate_seen(recs, ratings)
    mine = Window.partitionBy("user_id")  # at most the k recommendations of one user
    eligible = marked.withColumn("_new", F.max(~F.col("seen")).over(mine)).filter(
        ~F.col("seen") | ~F.col("_new")
    )
    return pick_one(eligible, "user_id", "item_id", seed).select("user_id", "item_id", "seen")


def _draw(seed: int | str, user: str, total: Column) -> Column:
    """A number in 0..total-1 from a hash of the user."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(user).cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") % total


def _as_set(genres: Column) -> Column:
    """Sorted distinct genres; null as empty."""
    names = F.coalesce(genres, F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.array_compact(names)))


def surprise_documentary(
    catalog: DataFrame, users: DataFrame, seed: int | str = 42, id_col: str = "id"
) -> DataFrame:
    """One random documentary per user among those of the user's themes.

    Without preferences, or when none matches, any documentary may come. Every match is
    equally likely, yet users are never paired with films: films of the same genre list
    are counted and numbered, each distinct set of preferences gets the ranges of the
    genre lists it matches, and a user's draw falls into one range, which names the
    film by list and number.
    """
    docs = number_in_group(
        documentaries(catalog).select(
            F.col(id_col).alias("item_id"), _as_set(F.col("genres")).alias("genre_list")
        ),
        "genre_list",
        "item_id",
    )
    lists = docs.groupBy("genre_list").agg(F.count(F.lit(1)).alias("n"))
    themes = lists.select("genre_list", "n", F.explode("genre_list").alias("theme"))
    asked = users.select("user_id", _as_set(F.col("doc_genres_pref")).alias("prefs"))
    sets = asked.select("prefs").distinct()
    matches = (
        sets.select("prefs", F.explode("prefs").alias("theme"))
        .join(themes, "theme")
        .select("prefs", "genre_list", "n")
        .distinct()
    )
    anything = (
        sets.join(matches, "prefs", "left_anti")
        .withColumn("theme", F.lit("Documentary"))
        .join(themes, "theme")
        .select("prefs", "genre_list", "n")
    )
    running = Window.partitionBy("prefs").orderBy("genre_list")
    ranges = matches.unionByName(anything).withColumn("upto", F.sum("n").over(running))
    offers = ranges.groupBy("prefs").agg(
        F.array_sort(F.collect_list(F.struct("upto", "n", "genre_list"))).alias("offers"),
        F.sum("n").alias("total"),
    )
    drawn = asked.join(offers, "prefs").withColumn("draw", _draw(seed, "user_id", F.col("total")))
    hit = F.filter("offers", lambda o: o["upto"] > F.col("draw")).getItem(0)
    return (
        drawn.withColumn("hit", hit)
        .select(
            "user_id",
            F.col("hit.genre_list").alias("genre_list"),
            (F.col("draw") - (F.col("hit.upto") - F.col("hit.n"))).alias("position"),
        )
        .join(docs, ["genre_list", "position"])
        .select("user_id", "item_id", "genre_list")
    )
