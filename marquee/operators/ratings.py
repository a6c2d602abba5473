"""Rating tables and the interaction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import canonical_id, stars_to_score

SUBMIT, WATCH = "submit_ratings", "add_watchlist"


def link_ratings(ratings: DataFrame, links: DataFrame) -> DataFrame:
    """Ratings with the catalogue id of their film; unlinked films get null."""
    return ratings.join(links, "movieId", "left").drop("movieId", "timestamp", "imdbId")


def restrict_to_catalog(
    ratings: DataFrame, catalog: DataFrame, item: str = "tmdbId", id_col: str = "id"
) -> DataFrame:
    """Ratings of films in the catalogue."""
    ids = catalog.select(F.col(id_col).alias(item)).distinct()
    return ratings.join(ids, item, "left_semi")


def movie_metadata(movies: DataFrame, links: DataFrame) -> DataFrame:
    return movies.join(links, "movieId", "left")


def denormalize(ratings: DataFrame, movies: DataFrame, item: str = "tmdbId") -> DataFrame:
    """Ratings with film metadata; several films of one id give several rows."""
    return ratings.join(movies, item, "left")


def explode_submissions(submissions: DataFrame) -> DataFrame:
    """One row per rated film of every ratings submission."""
    return (
        submissions.filter(F.col("action") == SUBMIT)
        .select("username", "ts", F.explode("ratings").alias("film", "rating"))
        .filter(F.col("rating").isNotNull())
        .select(
            F.col("username").alias("user_id"),
            canonical_id(F.col("film")).alias("item_id"),
            "rating",
            "ts",
        )
    )


def from_stars(df: DataFrame, raw: str = "stars") -> DataFrame:
    """Star clicks to scores; films without a click are dropped."""
    return df.filter(F.col(raw).isNotNull()).withColumn("rating", stars_to_score(F.col(raw)))


def current(events: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest rating of each user and film.

    A plain aggregate: every task keeps one value per pair before the shuffle, and the
    same code runs on a stream.
    """
    order = F.struct("ts", tie) if tie else F.struct("ts")
    latest = F.max(F.struct(order.alias("at"), F.col("rating")))
    return (
        events.groupBy("user_id", "item_id")
        .agg(latest.alias("last"))
        .select(
            "user_id",
            "item_id",
            F.col("last.rating").alias("rating"),
            F.col("last.at.ts").alias("ts"),
        )
    )


def watchlist(submissions: DataFrame) -> DataFrame:
    """Films each user put on the watchlist, with the first time they did."""
    return (
        submissions.filter(F.col("action") == WATCH)
        .select(
            F.col("username").alias("user_id"), canonical_id(F.col("movie_id")).alias("item_id"), "ts"
        )
        .groupBy("user_id", "item_id")
        .agg(F.min("ts").alias("ts"))
    )


def pending(watched: DataFrame, rated: DataFrame) -> DataFrame:
    """Watched films not rated yet."""
    return watched.join(rated.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def pending_summary(waiting: DataFrame) -> DataFrame:
    """Per user: number of pending films and the one to ask about first."""
    first = F.min(F.struct("ts", "item_id"))
    return (
        waiting.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n_pending"), first.alias("first"))
        .select("user_id", "n_pending", F.col("first.item_id").alias("first_item"))
    )
