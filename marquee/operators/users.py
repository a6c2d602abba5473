"""User accounts and preferences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import json_list

DEFAULT_ROLE = "utilisateur"


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name) != "", F.lit(False))


def valid_users(df: DataFrame) -> DataFrame:
    """Sign-ups with name, e-mail and password, whose name has at least one letter."""
    return df.filter(
        _filled("username")
        & _filled("email")
        & _filled("password")
        & F.col("username").rlike(r"\p{L}")
    )


def parse_users(raw: DataFrame, order: str) -> DataFrame:
    """One row per username that has a password; the last record in ``order`` wins.

    A preference that is not a JSON list empties both lists of that record; an absent
    one is an empty list. The password is not carried on.
    """
    empty = F.array().cast("array<string>")
    films = json_list(F.coalesce("genres_pref", F.lit("[]")))
    docs = json_list(F.coalesce("doc_genres_pref", F.lit("[]")))
    both = films.isNotNull() & docs.isNotNull()
    record = F.struct(
        F.col(order).alias("at"),
        "name",
        "email",
        F.coalesce("role", F.lit(DEFAULT_ROLE)).alias("role"),
        F.when(both, films).otherwise(empty).alias("genres_pref"),
        F.when(both, docs).otherwise(empty).alias("doc_genres_pref"),
    )
    return (
        raw.filter(_filled("username") & _filled("password"))
        .groupBy("username")
        .agg(F.max_by(record, F.col(order)).alias("last"))
        .select("username", "last.*")
        .drop("at")
    )


def to_payload(users: DataFrame) -> DataFrame:
    """Profile update records: preference lists as JSON text."""
    return users.select(
        "username",
        F.to_json("genres_pref").alias("genres_pref"),
        F.to_json("doc_genres_pref").alias("doc_genres_pref"),
        F.lit("update_profile").alias("action"),
    )


def apply_updates(users: DataFrame, updates: DataFrame, order: str = "ts") -> DataFrame:
    """Replace the preference lists by those of each user's latest update."""
    latest = (
        updates.groupBy("username")
        .agg(
            F.max_by(
                F.struct(
                    F.col("genres_pref").alias("films"), F.col("doc_genres_pref").alias("docs")
                ),
                F.col(order),
            ).alias("new")
        )
    )
    return (
        users.join(latest, "username", "left")
        .withColumn("genres_pref", F.coalesce("new.films", "genres_pref"))
        .withColumn("doc_genres_pref", F.coalesce("new.docs", "doc_genres_pref"))
        .drop("new")
    )


def onboarded(ratings: DataFrame, min_ratings: int = 5) -> DataFrame:
    """Users with enough rated films to be recommended to."""
    return (
        ratings.groupBy("user_id")
        .agg(F.countDistinct("item_id").alias("n_rated"))
        .filter(F.col("n_rated") >= min_ratings)
    )
