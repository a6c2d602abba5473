"""Localised titles and the searchable catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.functions import fold_text

# Catalogue columns the search does not need.
SEARCH_UNUSED = (
    "primaryTitle",
    "originalTitle",
    "averageRating",
    "numVotes",
    "popularity",
    "writers",
    "directors",
    "production_companies_name",
    "budget",
    "revenue",
    "overview",
)


def localized(akas: DataFrame, region: str = "FR") -> DataFrame:
    """Titles of one region. ``ordering`` is kept: the first title is chosen by it."""
    return akas.filter(F.col("region") == region).select("titleId", "ordering", "title", "region")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row of each key in ``order``, which should be total.

    Spark prunes to one row per key in every task before the shuffle, so a hot key
    sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def add_title_final(
    catalog: DataFrame,
    titles: DataFrame,
    key: str = "tconst",
    title_key: str = "titleId",
    title: str = "title",
    fallback: str = "primaryTitle",
) -> DataFrame:
    """Localised title where there is one, else the primary title."""
    chosen = titles.select(
        F.col(title_key).alias("_title_key"), F.col(title).alias("_title_localized")
    )
    return (
        catalog.join(chosen, F.col(key) == F.col("_title_key"), "left")
        .withColumn("title_final", F.coalesce("_title_localized", fallback))
        .drop("_title_key", "_title_localized")
    )


def search_catalog(catalog: DataFrame, akas: DataFrame, region: str = "FR") -> DataFrame:
    """Catalogue for searching: final title, its folded key, no unused columns."""
    titles = first_per_key(localized(akas, region), ["titleId"], ["ordering", "title"])
    return (
        add_title_final(catalog, titles)
        .drop(*SEARCH_UNUSED)
        .withColumn("title_search", fold_text(F.col("title_final")))
    )
