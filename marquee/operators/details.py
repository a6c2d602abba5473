"""Film details as shown: nested records flattened to one row per film."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import canonical_id, image_url, to_long, truncate, year_text

NO_OVERVIEW = "Aucun résumé."


def numeric_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is a number, with the id in canonical form; others have no details."""
    known = df.filter(to_long(F.col(id_col).cast("string")).isNotNull())
    return known.withColumn(id_col, canonical_id(F.col(id_col)))


def flatten(
    details: DataFrame,
    credits: DataFrame,
    english: DataFrame | None = None,
    max_cast: int = 5,
    max_overview: int = 400,
) -> DataFrame:
    """Details and credits of each film in display form; records without id are dropped.

    A blank overview is taken from ``english`` (``id``, ``overview``) where that is
    given and has one, else a fixed text stands in. The full text stays in
    ``overview``; ``overview_short`` is cut at ``max_overview`` characters.
    """
    credit_lists = credits.select(
        "id",
        F.transform(
            F.filter("crew", lambda m: m["job"] == "Director"), lambda m: m["name"]
        ).alias("directors"),
        F.transform(F.slice("cast", 1, max_cast), lambda a: a["name"]).alias("actors"),
    )
    films = details.filter(F.col("id").isNotNull()).join(credit_lists, "id", "left")
    own = F.when(F.trim("overview") != "", F.col("overview"))
    if english is not None:
        films = films.join(english.select("id", F.col("overview").alias("_english")), "id", "left")
        own = F.coalesce(own, F.col("_english"))
    empty = F.array().cast("array<string>")
    return films.withColumn("_text", F.coalesce(own, F.lit(NO_OVERVIEW))).select(
        canonical_id(F.col("id")).alias("id"),
        "title",
        year_text(F.col("release_date")).alias("year"),
        F.coalesce(
            F.array_join(F.transform("genres", lambda g: g["name"]), ", "), F.lit("")
        ).alias("genre_names"),
        "runtime",
        F.coalesce("directors", empty).alias("directors"),
        F.coalesce("actors", empty).alias("actors"),
        image_url(F.col("poster_path")).alias("poster_url"),
        F.col("_text").alias("overview"),
        truncate(F.col("_text"), max_overview).alias("overview_short"),
    )
