"""The catalogue pipeline from source tables to searchable and comparable films."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import compact_tokens, split_list
from marquee.operators import catalog, features, text, titles
from marquee.sources.schemas import LIST_COLUMNS


def build_catalog(
    basics: DataFrame,
    crew: DataFrame,
    ratings: DataFrame,
    principals: DataFrame,
    names: DataFrame,
    extra: DataFrame,
    dedup: bool = False,
    **gate,
) -> DataFrame:
    """Final catalogue from the source tables.

    Language and completeness are judged before any name is looked up. Credits stay one
    row each until the films that stay are known and the names are found; lists are made
    last, one row per title.
    """
    base = catalog.build_base(basics, crew, ratings, **gate)
    base = base.withColumn("genres", split_list(F.col("genres")))
    full = catalog.enrich(base, extra, dedup)
    films = catalog.drop_incomplete(catalog.keep_languages(full))
    titles_kept = films.select("tconst").distinct()
    credits = catalog.select_credits(principals).join(titles_kept, "tconst", "left_semi")
    cast = catalog.cast_lists(catalog.name_credits(credits, names))
    crews = catalog.resolve_names(
        crew.join(titles_kept, "tconst", "left_semi").select("tconst", "directors", "writers"),
        names,
        ["directors", "writers"],
    )
    people = catalog.add_cast(crews, cast)
    return catalog.conform(films.drop("directors", "writers").join(people, "tconst", "left"))


def build_text_columns(films: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """Catalogue with the normalised overview and a compact text per list column."""
    normal = text.normalize(films, "overview", "NLP", lemmas)
    return normal.withColumns({f"{c}_clean": compact_tokens(F.col(c)) for c in LIST_COLUMNS})


def build_features(films: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """Weighted feature table of a catalogue."""
    return features.assemble(build_text_columns(films, lemmas))


def build_search(films: DataFrame, akas: DataFrame, region: str = "FR") -> DataFrame:
    """Searchable catalogue."""
    return titles.search_catalog(films, akas, region)
