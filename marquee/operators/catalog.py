"""Catalogue ETL: base films, cast lists, names, enrichment, final schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import concat_lists, parse_literal_list, split_list, to_long
from marquee.sources.schemas import CATALOG

# Credit categories, kept languages, unused enrichment columns.
CATEGORIES = ("actor", "actress", "producer")
LANGUAGES = ("en", "fr", "de", "es", "it", "nl", "pt", "fi", "ga", "ja")
ENRICHMENT_UNUSED = (
    "adult",
    "genres",
    "homepage",
    "backdrop_path",
    "original_title",
    "production_countries",
    "release_date",
    "runtime",
    "spoken_languages",
    "status",
    "title",
    "video",
    "vote_average",
    "vote_count",
    "tagline",
    "production_companies_country",
)
BASE_COLUMNS = (
    "tconst",
    "primaryTitle",
    "originalTitle",
    "startYear",
    "runtimeMinutes",
    "genres",
    "directors",
    "writers",
    "averageRating",
    "numVotes",
)


def quality_gate(
    df: DataFrame,
    min_year: int = 1990,
    title_type: str = "movie",
    min_rating: float = 6.5,
    min_runtime: int = 75,
    min_votes: int = 500,
) -> DataFrame:
    """Films above every threshold (all strict). A value that is no number fails."""
    return df.filter(
        (F.col("startYear").try_cast("int") > min_year)
        & (F.col("titleType") == title_type)
        & (F.col("averageRating").try_cast("float") > F.lit(min_rating).cast("float"))
        & (F.col("runtimeMinutes").try_cast("int") > min_runtime)
        & (F.col("numVotes").try_cast("int") > min_votes)
    )


def build_base(basics: DataFrame, crew: DataFrame, ratings: DataFrame, **gate) -> DataFrame:
    """Titles with crew and rating, gated. Each gate predicate reads one source, so
    all of them run below the joins."""
    joined = basics.join(crew, "tconst", "inner").join(ratings, "tconst", "inner")
    return quality_gate(joined, **gate).select(*BASE_COLUMNS)


def select_credits(
    principals: DataFrame,
    key: str = "tconst",
    person: str = "nconst",
    category: str = "category",
    ordering: str = "ordering",
    categories: tuple[str, ...] = CATEGORIES,
) -> DataFrame:
    """Credits of the wanted categories, a row each: the grain to join and filter in."""
    return principals.filter(F.col(category).isin(*categories)).select(
        key, category, ordering, person
    )


def name_credits(
    credits: DataFrame, names: DataFrame, person: str = "nconst", name: str = "primaryName"
) -> DataFrame:
    """``credits`` with the people's names in place of their ids; an unknown id is null."""
    people = (
        names.filter(F.col(person).isNotNull())
        .groupBy(F.col(person).cast("string").alias("_ref"))
        .agg(F.max(name).alias("_label"))
    )
    known = credits.withColumn("_ref", F.col(person).cast("string")).join(people, "_ref", "left")
    return known.select(
        *[F.col("_label").alias(c) if c == person else F.col(c) for c in credits.columns],
        F.col("_ref").alias("ref"),
    )


def cast_lists(
    credits: DataFrame,
    key: str = "tconst",
    person: str = "nconst",
    category: str = "category",
    ordering: str = "ordering",
    categories: tuple[str, ...] = CATEGORIES,
) -> DataFrame:
    """One row per title: its people of every category in credit order, for display.

    Equal ``ordering`` goes by id, which is in ``ref`` where names have taken its place.
    """
    tie = "ref" if "ref" in credits.columns else person
    entry = F.struct(F.col(ordering), F.col(tie).alias("tie"), F.col(person).alias("shown"))
    lists = credits.groupBy(key).agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col(category) == name, entry))).alias(name)
            for name in categories
        ]
    )
    return lists.select(
        key, *[F.transform(name, lambda e: e["shown"]).alias(name) for name in categories]
    )


def principals_pivot(principals: DataFrame, **columns) -> DataFrame:
    """One list of people per title and category, in credit order, categories as columns."""
    return cast_lists(select_credits(principals, **columns), **columns)


def add_cast(base: DataFrame, pivot: DataFrame, key: str = "tconst") -> DataFrame:
    return base.join(pivot, key, "left")


def _numbered_refs(name: str) -> Column:
    return F.transform(
        F.coalesce(F.col(name).cast("array<string>"), F.array().cast("array<string>")),
        lambda x, i: F.struct(F.lit(name).alias("list"), i.alias("pos"), x.alias("ref")),
    )


def resolve_names(
    df: DataFrame,
    names: DataFrame,
    cols: list[str],
    key: str | list[str] = "tconst",
    person: str = "nconst",
    name: str = "primaryName",
) -> DataFrame:
    """Replace ids by names in the list columns ``cols``; order kept, unknown id null.

    The lists of all columns are looked up together: one join with the people table
    and one regrouping, instead of one of each per column. The ``key`` columns must
    identify a row. Comma texts are split first; a null list stays null.
    """
    keys = [key] if isinstance(key, str) else list(key)
    as_list = {
        c: F.col(c) if df.schema[c].dataType.typeName() == "array" else split_list(F.col(c), False)
        for c in cols
    }
    lists = df.select(
        *[c for c in df.columns if c not in cols], *[as_list[c].alias(c) for c in cols]
    )
    tagged = F.flatten(F.array(*[_numbered_refs(c) for c in cols]))
    refs = (
        lists.select(*keys, F.explode_outer(tagged).alias("e"))
        .filter(F.col("e").isNotNull())
        .select(*keys, "e.*")
    )
    people = (
        names.filter(F.col(person).isNotNull())
        .groupBy(F.col(person).cast("string").alias("ref"))
        .agg(F.max(name).alias("label"))
    )
    entry = F.struct("pos", "label")
    named = (
        refs.join(people, "ref", "left")
        .groupBy(*keys)
        .agg(
            *[
                F.array_sort(F.collect_list(F.when(F.col("list") == c, entry))).alias(f"_{c}")
                for c in cols
            ]
        )
    )
    return lists.join(named, keys, "left").select(
        *[
            F.when(
                F.col(c).isNotNull(),
                F.coalesce(
                    F.transform(f"_{c}", lambda e: e["label"]), F.array().cast("array<string>")
                ),
            ).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )


def enrich(
    catalog: DataFrame, extra: DataFrame, dedup: bool = False, unused=ENRICHMENT_UNUSED
) -> DataFrame:
    """Left join with the enrichment table on its IMDb id.

    Several rows for one id give several films, unless ``dedup`` keeps the lowest id.
    """
    slim = extra.drop(*unused).withColumnRenamed("imdb_id", "tconst")
    if dedup:
        rest = [c for c in slim.columns if c != "tconst"]
        slim = (
            slim.groupBy("tconst")
            .agg(F.min_by(F.struct(*rest), F.struct("id")).alias("row"))
            .select("tconst", "row.*")
        )
    return catalog.join(slim, "tconst", "left")


def keep_languages(
    df: DataFrame, languages=LANGUAGES, column: str = "original_language"
) -> DataFrame:
    """Rows in one of ``languages``; a null language is dropped."""
    return df.filter(F.col(column).isin(*languages))


def drop_incomplete(df: DataFrame, subset=("poster_path", "overview")) -> DataFrame:
    return df.dropna(subset=list(subset))


def _as_list(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() == "array":
        return concat_lists(F.col(name))
    if name == "genres":
        return split_list(F.col(name))
    return parse_literal_list(F.col(name))


def conform(df: DataFrame) -> DataFrame:
    """Typed lists, actors and actresses merged, the fixed columns in their order."""
    made = {
        "actor_actress": concat_lists(_as_list(df, "actor"), _as_list(df, "actress")),
        "budget": to_long(F.col("budget")),
        "revenue": to_long(F.col("revenue")),
        "numVotes": to_long(F.col("numVotes")),
        "startYear": F.col("startYear").try_cast("int"),
        "runtimeMinutes": F.col("runtimeMinutes").try_cast("int"),
        "averageRating": F.col("averageRating").try_cast("double"),
    }
    for name, kind in CATALOG.items():
        if kind.startswith("array") and name not in made:
            made[name] = _as_list(df, name)
    return df.select(
        *[made.get(name, F.col(name)).cast(kind).alias(name) for name, kind in CATALOG.items()]
    )
