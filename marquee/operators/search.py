"""Catalogue search: filters, facets, seeded samples, titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.functions import duration_bucket, fold_text, is_wanted, random_order
from marquee.operators.titles import first_per_key
from marquee.sizing import settle


#: Bytes of search keys in a partition. A task sorts all matches of its titles, some hundred
#: times as many bytes, so partitions grow in number and not in size.
PART_BYTES = 1 << 20


def list_contains(column: str, value: str) -> Column:
    """Whether a list holds ``value``; a list with nulls or a null list gives false."""
    return F.coalesce(F.array_contains(column, value), F.lit(False))


def filter_catalog(
    df: DataFrame,
    genre: str | None = None,
    year: int | None = None,
    language: str | None = None,
    actor: str | None = None,
    producer: str | None = None,
    duration: str | None = None,
) -> DataFrame:
    """Rows that meet every choice made; None, "Tous" and "Toutes" choose nothing."""
    if is_wanted(genre):
        df = df.filter(list_contains("genres", genre))
    if is_wanted(actor):
        df = df.filter(list_contains("actor_actress", actor))
    if is_wanted(producer):
        df = df.filter(list_contains("producer", producer))
    if is_wanted(year):
        df = df.filter(F.col("startYear") == year)
    if is_wanted(language):
        df = df.filter(F.col("original_language") == language)
    if is_wanted(duration):
        df = df.filter(duration_bucket(F.col("runtimeMinutes")) == duration)
    return df


def documentaries(df: DataFrame) -> DataFrame:
    return df.filter(list_contains("genres", "Documentary"))


def facet_values(
    df: DataFrame, column: str, desc: bool = False, in_order: bool = True
) -> DataFrame:
    """Distinct values offered for a filter, sorted for display unless not ``in_order``;
    list columns by element, no nulls."""
    is_list = df.schema[column].dataType.typeName() == "array"
    value = F.explode(column) if is_list else F.col(column)
    order = F.col("value").desc() if desc else F.col("value").asc()
    values = df.select(value.alias("value")).dropna().distinct()
    return values.orderBy(order) if in_order else values


def sample_n(df: DataFrame, n: int, seed: int | str, id_col: str) -> DataFrame:
    """``n`` rows without replacement, the same ones for the same seed.

    Runs as a top-n, not as a full sort.
    """
    return df.orderBy(random_order(seed, F.col(id_col)), F.col(id_col)).limit(n)


def filter_search(
    df: DataFrame, n: int = 20, seed: int | str = 42, id_col: str = "id", **choices
) -> DataFrame:
    """Filtered catalogue: ``n`` random matches, each with the number of all matches."""
    found = filter_catalog(df, **choices)
    total = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sample_n(found, n, seed, id_col).withColumn("n_found", total)


def _grams(key: Column, size: int) -> Column:
    """Distinct substrings of ``size`` characters, empty for shorter texts."""
    last = F.length(key) - size + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(key, i, F.lit(size))))


def _spread(entries: DataFrame) -> DataFrame:
    """``entries`` dealt to partitions whose number follows the size of their keys, however
    few files or row groups they are read from."""
    row = entries.agg(F.sum(F.octet_length("key").cast("bigint")).alias("n")).first()
    return entries.repartition(max(1, -(-(row["n"] or 0) // PART_BYTES)), "row_order", "title")


def _indexed(entries: DataFrame, gram_size: int) -> DataFrame:
    """A row for each distinct gram of 1 to ``gram_size`` characters of each key."""
    return entries.withColumn(
        "gram",
        F.explode_outer(
            F.concat(
                *[
                    F.coalesce(_grams(F.col("key"), size), F.array().cast("array<string>"))
                    for size in range(1, gram_size + 1)
                ]
            )
        ),
    ).filter(F.col("gram").isNotNull())


def _probe_grams(queries: DataFrame, titles: DataFrame, gram_size: int) -> DataFrame:
    """The rarest gram of every query.

    A title that contains the query contains each of the query's grams, so joining on
    one of them loses nothing; the rarest one keeps common word parts out of the join.
    """
    size = F.least(F.length("q_key"), F.lit(gram_size))
    offered = queries.select(
        "query_id",
        F.explode(
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.length("q_key") - size + 1),
                    lambda i: F.substring("q_key", i, size),
                )
            )
        ).alias("gram"),
    )
    wanted = settle(offered.select("gram").distinct(), "query-grams")
    counts = titles.join(wanted, "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.struct(F.coalesce(F.col("n"), F.lit(0)), F.col("gram"))
    return (
        offered.join(counts, "gram", "left")
        .groupBy("query_id")
        .agg(F.min(rarity).getField("gram").alias("gram"))
    )


def title_search(
    catalog: DataFrame,
    queries: DataFrame,
    limit: int = 20,
    key: str = "title_search",
    title: str = "title_final",
    row_order: str = "row_order",
    gram_size: int = 3,
) -> DataFrame:
    """Titles for every query: exact, then starting with it, then containing it.

    ``queries`` has ``query_id`` and ``query``. Exact matches come in catalogue order
    (``row_order``), the other tiers by title. A query without letters or digits finds
    nothing. Candidates come from an equi-join on character grams, so no query is ever
    compared with the whole catalogue. The matches of ``PART_BYTES`` of keys are sorted in
    a task, which keeps ``limit`` of each query.
    """
    asked = queries.select(
        "query_id", fold_text(F.col("query")).alias("q_key")
    ).filter(F.length("q_key") > 0)
    entries = catalog.select(
        F.col(row_order).alias("row_order"), F.col(title).alias("title"), F.col(key).alias("key")
    )
    probes = settle(
        asked.join(_probe_grams(asked, _indexed(entries, gram_size), gram_size), "query_id"), "probes"
    )
    tier = (
        F.when(F.col("key") == F.col("q_key"), 1)
        .when(F.col("key").startswith(F.col("q_key")), 2)
        .when(F.col("key").contains(F.col("q_key")), 3)
    )
    matches = (
        _indexed(_spread(entries), gram_size)
        .join(probes, "gram")
        .withColumn("tier", tier)
        .filter(F.col("tier").isNotNull())
    )
    w = Window.partitionBy("query_id").orderBy(
        "tier", F.when(F.col("tier") > 1, F.lower("title")), "row_order"
    )
    return (
        matches.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= limit)
        .select("query_id", "position", "tier", "title", "row_order")
    )


def lookup_title(
    catalog: DataFrame,
    titles: DataFrame,
    title: str = "title_final",
    row_order: str = "row_order",
) -> DataFrame:
    """First catalogue row whose lower-case title is the asked one.

    ``titles`` has ``query_id`` and ``query``.
    """
    asked = titles.select("query_id", F.lower(F.trim("query")).alias("_asked"))
    hits = catalog.join(settle(asked, "titles"), F.lower(F.col(title)) == F.col("_asked"))
    return first_per_key(hits, ["query_id"], [row_order]).drop("_asked")
