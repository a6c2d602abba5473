"""Numbers shown about the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def genre_counts(df: DataFrame, column: str = "genres") -> DataFrame:
    """Films per genre, most frequent first."""
    return (
        df.select(F.explode(column).alias("genre"))
        .dropna()
        .groupBy("genre")
        .agg(F.count(F.lit(1)).alias("films"))
        .orderBy(F.desc("films"), "genre")
    )


def _tagged(values: Column, name: str) -> Column:
    """Each of ``values`` as a struct of ``column`` and value."""
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("column"), v.alias("value")))


def distinct_sketches(df: DataFrame, part: str, columns: list[str], lg_k: int = 12) -> DataFrame:
    """(part, column, sketch): a sketch of the distinct values of each column in each part.

    Sketches of parts that are stored add up (``distinct_estimates``): a new part costs a
    pass over its own rows alone. List columns count by element, nulls don't.
    """
    lists = []
    for c in columns:
        is_list = df.schema[c].dataType.typeName() == "array"
        values = F.col(c) if is_list else F.array(c)
        texts = F.coalesce(values.cast("array<string>"), F.array().cast("array<string>"))
        lists.append(_tagged(texts, c))
    flat = df.select(F.col(part).alias("part"), F.explode(F.flatten(F.array(*lists))).alias("v"))
    return (
        flat.filter(F.col("v.value").isNotNull())
        .groupBy("part", "v.column")
        .agg(F.hll_sketch_agg("v.value", lg_k).alias("sketch"))
    )


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(column, n): about how many values each column has in all parts together. The
    standard error is 1.04 / sqrt(2 ** lg_k), 1.6 % at 12."""
    merged = sketches.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column", F.hll_sketch_estimate("sketch").alias("n"))


def catalog_metrics(
    df: DataFrame,
    title: str = "title_final",
    cast: str = "actor_actress",
    language: str = "original_language",
) -> DataFrame:
    """One row: distinct titles, cast entries, distinct cast members, languages.

    ``cast_rows`` counts list entries and one for a film without any, read off the
    list sizes; only ``cast_distinct`` unpacks the lists.
    """
    people = df.select(F.explode(cast).alias("person"))
    return df.agg(
        F.countDistinct(title).alias("titles"),
        F.sum(F.greatest(F.coalesce(F.size(F.col(cast)), F.lit(1)), F.lit(1)))
        .cast("bigint")
        .alias("cast_rows"),
        F.countDistinct(language).alias("languages"),
    ).withColumn("cast_distinct", people.agg(F.countDistinct("person").alias("n")).scalar())


def nice_histogram(df: DataFrame, column: str, max_bins: int = 30) -> DataFrame:
    """Counts in bins of a round width (1, 2 or 5 times a power of ten), at most
    ``max_bins`` of them; bins are ``[bin_start, bin_end)``."""
    values = df.select(F.col(column).cast("double").alias("v")).dropna()
    span = F.max("v") - F.min("v")
    raw = F.when(span > 0, span / max_bins).otherwise(F.lit(1.0))
    power = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    # A width an exact multiple of the raw one must not be missed by a rounding error.
    ratio = F.round(raw / power, 9)
    factor = F.when(ratio <= 1, 1).when(ratio <= 2, 2).when(ratio <= 5, 5).otherwise(10)
    # Round widths below one are kept as "n bins per unit", which is exact in floating point.
    step = values.agg(F.round(factor * power, 12).alias("step")).scalar()
    slot = F.floor(F.round(F.col("v") / step, 9))
    return (
        values.select(slot.alias("slot"), step.alias("step"))
        .groupBy("slot", "step")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.round(F.col("slot") * F.col("step"), 9).alias("bin_start"),
            F.round((F.col("slot") + 1) * F.col("step"), 9).alias("bin_end"),
            "n",
        )
        .orderBy("bin_start")
    )
