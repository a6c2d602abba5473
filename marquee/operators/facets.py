"""Filter panels that know the filter: how many films each value of a facet would leave.

A bitmap for every facet value holds the films that have it, in buckets of 32768 film
numbers. The index is made in one pass over the catalogue and kept; a panel is then ANDs of
bitmaps, and the catalogue itself isn't read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import is_wanted
from marquee.operators.ranking import number_in_group


def _tagged(values: Column, name: str) -> Column:
    """Each of ``values`` as a struct of ``facet`` and value."""
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value")))


def bitmap_index(films: DataFrame, columns: list[str], id_col: str = "id") -> DataFrame:
    """(facet, value, bucket, bits): for each value of each of ``columns`` the films that
    have it. List columns count by element; nulls have no bitmap; values are texts. Films
    are numbered in the order of a hash of their ids."""
    lists = []
    for c in columns:
        is_list = films.schema[c].dataType.typeName() == "array"
        values = F.col(c) if is_list else F.array(c)
        texts = F.coalesce(values.cast("array<string>"), F.array().cast("array<string>"))
        lists.append(_tagged(texts, c))
    keyed = films.select(
        F.lit(0).alias("_all"), F.col(id_col).alias("_id"), F.flatten(F.array(*lists)).alias("_values")
    )
    place = F.col("position") + 1
    return (
        number_in_group(keyed, "_all", "_id")
        .select(place.alias("place"), F.explode("_values").alias("v"))
        .filter(F.col("v.value").isNotNull())
        .groupBy("v.facet", "v.value", F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )


def facet_counts(index: DataFrame, choices: dict[str, object]) -> DataFrame:
    """(facet, value, n): films that have the value and meet the choices made for all other
    facets; 0 where there are none. None, "Tous" and "Toutes" choose nothing. A choice that
    no film meets leaves 0 everywhere but for its own facet's values."""
    made = {f: str(v) for f, v in choices.items() if is_wanted(v)}
    if not made:
        return index.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    met = F.lit(False)
    for facet, value in made.items():
        met |= (F.col("facet") == facet) & (F.col("value") == value)
    names = [r["facet"] for r in index.select("facet").distinct().collect()]
    other = F.filter(F.array(*[F.lit(f) for f in names]), lambda f: f != F.col("facet"))
    chosen = index.filter(met).select(F.explode(other).alias("facet"), "bucket", "bits")
    # What the choices for the other facets leave, in the buckets where each leaves some.
    others = F.lit(len(made)) - F.col("facet").isin(*made).cast("int")
    masks = (
        chosen.groupBy("facet", "bucket")
        .agg(F.bitmap_and_agg("bits").alias("mask"), F.count(F.lit(1)).alias("k"))
        .filter(F.col("k") == others)
        .drop("k")
    )
    free = others == 0
    both = F.when(free, F.array("bits")).when(
        F.col("mask").isNotNull(), F.array("bits", "mask")
    ).otherwise(F.array(F.lit(b"\x00" * 4096)))
    return (
        index.join(masks, ["facet", "bucket"], "left")
        .select("facet", "value", "bucket", F.explode(both).alias("bits"))
        .groupBy("facet", "value", "bucket")
        .agg(F.bitmap_and_agg("bits").alias("bits"))
        .groupBy("facet", "value")
        .agg(F.sum(F.bitmap_count("bits")).alias("n"))
    )
