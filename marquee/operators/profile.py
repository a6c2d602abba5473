"""Checks printed between the steps of the ETL, as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, nulls out."""
    return (
        df.select(F.col(column).alias("value"))
        .dropna()
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns]))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def check_schema(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Expected and actual type of each column, with the number of filled cells.

    Types come from the schema, so the data is read once, for the counts.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [c for c in expected if c in actual]
    counts = df.agg(
        *[F.count(c).alias(c) for c in present], F.count(F.lit(1)).alias("_rows")
    )
    report = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("expected"),
                F.lit(actual.get(name)).cast("string").alias("actual"),
                F.lit(actual.get(name) == kind).alias("matches"),
                (F.col(name) if name in present else F.lit(0)).cast("bigint").alias("filled"),
            )
            for name, kind in expected.items()
        ]
    )
    return counts.select(F.explode(report).alias("r"), "_rows").select(
        "r.*", F.col("_rows").alias("n_rows")
    )
