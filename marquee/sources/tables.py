"""Readers and writers.

Text files are for exchange only: a gzip file or a CSV with line breaks inside quotes
is read by one task per file, so ``land`` turns each source into Parquet once and
everything after reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import random_order
from marquee.session import scratch_path

_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_TSV = {"header": "true", "sep": "\t", "quote": "", "nullValue": "\\N"}


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated file, plain or gzip; ``\\N`` is null and quotes are plain text."""
    return spark.read.options(**_TSV).schema(schema).csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.options(
        **_TSV, emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Comma-separated file; quoted cells may hold quotes and line breaks.

    ``multi_line=False`` makes the file splittable where no cell has a line break.
    """
    options = {**_CSV, "multiLine": str(multi_line).lower()}
    return spark.read.options(**options).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. Arrays, maps and structs, which CSV lacks, go out as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    cells = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*cells).write.options(**_CSV).csv(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON record per line."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line; times keep their microseconds."""
    df.write.options(
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    ).json(path)


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON list of records; a file that holds anything
    else contributes no row."""
    texts = spark.read.text(path, wholetext=True)
    parsed = F.from_json(
        F.when(F.ltrim("value").startswith("["), F.col("value")),
        T.ArrayType(T.StructType.fromDDL(schema)),
    )
    return texts.select(F.explode(parsed).alias("record")).select("record.*")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def land(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write a text source once as Parquet below the shared folder and read that back.

    ``partitions`` spreads the rows of an unsplittable source before the write.
    """
    path = scratch_path(df.sparkSession, name)
    spread = df.repartition(partitions) if partitions else df
    write_table(spread, path)
    return read_table(df.sparkSession, path)


def preview(
    df: DataFrame, n: int = 5, mode: str = "head", seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """First ``n`` rows, or ``n`` random rows of the whole table (seeded, by ``keys``)."""
    if mode == "head":
        return df.orderBy(*keys).limit(n) if keys else df.limit(n)
    cols = [F.col(c) for c in (keys or df.columns)]
    return df.orderBy(random_order(seed, *cols), *cols).limit(n)


def save_model(tables: dict[str, DataFrame], path: str) -> None:
    """A model is its tables: each is written as Parquet under ``path``."""
    for name, table in tables.items():
        write_table(table, f"{path}/{name}")


def load_model(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{path}/{name}") for name in names}
