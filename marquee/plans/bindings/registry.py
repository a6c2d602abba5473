"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """Driver tables by attribute: ``Tables(spark, path).part``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._path = path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._path}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own name, with its SQL if it has one."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        _QUERIES[key] = lambda spark, path: fn(Tables(spark, path))
        if sql is not None:
            _SQL[key] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
