"""From raw documents to packed training sequences.

``STAGES`` are applied in order. Each is written as Parquet below the shared folder and
read again, so that a lost executor never costs more than the stage that runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontaminate, jaccard, langid, linededup, packing
from marquee.llm.queries import language_model, pieces, table
from marquee.session import landed


def with_text(docs: DataFrame, text: F.Column, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with a new text and, where there is one, its n_chars; rows
    whose words are all gone are left out."""
    changed = docs.withColumn("_new", text).filter("_new is null or _new rlike '[^ \\\\t-\\\\r]'")
    new = {"text": F.col("_new"), "n_chars": F.length("_new").cast("long")}
    return changed.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; ``und`` goes. A tie of two is no fault of a text."""
    found = langid.predict(docs, language_model(docs))
    return found.filter(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later occurrences of repeated three-line windows."""
    return with_text(linededup.dedup(docs), F.col("text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the lowest doc_id."""
    return jaccard.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that repeat benchmark items."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return with_text(found, decontaminate.cut_text(), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return pieces(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("packing", packed),
]

#: Language identification and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
