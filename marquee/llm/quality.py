"""Quality rules: plain text statistics, and lines that too many documents of a host share.

Built-in functions only. The texts are read once for their statistics and once for their
lines; only line hashes and counts are shuffled, pre-aggregated in every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import landed

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line in more documents of one host than this share of them, and than the least count,
#: goes: what every twentieth page has is the site's and not the page's own.
MAX_PERCENT, LEAST_DOCUMENTS = 5, 4
#: A document that keeps less than this share of its words, or fewer than MIN_WORDS, goes.
MIN_LEFT_PERCENT = 50


def split_words(text: Column) -> Column:
    """Runs without ASCII white space."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def with_statistics(rows: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of ``text``."""
    text = F.coalesce("text", F.lit(""))
    step = rows.withColumn("_words", split_words(text)).withColumn(
        "_lines", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    )
    every = F.sequence(F.lit(0), F.size("_words") - 3)
    words = F.col("_words")
    step = step.withColumn(
        "_windows",
        F.when(
            F.size("_words") >= 3,
            F.transform(every, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])),
        ).otherwise(F.array().cast("array<long>")),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("_sorted", F.when(repeats, F.sort_array(placed)))
    ordered = F.col("_sorted")

    def twice(x: Column, i: Column) -> Column:
        before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
        return before.eqNullSafe(x["h"]) | after.eqNullSafe(x["h"])

    found = F.transform(F.filter(ordered, twice), lambda x: x["i"])
    step = step.withColumn("_at", F.sort_array(found))
    at = F.col("_at")
    new = F.transform(
        at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))
    )
    covered = F.aggregate(new, F.lit(0), lambda a, b: a + b)
    return step.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def frequent_words(docs: DataFrame, max_percent: float, least_documents: int) -> DataFrame:
    """(doc_id, h, n_removed): words in lines that more than ``max_percent`` of the documents
    of the same host, and more than ``least_documents``, have. Lines are compared in lower case, without outer white space and
    with every digit as 0, by a 64-bit hash together with their host."""
    line = F.regexp_replace(F.lower(F.btrim("line", F.lit(WHITE))), "[0-9]", "0")
    lines = landed(
        docs.filter("text is not null")
        .select("doc_id", F.xxhash64("host").alias("of"), F.xxhash64("text").alias("h"), F.explode(F.split("text", "\n")).alias("line"))
        .select(
            "doc_id",
            "h",
            "of",
            F.xxhash64("of", line).alias("key"),
            F.regexp_count("line", F.lit(WORD)).alias("n"),
        )
        .filter("n > 0"),
        "lines",
    )
    # A line counts once for a document, and has the same key wherever it stands in it.
    once = lines.groupBy("doc_id", "h", "of", "key").agg(F.sum("n").alias("n"))
    hosts = (
        docs.select(F.xxhash64("host").alias("of"), "doc_id", F.xxhash64("text").alias("h"))
        .distinct()
        .groupBy("of")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    # Nearly all lines are in few documents: what is left to meet the hosts is small.
    often = once.groupBy("key", "of").agg(F.count(F.lit(1)).alias("m"))
    often = often.filter(F.col("m") > least_documents).join(hosts, "of")
    many = often.filter(100 * F.col("m") > max_percent * F.col("size"))
    return (
        once.join(many.select("key"), "key")
        .groupBy("doc_id", "h")
        .agg(F.sum("n").alias("n_removed"))
    )


def judge(
    docs: DataFrame,
    *,
    host: str = "source",
    max_percent: float = MAX_PERCENT,
    least_documents: int = LEAST_DOCUMENTS,
    min_left_percent: int = MIN_LEFT_PERCENT,
) -> DataFrame:
    """Statistics and verdict of every row of ``docs`` (doc_id, text, host).

    Result: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed
    (words in lines above the limit of their host), base_failed (fewer than 50 words, or over half of
    them in repeated three-word windows), kept. A document is kept if it didn't fail and,
    without the removed lines, has 50 words and ``min_left_percent`` of its words.

    A null text has no words and so fails; null hosts are one host. Rows alike in doc_id
    and text count as one document of their host and get the same verdict. Other columns are left out,
    so their names can't clash. An empty table gives no rows.
    """
    named = docs.select("doc_id", "text", F.col(host).alias("host"))
    removed = frequent_words(named, max_percent, least_documents).select(
        F.col("doc_id").alias("_doc_id"), F.col("h").alias("_h"), "n_removed"
    )
    rows = with_statistics(named.select("doc_id", "text", F.xxhash64("text").alias("h")))
    joined = rows.drop("text").join(
        removed, (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left"
    )
    n, out = F.col("n_words"), F.coalesce("n_removed", F.lit(0))
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    depleted = (n - out < MIN_WORDS) | (100 * (n - out) < min_left_percent * n)
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        out.cast("long").alias("n_removed"),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
    )
