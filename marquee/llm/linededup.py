"""Line deduplication by overlapping windows of three lines, found over the whole corpus.

Built-in functions only. Windows are written once, counted, and joined back; hot windows
are pre-aggregated in every task and split by adaptive execution in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import landed

WIDTH = 3
WHITE = " \t\n\x0b\x0c\r"


def _hashes(lines: Column) -> Column:
    """Hash of each line without outer white space and in lower case; null: blank."""

    def one(line: Column) -> Column:
        bare = F.btrim(line, F.lit(WHITE))
        return F.when(bare != "", F.xxhash64(F.lower(bare)))

    return F.transform(lines, one)


def _full(hashes: Column) -> Column:
    """Positions of the lines that aren't blank."""
    placed = F.transform(hashes, lambda h, i: F.when(h.isNotNull(), i))
    return F.filter(placed, lambda i: i.isNotNull())


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, h, at, w): the hash w of the non-blank lines at, at + 1 and at + 2."""
    split = (
        docs.filter("text is not null")
        .select("doc_id", F.xxhash64("text").alias("h"), _hashes(F.split("text", "\n")).alias("all"))
        .select("doc_id", "h", F.filter("all", lambda x: x.isNotNull()).alias("full"))
        .filter(F.size("full") >= WIDTH)
    )
    each = F.transform(
        F.sequence(F.lit(0), F.size("full") - WIDTH),
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(*[F.col("full")[i + k] for k in range(WIDTH)]).alias("w"),
        ),
    )
    return split.select("doc_id", "h", F.inline(each))


def later(found: DataFrame) -> DataFrame:
    """(doc_id, h, ats): where a document has windows that occur before, in the order of
    doc_id, text hash and position."""
    place = F.struct("doc_id", "h", "at")
    first = (
        found.groupBy("w")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first != last")
        .select("w", "first")
    )
    return (
        found.join(first, "w")
        .filter(place > F.col("first"))
        .groupBy("doc_id", "h")
        .agg(F.collect_set("at").alias("ats"))
    )


def dedup(docs: DataFrame) -> DataFrame:
    """Remove every line of ``docs`` (doc_id, text, ...) that a repeated window covers.

    A window is three consecutive lines; blank lines take no part and stay. Of equal
    windows the first by doc_id (null first), text hash and position stays; the lines
    under any later one go, overlapping windows as one stretch. Adds n_lines and
    n_removed (long) and changes ``text``; columns of these names are replaced and all
    others kept. A text of fewer than three full lines is left alone, a null text stays
    null with no lines. Rows alike in doc_id and text count as one document, so all of
    them are treated the same. An empty table gives no rows. Lines are compared by 64-bit
    hashes.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    cuts = later(landed(windows(docs), "windows")).select(
        F.col("doc_id").alias("_doc_id"), F.col("h").alias("_h"), "ats"
    )
    # The row stays one column until the end, so that no name in it can clash.
    rows = docs.select(F.struct(*kept).alias("_row"), F.xxhash64("text").alias("_h0"))
    same = (F.col("_h0") == F.col("_h")) & F.col("_row.doc_id").eqNullSafe(F.col("_doc_id"))
    text = F.col("_row.text")
    lines = F.split(text, "\n")
    touched = F.col("ats").isNotNull()
    covered = F.array_distinct(
        F.flatten(F.transform("ats", lambda a: F.array(*[a + k for k in range(WIDTH)])))
    )
    # Mentioned twice, so that the optimiser doesn't put its expression into the lambda.
    gone = F.transform(covered, lambda j: F.when(j < F.size("_full"), F.col("_full")[j]))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    shorter = F.array_join(F.transform(left, lambda i: F.col("_lines")[i]), "\n")
    new = F.when(touched, shorter).otherwise(text)
    return (
        rows.join(cuts, same, "left")
        .select("_row", "ats", lines.alias("_lines"), F.when(touched, _full(_hashes(lines))).alias("_full"))
        .withColumn("_gone", F.when(touched, gone))
        .select(
            *[(new if c.lower() == "text" else F.col(f"_row.`{c}`")).alias(c) for c in kept],
            F.when(text.isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
            F.when(touched, F.size("_gone")).otherwise(0).cast("long").alias("n_removed"),
        )
    )
