"""Catalogue numbers and profiling on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import functions as fn
from marquee.operators import profile, stats
from marquee.plans.bindings.registry import Tables, query
from marquee.session import landed
from marquee.plans.bindings.search import parts
from marquee.sources import preview


def labelled(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id", "left")


@query(
    """
SELECT genre, count(*) AS films
FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part) GROUP BY genre
"""
)
def genre_counts(t: Tables) -> DataFrame:
    return stats.genre_counts(parts(t))


@query(
    """
WITH casts AS (
  SELECT l_orderkey, list(l_suppkey) FILTER (WHERE l_returnflag = 'A') AS people
  FROM lineitem GROUP BY l_orderkey)
SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS titles,
  CAST((SELECT sum(greatest(coalesce(len(people), 1), 1))
    FROM orders LEFT JOIN casts ON o_orderkey = l_orderkey) AS BIGINT) AS cast_rows,
  (SELECT count(DISTINCT o_orderpriority) FROM orders) AS languages,
  (SELECT count(DISTINCT l_suppkey) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'A') AS cast_distinct
"""
)
def catalog_metrics(t: Tables) -> DataFrame:
    casts = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_list(F.when(F.col("l_returnflag") == "A", F.col("l_suppkey"))).alias("people")
    )
    films = t.orders.join(casts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return stats.catalog_metrics(films, "o_custkey", "people", "o_orderpriority")


_HISTOGRAM_SQL = """
WITH r AS (SELECT (max({c}) - min({c})) / 30 AS raw FROM {t}),
p AS (SELECT raw, pow(10.0, floor(log10(raw))) AS power FROM r),
s AS (SELECT CASE WHEN round(raw / power, 9) <= 1 THEN 1 WHEN round(raw / power, 9) <= 2 THEN 2
             WHEN round(raw / power, 9) <= 5 THEN 5 ELSE 10 END * power AS step FROM p),
b AS (SELECT floor(round({c} / step, 9)) AS slot, step, count(*) AS n FROM {t}, s
      GROUP BY ALL)
SELECT round(slot * step, 4) AS bin_start, round((slot + 1) * step, 4) AS bin_end, n FROM b
"""


def _histogram(df: DataFrame, column: str) -> DataFrame:
    bins = stats.nice_histogram(df, column)
    return bins.select(
        F.round("bin_start", 4).alias("bin_start"), F.round("bin_end", 4).alias("bin_end"), "n"
    )


@query(_HISTOGRAM_SQL.format(c="l_quantity", t="lineitem"))
def rating_histogram(t: Tables) -> DataFrame:
    return _histogram(t.lineitem, "l_quantity")


@query(_HISTOGRAM_SQL.format(c="c_acctbal", t="customer"))
def balance_histogram(t: Tables) -> DataFrame:
    return _histogram(t.customer, "c_acctbal")


@query(
    """
SELECT CASE WHEN p_size * 4 < 90 THEN 'Moins de 90 min' WHEN p_size * 4 <= 120
  THEN '90-120 min' ELSE 'Plus de 120 min' END AS value, count(*) AS n
FROM part GROUP BY 1
"""
)
def duration_counts(t: Tables) -> DataFrame:
    bucket = fn.duration_bucket(F.col("runtimeMinutes")).alias("bucket")
    return profile.value_counts(parts(t).select(bucket), "bucket")


@query("SELECT lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.documents, "lang")


_LABELLED_SQL = """
labelled AS (SELECT d.doc_id, text, lang, source, n_chars, quality, toxic
             FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


@query(
    f"""
WITH {_LABELLED_SQL}
SELECT 'doc_id' AS "column", count(*) FILTER (doc_id IS NULL) AS nulls FROM labelled
UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM labelled
UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL) FROM labelled
UNION ALL SELECT 'source', count(*) FILTER (source IS NULL) FROM labelled
UNION ALL SELECT 'n_chars', count(*) FILTER (n_chars IS NULL) FROM labelled
UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM labelled
UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM labelled
"""
)
def null_counts(t: Tables) -> DataFrame:
    return profile.null_counts(labelled(t))


@query(f"WITH {_LABELLED_SQL} SELECT * FROM labelled WHERE quality IS NULL OR toxic IS NULL")
def rows_with_nulls(t: Tables) -> DataFrame:
    return profile.rows_with_nulls(labelled(t))


@query(f"WITH {_LABELLED_SQL} SELECT count(*) AS n_rows, 7 AS n_columns FROM labelled")
def shape(t: Tables) -> DataFrame:
    return profile.shape(labelled(t))


@query(
    f"""
WITH {_LABELLED_SQL}
SELECT 'doc_id' AS "column", 'bigint' AS expected, 'bigint' AS actual, true AS matches,
  count(doc_id) AS filled, count(*) AS n_rows FROM labelled
UNION ALL SELECT 'text', 'string', 'string', true, count(text), count(*) FROM labelled
UNION ALL SELECT 'quality', 'string', 'int', false, count(quality), count(*) FROM labelled
UNION ALL SELECT 'genres', 'array<string>', NULL, false, 0, count(*) FROM labelled
"""
)
def check_schema(t: Tables) -> DataFrame:
    expected = {"doc_id": "bigint", "text": "string", "quality": "string", "genres": "array<string>"}
    return profile.check_schema(labelled(t), expected)


@query(
    """
SELECT event_id, user_id, event_type FROM events
ORDER BY md5('42|' || CAST(event_id AS VARCHAR)), event_id LIMIT 20
"""
)
def preview_random(t: Tables) -> DataFrame:
    rows = preview(t.events, 20, "random", 42, ["event_id"])
    return rows.select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 5")
def preview_head(t: Tables) -> DataFrame:
    return preview(t.events, 5, keys=["event_id"]).select("event_id", "user_id", "event_type")


@query()
def distinct_estimates(t: Tables) -> DataFrame:
    """Distinct orders, customers and clerks' priorities by sketches of each month, beside
    the exact counts."""
    orders = t.orders.select(
        F.date_trunc("month", "o_orderdate").alias("month"),
        *[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey", "o_orderpriority")],
    )
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    stored = landed(stats.distinct_sketches(orders, "month", columns), "sketches")
    exact = orders.agg(
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.countDistinct(c).alias("exact")) for c in columns]
        ).alias("all")
    ).select(F.inline("all"))
    return stats.distinct_estimates(stored).join(exact, "column")
