"""Catalogue ETL on the driver tables.

Parts play the films, line items their credits and votes, suppliers the people,
documents the enrichment table and the localised titles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import functions as fn
from marquee.functions.genres import DOCUMENTARY_GENRES, FILM_GENRES
from marquee.operators import catalog, titles
from marquee.plans import pipelines
from marquee.plans.bindings.registry import Tables, query


def basics(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("tconst"),
        F.when(F.col("p_type").isin("LARGE", "PROMO"), F.lit("short"))
        .otherwise(F.lit("movie"))
        .alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        F.upper("p_name").alias("originalTitle"),
        (F.col("p_size") + 1980).cast("string").alias("startYear"),
        F.when(F.col("p_size") == 50, F.lit("\\N"))
        .otherwise((F.col("p_size") * 2 + 40).cast("string"))
        .alias("runtimeMinutes"),
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("genres"),
    )


def crew(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_partkey").cast("string").alias("tconst")).agg(
        F.min("l_suppkey").cast("string").alias("directors"),
        F.concat_ws(",", F.min("l_suppkey"), F.max("l_suppkey")).alias("writers"),
    )


def votes(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_partkey").cast("string").alias("tconst")).agg(
        (F.avg("l_quantity") / 5).alias("averageRating"),
        F.count(F.lit(1)).alias("numVotes"),
    )


def credits(t: Tables) -> DataFrame:
    flag = F.concat("l_returnflag", "l_linestatus")
    return t.lineitem.select(
        F.col("l_partkey").cast("string").alias("tconst"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ordering"),
        F.col("l_suppkey").alias("nconst"),
        F.when(flag == "AF", "actor")
        .when(flag == "NF", "actress")
        .when(flag == "RF", "producer")
        .otherwise("writer")
        .alias("category"),
    )


def people(t: Tables) -> DataFrame:
    """Suppliers in debt are unknown people."""
    return t.supplier.filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("nconst"), F.col("s_name").alias("primaryName")
    )


BASICS_SQL = r"""
basics AS (
  SELECT CAST(p_partkey AS VARCHAR) AS tconst,
         CASE WHEN p_type IN ('LARGE', 'PROMO') THEN 'short' ELSE 'movie' END AS "titleType",
         p_name AS "primaryTitle", upper(p_name) AS "originalTitle",
         CAST(p_size + 1980 AS VARCHAR) AS "startYear",
         CASE WHEN p_size = 50 THEN '\N' ELSE CAST(p_size * 2 + 40 AS VARCHAR) END
           AS "runtimeMinutes",
         replace(p_name, ' ', ',') AS genres
  FROM part),
crew AS (
  SELECT CAST(l_partkey AS VARCHAR) AS tconst,
         CAST(min(l_suppkey) AS VARCHAR) AS directors,
         CAST(min(l_suppkey) AS VARCHAR) || ',' || CAST(max(l_suppkey) AS VARCHAR) AS writers
  FROM lineitem GROUP BY l_partkey),
votes AS (
  SELECT CAST(l_partkey AS VARCHAR) AS tconst, avg(l_quantity) / 5 AS "averageRating",
         count(*) AS "numVotes"
  FROM lineitem GROUP BY l_partkey)
"""

CREDITS_SQL = """
credits AS (
  SELECT CAST(l_partkey AS VARCHAR) AS tconst, l_orderkey * 8 + l_linenumber AS ordering,
         l_suppkey AS nconst,
         CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'actor' WHEN 'NF' THEN 'actress'
           WHEN 'RF' THEN 'producer' ELSE 'writer' END AS category
  FROM lineitem)
"""


@query(
    f"""
WITH {BASICS_SQL}
SELECT tconst, "primaryTitle", "originalTitle", "startYear", "runtimeMinutes", genres,
       directors, writers, "averageRating", "numVotes"
FROM basics JOIN crew USING (tconst) JOIN votes USING (tconst)
WHERE TRY_CAST("startYear" AS INTEGER) > 1990 AND "titleType" = 'movie'
  AND TRY_CAST("averageRating" AS FLOAT) > CAST(5.1 AS FLOAT)
  AND TRY_CAST("runtimeMinutes" AS INTEGER) > 75 AND TRY_CAST("numVotes" AS INTEGER) > 20
"""
)
def catalog_base(t: Tables) -> DataFrame:
    return catalog.build_base(basics(t), crew(t), votes(t), min_rating=5.1, min_votes=20)


@query(
    f"""
WITH {CREDITS_SQL}
SELECT tconst,
  coalesce(string_agg(CAST(nconst AS VARCHAR), ',' ORDER BY ordering, nconst)
    FILTER (WHERE category = 'actor'), '') AS actor,
  coalesce(string_agg(CAST(nconst AS VARCHAR), ',' ORDER BY ordering, nconst)
    FILTER (WHERE category = 'actress'), '') AS actress,
  coalesce(string_agg(CAST(nconst AS VARCHAR), ',' ORDER BY ordering, nconst)
    FILTER (WHERE category = 'producer'), '') AS producer
FROM credits WHERE category IN ('actor', 'actress', 'producer') GROUP BY tconst
"""
)
def principals_pivot(t: Tables) -> DataFrame:
    pivot = catalog.principals_pivot(credits(t))
    return pivot.select(
        "tconst",
        *[
            F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
            for c in catalog.CATEGORIES
        ],
    )


def _names_sql(category: str) -> str:
    return (
        f"coalesce(string_agg(coalesce(s_name, '?'), ',' ORDER BY ordering, nconst) "
        f"FILTER (WHERE category = '{category}'), '') AS {category}"
    )


@query(
    f"""
WITH {BASICS_SQL}, {CREDITS_SQL},
names AS (SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0),
cast_lists AS (
  SELECT tconst, {_names_sql('actor')}, {_names_sql('actress')}, {_names_sql('producer')}
  FROM credits LEFT JOIN names ON nconst = s_suppkey
  WHERE category IN ('actor', 'actress', 'producer') GROUP BY tconst)
SELECT crew.tconst, coalesce(d.s_name, '?') AS directors,
       coalesce(w1.s_name, '?') || ',' || coalesce(w2.s_name, '?') AS writers,
       actor, actress, producer
FROM crew LEFT JOIN cast_lists USING (tconst)
LEFT JOIN names d ON CAST(directors AS BIGINT) = d.s_suppkey
LEFT JOIN names w1 ON CAST(split_part(writers, ',', 1) AS BIGINT) = w1.s_suppkey
LEFT JOIN names w2 ON CAST(split_part(writers, ',', 2) AS BIGINT) = w2.s_suppkey
"""
)
def resolve_names(t: Tables) -> DataFrame:
    lists = catalog.add_cast(crew(t), catalog.principals_pivot(credits(t)))
    cols = ["directors", "writers", *catalog.CATEGORIES]
    named = catalog.resolve_names(lists, people(t), cols)
    return named.select("tconst", *[F.array_join(c, ",", "?").alias(c) for c in cols])


def _lists_sql(category: str) -> str:
    return (
        f"list(s_name ORDER BY ordering, CAST(nconst AS VARCHAR)) "
        f"FILTER (WHERE category = '{category}') AS {category}"
    )


@query(
    f"""
WITH {BASICS_SQL}, {CREDITS_SQL},
names AS (SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0),
films AS (
  SELECT basics.*, d.doc_id AS id, d.lang, d.text, d.source,
    "averageRating", "numVotes", crew.directors, crew.writers
  FROM basics JOIN crew USING (tconst) JOIN votes USING (tconst)
  JOIN documents d ON CAST(d.doc_id AS VARCHAR) = tconst
  WHERE TRY_CAST("startYear" AS INTEGER) > 1990 AND "titleType" = 'movie'
    AND TRY_CAST("averageRating" AS FLOAT) > CAST(4.0 AS FLOAT)
    AND TRY_CAST("runtimeMinutes" AS INTEGER) > 75 AND TRY_CAST("numVotes" AS INTEGER) > 10
    AND d.lang IN ('en', 'fr', 'de', 'es', 'it', 'nl', 'pt', 'fi', 'ga', 'ja')
    AND d.n_chars >= 100),
cast_lists AS (
  SELECT tconst, {_lists_sql('actor')}, {_lists_sql('actress')}, {_lists_sql('producer')}
  FROM credits LEFT JOIN names ON nconst = s_suppkey
  WHERE category IN ('actor', 'actress', 'producer') GROUP BY tconst)
SELECT f.tconst, id, "primaryTitle", replace(genres, ',', '|') AS genres,
  array_to_string(list_transform(coalesce(actor, []) || coalesce(actress, []),
    lambda x: coalesce(x, '?')), '|') AS actor_actress,
  array_to_string(list_transform(coalesce(producer, []), lambda x: coalesce(x, '?')), '|')
    AS producer,
  coalesce(d.s_name, '?') AS directors,
  coalesce(w1.s_name, '?') || '|' || coalesce(w2.s_name, '?') AS writers,
  CAST("numVotes" AS BIGINT) AS "numVotes", lang AS original_language, text AS overview
FROM films f LEFT JOIN cast_lists USING (tconst)
LEFT JOIN names d ON CAST(directors AS BIGINT) = d.s_suppkey
LEFT JOIN names w1 ON CAST(split_part(writers, ',', 1) AS BIGINT) = w1.s_suppkey
LEFT JOIN names w2 ON CAST(split_part(writers, ',', 2) AS BIGINT) = w2.s_suppkey
"""
)
def build_catalog(t: Tables) -> DataFrame:
    """From the source tables to the final catalogue, one row per title."""
    none = F.lit(None).cast("string")
    extra = t.documents.select(
        F.col("doc_id").cast("string").alias("imdb_id"),
        F.col("doc_id").alias("id"),
        F.col("lang").alias("original_language"),
        F.when(F.col("n_chars") >= 100, F.col("text")).alias("overview"),
        F.col("source").alias("poster_path"),
        F.lit(1.0).alias("popularity"),
        none.alias("budget"),
        none.alias("revenue"),
        none.alias("production_companies_name"),
    )
    films = pipelines.build_catalog(
        basics(t), crew(t), votes(t), credits(t), people(t), extra, min_rating=4.0, min_votes=10
    )
    lists = ("genres", "actor_actress", "producer", "directors", "writers")
    return films.select(
        "tconst",
        "id",
        "primaryTitle",
        *[F.array_join(c, "|", "?").alias(c) for c in lists],
        "numVotes",
        "original_language",
        "overview",
    )


@query(
    """
SELECT CAST(l.doc_id AS VARCHAR) AS tconst, l.quality, d.doc_id AS id,
       d.lang AS original_language, d.text AS overview, d.source AS poster_path
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
WHERE d.lang IN ('en', 'fr', 'de', 'es', 'it', 'nl', 'pt', 'fi', 'ga', 'ja')
  AND d.n_chars >= 100
"""
)
def enrich_language(t: Tables) -> DataFrame:
    films = t.labels.select(F.col("doc_id").cast("string").alias("tconst"), "quality")
    extra = t.documents.select(
        F.col("doc_id").cast("string").alias("imdb_id"),
        F.col("doc_id").alias("id"),
        F.col("lang").alias("original_language"),
        F.when(F.col("n_chars") >= 100, F.col("text")).alias("overview"),
        F.col("source").alias("poster_path"),
        F.col("source").alias("status"),
        F.col("n_chars").alias("runtime"),
    )
    return catalog.drop_incomplete(catalog.keep_languages(catalog.enrich(films, extra)))


@query(
    """
SELECT CAST(p_partkey AS VARCHAR) AS tconst, p_partkey AS id, p_name AS "primaryTitle",
  upper(p_name) AS "originalTitle", replace(p_name, ' ', ',') AS genres,
  p_size + 1980 AS "startYear", p_size * 2 + 40 AS "runtimeMinutes",
  p_retailprice AS "averageRating", CAST(p_size AS BIGINT) AS "numVotes",
  p_retailprice AS popularity,
  replace(p_name, ' ', ',') || ',' || 'O''' || p_type AS actor_actress,
  '' AS producer, p_brand || ',?,' || p_type AS writers, p_type AS directors,
  'caf' || chr(233) || ' ' || p_brand AS production_companies_name,
  CAST(trunc(p_retailprice) AS BIGINT) AS budget, CAST(NULL AS BIGINT) AS revenue,
  p_type AS original_language, p_name AS overview, p_brand AS poster_path
FROM part
"""
)
def conform_lists(t: Tables) -> DataFrame:
    first, second = F.split("p_name", " ").getItem(0), F.split("p_name", " ").getItem(1)
    raw = basics(t).join(
        t.part.select(
            F.col("p_partkey").cast("string").alias("tconst"),
            F.col("p_partkey").alias("id"),
            F.col("p_retailprice").alias("averageRating"),
            F.col("p_size").cast("string").alias("numVotes"),
            (F.col("p_size") * 2 + 40).cast("string").alias("minutes"),
            F.col("p_retailprice").alias("popularity"),
            F.concat(F.lit("['"), first, F.lit("', \""), second, F.lit('"]')).alias("actor"),
            F.concat(F.lit("['O\\'"), "p_type", F.lit("']")).alias("actress"),
            F.lit(None).cast("string").alias("producer"),
            F.concat(F.lit("['"), "p_brand", F.lit("', None, '"), "p_type", F.lit("']")).alias(
                "writers"
            ),
            F.array("p_type").alias("directors"),
            F.concat(F.lit("['caf\\xe9 "), "p_brand", F.lit("']")).alias(
                "production_companies_name"
            ),
            F.col("p_retailprice").cast("string").alias("budget"),
            F.col("p_brand").alias("revenue"),
            F.col("p_type").alias("original_language"),
            F.col("p_name").alias("overview"),
            F.col("p_brand").alias("poster_path"),
        ),
        "tconst",
    )
    done = catalog.conform(raw.withColumn("runtimeMinutes", F.col("minutes")))
    return done.select(
        *[
            F.array_join(c, ",", "?").alias(c) if kind.startswith("array") else F.col(c)
            for c, kind in done.dtypes
        ]
    )


@query(
    """
SELECT doc_id,
  trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS folded
FROM documents
"""
)
def fold_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", fn.fold_text(F.col("text")).alias("folded"))


@query(
    """
WITH first_title AS (
  SELECT source, text AS title FROM documents WHERE lang = 'fr'
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1)
SELECT d.source AS tconst, coalesce(f.title, 'untitled ' || d.source) AS title_final,
  trim(regexp_replace(lower(strip_accents(coalesce(f.title, 'untitled ' || d.source))),
    '[^a-z0-9]+', ' ', 'g')) AS title_search
FROM (SELECT DISTINCT source FROM documents) d LEFT JOIN first_title f USING (source)
"""
)
def title_localized(t: Tables) -> DataFrame:
    films = t.documents.select(
        F.col("source").alias("tconst"),
        F.concat(F.lit("untitled "), "source").alias("primaryTitle"),
    ).distinct()
    akas = t.documents.select(
        F.col("source").alias("titleId"),
        F.col("doc_id").alias("ordering"),
        F.col("text").alias("title"),
        F.upper("lang").alias("region"),
    )
    return titles.search_catalog(films, akas)


@query(
    """
SELECT p_partkey,
  replace(lower(p_name), ' ', '') || ' ' || replace(lower(p_brand), ' ', '') AS compact,
  replace(lower(p_name), ' ', '') || ' none ' || replace(lower(p_brand), ' ', '') AS with_none
FROM part
"""
)
def compact_tokens(t: Tables) -> DataFrame:
    mixed = F.array("p_name", F.lit(None).cast("string"), "p_brand")
    return t.part.select(
        "p_partkey",
        fn.compact_tokens(mixed).alias("compact"),
        fn.compact_tokens(mixed, null_token="none").alias("with_none"),
    )


@query(
    """
SELECT o_orderkey,
  CAST(o_custkey AS VARCHAR) AS id_from_float,
  'id' || CAST(o_custkey AS VARCHAR) AS id_from_text,
  CAST(trunc(o_totalprice) AS BIGINT) AS whole,
  CAST(NULL AS BIGINT) AS not_whole,
  strftime(o_orderdate, '%Y') AS year, '????' AS no_year,
  CASE WHEN length(o_orderpriority) > 6 THEN substr(o_orderpriority, 1, 6) || '...'
    ELSE o_orderpriority END AS short_text,
  trim(o_orderstatus || ' ' || o_orderpriority) AS full_name,
  'https://image.tmdb.org/t/p/w500' || '/' || o_orderpriority AS image,
  CAST(o_custkey % 5 + 1 AS INTEGER) AS score,
  CASE WHEN o_custkey % 200 < 90 THEN 'Moins de 90 min'
    WHEN o_custkey % 200 <= 120 THEN '90-120 min' ELSE 'Plus de 120 min' END AS duration
FROM orders
"""
)
def scalar_functions(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        fn.canonical_id(F.concat(F.lit(" "), F.col("o_custkey").cast("double"))).alias(
            "id_from_float"
        ),
        fn.canonical_id(F.concat(F.lit(" id"), "o_custkey", F.lit(" "))).alias("id_from_text"),
        fn.to_long(F.col("o_totalprice").cast("string")).alias("whole"),
        fn.to_long(F.col("o_orderpriority")).alias("not_whole"),
        fn.year_text(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("year"),
        fn.year_text(F.nullif("o_orderstatus", "o_orderstatus")).alias("no_year"),
        fn.truncate(F.col("o_orderpriority"), 6).alias("short_text"),
        fn.full_name(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("full_name"),
        fn.image_url(F.concat(F.lit("/"), "o_orderpriority")).alias("image"),
        fn.stars_to_score(F.col("o_custkey") % 5).alias("score"),
        fn.duration_bucket(F.col("o_custkey") % 200).alias("duration"),
    )


def _case_sql(expr: str, table: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items())
    return f"CASE {expr} {arms} END"


_GENRES = list(FILM_GENRES)


@query(
    f"""
WITH films AS (SELECT p_partkey, [{', '.join(f"'{g}'" for g in _GENRES)}][p_size % 25 + 1] AS genre
               FROM part)
SELECT p_partkey, genre, {_case_sql('genre', FILM_GENRES)} AS film_label,
  {_case_sql('genre', DOCUMENTARY_GENRES)} AS documentary_label, genre AS back
FROM films
"""
)
def genre_labels(t: Tables) -> DataFrame:
    genre = F.get(F.array(*[F.lit(g) for g in _GENRES]), F.col("p_size") % 25)
    films = t.part.select("p_partkey", genre.alias("genre"))
    film_label = fn.translate_genre(F.col("genre"))
    return films.select(
        "p_partkey",
        "genre",
        film_label.alias("film_label"),
        fn.translate_genre(F.col("genre"), "documentary").alias("documentary_label"),
        fn.genre_from_label(film_label).alias("back"),
    )
