"""Search on the driver tables: parts are the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import fold_text
from marquee.operators import facets as panel
from marquee.operators import recommend, search
from marquee.plans.bindings.registry import Tables, query
from marquee.session import landed


def parts(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("row_order"),
        F.col("p_name").alias("title_final"),
        words.alias("genres"),
        F.array("p_brand", F.lit(None).cast("string")).alias("actor_actress"),
        F.when(F.col("p_size") > 2, F.array("p_type")).alias("producer"),
        F.col("p_size").alias("startYear"),
        F.lower("p_type").alias("original_language"),
        (F.col("p_size") * 4).alias("runtimeMinutes"),
    )


def asked(t: Tables) -> DataFrame:
    """Names, single words, and the first one and two letters of every part name."""
    words = F.split("p_name", " ")
    forms = F.array(
        F.initcap("p_name"),
        words.getItem(0),
        words.getItem(1),
        F.substring("p_name", 1, 1),
        F.substring("p_name", 1, 2),
        F.lit("!?"),
    )
    names = t.part.select("p_name").distinct()
    return names.select(F.explode(forms).alias("query")).distinct().select(
        F.col("query").alias("query_id"), "query"
    )


ASKED_SQL = """
asked AS (
  SELECT DISTINCT query FROM (
    SELECT unnest([
      upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2)
      || ' ' ||
      upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2),
      split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), substr(p_name, 1, 1),
      substr(p_name, 1, 2), '!?']) AS query FROM part))
"""


@query(
    f"""
WITH {ASKED_SQL},
keyed AS (SELECT query, trim(regexp_replace(lower(query), '[^a-z0-9]+', ' ', 'g')) AS k
          FROM asked),
hits AS (
  SELECT query, p_name AS title, p_partkey AS row_order,
         CASE WHEN p_name = k THEN 1 WHEN starts_with(p_name, k) THEN 2 ELSE 3 END AS tier
  FROM keyed JOIN part ON contains(p_name, k) WHERE k <> ''),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY tier,
    CASE WHEN tier > 1 THEN lower(title) END, row_order) AS position FROM hits)
SELECT query AS query_id, CAST(position AS INTEGER) AS position, tier, title, row_order
FROM placed WHERE position <= 20
"""
)
def title_search(t: Tables) -> DataFrame:
    films = parts(t).withColumn("title_search", fold_text(F.col("title_final")))
    return search.title_search(films, asked(t))


@query(
    """
SELECT q.query_id, p.p_partkey AS id, p.p_name AS title_final
FROM (SELECT DISTINCT '  ' || upper(p_name) || ' ' AS query_id FROM part) q
JOIN part p ON lower(p.p_name) = lower(trim(q.query_id))
QUALIFY row_number() OVER (PARTITION BY q.query_id ORDER BY p.p_partkey) = 1
"""
)
def lookup_title(t: Tables) -> DataFrame:
    wanted = t.part.select(
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("query_id")
    ).distinct()
    found = search.lookup_title(parts(t), wanted.withColumn("query", F.col("query_id")))
    return found.select("query_id", "id", "title_final")


@query(
    """
SELECT p_partkey AS id, p_size AS "startYear"
FROM part
WHERE list_contains(string_split(p_name, ' '), 'red') AND p_type = 'SMALL' AND p_size > 2
  AND p_size * 4 >= 90 AND p_size * 4 <= 120
"""
)
def filter_catalog(t: Tables) -> DataFrame:
    found = search.filter_catalog(
        parts(t),
        genre="red",
        producer="SMALL",
        language="small",
        year="Tous",
        actor=None,
        duration="90-120 min",
    )
    return found.select("id", "startYear")


@query(
    """
WITH found AS (SELECT p_partkey AS id FROM part WHERE p_brand = 'Brand#7' AND p_size * 4 > 120)
SELECT id, (SELECT count(*) FROM found) AS n_found FROM found
ORDER BY md5('7|' || CAST(id AS VARCHAR)), id LIMIT 20
"""
)
def filter_search(t: Tables) -> DataFrame:
    found = search.filter_search(
        parts(t), n=20, seed=7, actor="Brand#7", duration="Plus de 120 min"
    )
    return found.select("id", "n_found")


FACETS = ["genres", "actor_actress", "producer", "startYear", "original_language"]


@query(
    """
WITH f AS (
  SELECT DISTINCT p_partkey, 'genres' AS facet, unnest(string_split(p_name, ' ')) AS value FROM part
  UNION ALL SELECT p_partkey, 'actor_actress', p_brand FROM part
  UNION ALL SELECT p_partkey, 'producer', p_type FROM part WHERE p_size > 2
  UNION ALL SELECT p_partkey, 'startYear', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'original_language', lower(p_type) FROM part)
SELECT facet, value, count(CASE WHEN (facet = 'original_language' OR lower(p_type) = 'promo')
    AND (facet = 'actor_actress' OR p_brand = 'Brand#7') THEN 1 END) AS n
FROM f JOIN part USING (p_partkey) GROUP BY facet, value
"""
)
def facet_counts(t: Tables) -> DataFrame:
    """Films that each value would leave, beside the choice of a language and an actor."""
    index = landed(panel.bitmap_index(parts(t), FACETS), "facet-bitmaps")
    return panel.facet_counts(
        index, {"original_language": "promo", "actor_actress": "Brand#7", "startYear": None}
    )


@query(
    """
SELECT DISTINCT 'genres' AS facet, unnest(string_split(p_name, ' ')) AS value FROM part
UNION ALL SELECT DISTINCT 'actor_actress', p_brand FROM part
UNION ALL SELECT DISTINCT 'producer', p_type FROM part WHERE p_size > 2
UNION ALL SELECT DISTINCT 'startYear', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT DISTINCT 'original_language', lower(p_type) FROM part
"""
)
def facets(t: Tables) -> DataFrame:
    films = parts(t)
    lists = [
        search.facet_values(films, c, in_order=False).select(
            F.lit(c).alias("facet"), F.col("value").cast("string").alias("value")
        )
        for c in FACETS
    ]
    out = lists[0]
    for other in lists[1:]:
        out = out.unionByName(other)
    return out


@query(
    """
SELECT o_orderkey, o_custkey FROM orders
ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 20
"""
)
def sample_n(t: Tables) -> DataFrame:
    return search.sample_n(t.orders, 20, 42, "o_orderkey").select("o_orderkey", "o_custkey")


def themed(t: Tables) -> DataFrame:
    """Parts as films whose themes are type and first word; big ones are documentaries."""
    kind = F.when(F.col("p_size") > 10, F.lit("Documentary"))
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.array(kind, F.col("p_type"), F.split("p_name", " ").getItem(0)).alias("genres"),
    )


_THEMED_SQL = """
themed AS (SELECT p_partkey AS id, p_type AS kind, split_part(p_name, ' ', 1) AS word,
  p_size * 3 AS minutes FROM part WHERE p_size > 10)
"""


@query(
    f"""
WITH {_THEMED_SQL},
found AS (SELECT id FROM themed WHERE kind = 'SMALL' AND minutes <= 120 AND minutes >= 90)
SELECT id, (SELECT count(*) FROM found) AS n_found FROM found
ORDER BY md5('11|' || CAST(id AS VARCHAR)), id LIMIT 20
"""
)
def documentary_search(t: Tables) -> DataFrame:
    """Documentaries by theme and length."""
    films = search.documentaries(themed(t)).join(
        t.part.select(F.col("p_partkey").alias("id"), (F.col("p_size") * 3).alias("runtimeMinutes")),
        "id",
    )
    found = search.filter_search(films, n=20, seed=11, genre="SMALL", duration="90-120 min")
    return found.select("id", "n_found")


@query(
    f"""
WITH {_THEMED_SQL}
SELECT DISTINCT unnest(['Documentary', kind, word]) AS value FROM themed
"""
)
def documentary_facets(t: Tables) -> DataFrame:
    """Themes offered for documentaries."""
    return search.facet_values(search.documentaries(themed(t)), "genres")


def fans(t: Tables) -> DataFrame:
    """Customers with themes by market segment; some have none, some match nothing."""
    return t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("LARGE"), F.lit("red")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.array(F.lit("PROMO")))
        .when(F.col("c_mktsegment") == "FURNITURE", F.array(F.lit("opera")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.array().cast("array<string>"))
        .alias("doc_genres_pref"),
    )


@query(
    """
WITH docs AS (
  SELECT p_partkey AS item_id,
    list_sort(list_distinct(['Documentary', p_type, split_part(p_name, ' ', 1)])) AS genres
  FROM part WHERE p_size > 10),
numbered AS (
  SELECT item_id, genres, array_to_string(genres, '|') AS genre_list,
    row_number() OVER (PARTITION BY genres
      ORDER BY md5(CAST('|' || item_id AS VARCHAR)), item_id) AS place FROM docs),
fans AS (
  SELECT c_custkey AS user_id, CASE c_mktsegment WHEN 'BUILDING' THEN ['LARGE', 'red']
    WHEN 'MACHINERY' THEN ['PROMO'] ELSE [] END AS prefs FROM customer),
sets AS (SELECT DISTINCT prefs FROM fans),
ordered AS (
  SELECT s.prefs, d.item_id, d.genre_list,
    row_number() OVER (PARTITION BY s.prefs ORDER BY d.genres, d.place) - 1 AS position,
    count(*) OVER (PARTITION BY s.prefs) AS total
  FROM sets s JOIN numbered d ON len(s.prefs) = 0 OR list_has_any(d.genres, s.prefs)),
totals AS (SELECT DISTINCT prefs, total FROM ordered)
SELECT f.user_id, o.item_id, o.genre_list
FROM fans f JOIN totals t ON f.prefs = t.prefs
JOIN ordered o ON o.prefs = f.prefs AND o.position =
  CAST('0x' || substr(md5('11|' || CAST(f.user_id AS VARCHAR)), 1, 12) AS BIGINT) % t.total
"""
)
def surprise_documentary(t: Tables) -> DataFrame:
    picked = recommend.surprise_documentary(themed(t), fans(t), seed=11)
    return picked.withColumn("genre_list", F.array_join("genre_list", "|"))
