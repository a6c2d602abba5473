"""Users, preferences, interaction log and film details on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee import streaming
from marquee.operators import details, ratings, users
from marquee.plans.bindings.registry import Tables, query
from marquee.session import scratch_path
from marquee.sources import read_json, schemas, write_json


def raw_users(t: Tables) -> DataFrame:
    """Accounts by segment and nation, so that usernames repeat; records in debt have a
    broken preference, and customers of nation 3 no password."""
    return t.customer.select(
        F.col("c_custkey").alias("row"),
        F.when(F.col("c_nationkey") == 4, F.col("c_nationkey").cast("string"))
        .when(F.col("c_nationkey") == 5, F.lit(""))
        .otherwise(F.concat("c_mktsegment", F.col("c_nationkey")))
        .alias("username"),
        F.when(F.col("c_nationkey") != 3, F.lit("secret")).alias("password"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 7 != 0, F.concat("c_name", F.lit("@example.com"))).alias(
            "email"
        ),
        F.when(F.col("c_nationkey") == 6, F.lit("admin")).alias("role"),
        F.concat(F.lit('["'), "c_mktsegment", F.lit('", "x"]')).alias("genres_pref"),
        F.when(F.col("c_acctbal") < 0, F.lit("oops"))
        .when(F.col("c_acctbal") > 5000, F.concat(F.lit('["n'), "c_nationkey", F.lit('"]')))
        .alias("doc_genres_pref"),
    )


RAW_USERS_SQL = """
raw_users AS (
  SELECT c_custkey AS row,
    CASE WHEN c_nationkey = 4 THEN '4' WHEN c_nationkey = 5 THEN ''
      ELSE c_mktsegment || c_nationkey END AS username,
    CASE WHEN c_nationkey <> 3 THEN 'secret' END AS password, c_name AS name,
    CASE WHEN c_custkey % 7 <> 0 THEN c_name || '@example.com' END AS email,
    CASE WHEN c_nationkey = 6 THEN 'admin' ELSE 'utilisateur' END AS role,
    CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment || ',x' END AS films,
    CASE WHEN c_acctbal > 5000 THEN 'n' || c_nationkey ELSE '' END AS docs
  FROM customer),
parsed AS (SELECT username, name, email, role, films, docs FROM raw_users
  WHERE username <> '' AND password IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY username ORDER BY row DESC) = 1)
"""


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        "username",
        "name",
        "email",
        "role",
        F.array_join("genres_pref", ",").alias("films"),
        F.array_join("doc_genres_pref", ",").alias("docs"),
    )


@query(f"WITH {RAW_USERS_SQL} SELECT * FROM parsed")
def parse_users(t: Tables) -> DataFrame:
    return _shown(users.parse_users(raw_users(t), order="row"))


@query(
    f"""
WITH {RAW_USERS_SQL}
SELECT row, username FROM raw_users WHERE username <> '' AND password IS NOT NULL
  AND email IS NOT NULL AND regexp_matches(username, '[A-Za-z]')
"""
)
def valid_users(t: Tables) -> DataFrame:
    return users.valid_users(raw_users(t)).select("row", "username")


@query(
    f"""
WITH {RAW_USERS_SQL},
updates AS (SELECT username, films || ',new' AS films, '' AS docs FROM raw_users
  WHERE row % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY username ORDER BY row DESC) = 1)
SELECT p.username, p.name, p.email, p.role, CASE WHEN u.username IS NULL THEN p.films
    ELSE ltrim(u.films, ',') END AS films,
  CASE WHEN u.username IS NULL THEN p.docs ELSE u.docs END AS docs
FROM parsed p LEFT JOIN updates u ON p.username = u.username
"""
)
def apply_updates(t: Tables) -> DataFrame:
    records = raw_users(t)
    kept = F.when(F.col("doc_genres_pref") == "oops", F.array(F.lit("new"))).otherwise(
        F.array(F.split("username", r"\d").getItem(0), F.lit("x"), F.lit("new"))
    )
    segment = t.customer.select(F.col("c_custkey").alias("row"), "c_mktsegment")
    updates = (
        records.filter(F.col("row") % 2 == 0)
        .join(segment, "row")
        .select(
            "username",
            F.col("row").alias("ts"),
            F.when(F.coalesce(F.col("doc_genres_pref") == "oops", F.lit(False)), kept)
            .otherwise(F.array("c_mktsegment", F.lit("x"), F.lit("new")))
            .alias("genres_pref"),
            F.array().cast("array<string>").alias("doc_genres_pref"),
        )
    )
    return _shown(users.apply_updates(users.parse_users(records, order="row"), updates))


@query(
    f"""
WITH {RAW_USERS_SQL}
SELECT username, CASE WHEN films = '' THEN '[]' ELSE '["' || replace(films, ',', '","') || '"]' END
    AS genres_pref,
  CASE WHEN docs = '' THEN '[]' ELSE '["' || docs || '"]' END AS doc_genres_pref,
  'update_profile' AS action
FROM parsed
"""
)
def profile_payload(t: Tables) -> DataFrame:
    return users.to_payload(users.parse_users(raw_users(t), order="row"))


def submissions(t: Tables) -> DataFrame:
    """Purchases rate two films, clicks put one on the watchlist."""
    film = F.col("event_id") % t.part.agg(F.count(F.lit(1)).alias("n")).scalar()
    return t.events.select(
        F.concat(F.lit("u"), "user_id").alias("username"),
        F.when(F.col("event_type") == "purchase", F.lit(ratings.SUBMIT))
        .when(F.col("event_type") == "click", F.lit(ratings.WATCH))
        .otherwise(F.lit("other"))
        .alias("action"),
        F.when(
            F.col("event_type") == "purchase",
            F.create_map(
                F.concat(film, F.lit(".0")),
                (F.col("event_id") % 5 + 1).cast("int"),
                (film + 1).cast("string"),
                F.when(F.col("event_id") % 3 > 0, (F.col("event_id") % 4 + 1).cast("int")),
            ),
        ).alias("ratings"),
        F.concat(F.lit(" "), film).alias("movie_id"),
        "ts",
    )


SUBMISSIONS_SQL = """
rate_events AS (
  SELECT 'u' || user_id AS user_id, CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS item_id,
    CAST(event_id % 5 + 1 AS INTEGER) AS rating, ts FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'u' || user_id, CAST(event_id % (SELECT count(*) FROM part) + 1 AS VARCHAR),
    CAST(event_id % 4 + 1 AS INTEGER), ts
  FROM events WHERE event_type = 'purchase' AND event_id % 3 > 0),
latest AS (SELECT user_id, item_id, rating, ts FROM rate_events
  QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) = 1),
watched AS (SELECT 'u' || user_id AS user_id, CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS item_id,
    min(ts) AS ts FROM events WHERE event_type = 'click' GROUP BY ALL),
waiting AS (SELECT * FROM watched ANTI JOIN latest USING (user_id, item_id))
"""


@query(f"WITH {SUBMISSIONS_SQL} SELECT user_id, item_id, rating FROM rate_events")
def explode_submissions(t: Tables) -> DataFrame:
    return ratings.explode_submissions(submissions(t)).drop("ts")


@query(f"WITH {SUBMISSIONS_SQL} SELECT user_id, item_id, rating FROM latest")
def current_ratings(t: Tables) -> DataFrame:
    return ratings.current(ratings.explode_submissions(submissions(t))).drop("ts")


def arrived(t: Tables, copies: int, files_per_trigger: int) -> tuple[DataFrame, str]:
    """Submissions as a stream of files, each ``copies`` times, and a folder for its state."""
    folder = scratch_path(t.spark, "stream")
    sent = submissions(t).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    spread = F.md5(F.concat_ws("|", "username", "movie_id", "ts", "copy"))
    sent.repartition(8, spread).drop("copy").write.parquet(f"{folder}/inbox")
    stream = streaming.submissions(t.spark, f"{folder}/inbox", files_per_trigger, "parquet")
    return stream, folder


@query(f"WITH {SUBMISSIONS_SQL} SELECT user_id, item_id, rating FROM latest")
def stream_current_ratings(t: Tables) -> DataFrame:
    """The table of current ratings, kept by a stream in several batches."""
    stream, folder = arrived(t, copies=1, files_per_trigger=3)
    table = streaming.RatingTable(t.spark, f"{folder}/table", buckets=8)
    streaming.keep_current(stream, table, f"{folder}/progress").awaitTermination()
    return table.read().drop("ts")


@query(f"WITH {SUBMISSIONS_SQL} SELECT user_id, item_id, rating FROM rate_events")
def stream_unique_log(t: Tables) -> DataFrame:
    """The rating log of submissions that each arrive twice, out of order."""
    stream, folder = arrived(t, copies=2, files_per_trigger=3)
    once = streaming.unique(stream, "36500 days")
    log, progress = f"{folder}/log", f"{folder}/progress"
    streaming.rating_log(once, log, progress).awaitTermination()
    return t.spark.read.parquet(log).select("user_id", "item_id", "rating")


@query(f"WITH {SUBMISSIONS_SQL} SELECT user_id, item_id FROM watched")
def watchlist(t: Tables) -> DataFrame:
    return ratings.watchlist(submissions(t)).drop("ts")


def _waiting(t: Tables) -> DataFrame:
    rated = ratings.current(ratings.explode_submissions(submissions(t)))
    return ratings.pending(ratings.watchlist(submissions(t)), rated)


@query(f"WITH {SUBMISSIONS_SQL} SELECT user_id, item_id FROM waiting")
def pending(t: Tables) -> DataFrame:
    return _waiting(t).drop("ts")


@query(
    f"""
WITH {SUBMISSIONS_SQL}
SELECT user_id, count(*) AS n_pending, arg_min(item_id, (ts, item_id)) AS first_item
FROM waiting GROUP BY user_id
"""
)
def pending_summary(t: Tables) -> DataFrame:
    return ratings.pending_summary(_waiting(t))


@query(
    """
SELECT event_id, user_id, CAST(event_id % 7 + 1 AS INTEGER) AS rating FROM events
WHERE event_id % 7 < 5
"""
)
def from_stars(t: Tables) -> DataFrame:
    star = F.when(F.col("event_id") % 7 < 5, F.col("event_id") % 7)
    clicks = t.events.select("event_id", "user_id", star.alias("stars"))
    return ratings.from_stars(clicks).drop("stars")


@query(
    """
SELECT o_custkey AS user_id, count(DISTINCT l_partkey) AS n_rated
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey
HAVING count(DISTINCT l_partkey) >= 5
"""
)
def onboarded(t: Tables) -> DataFrame:
    rated = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    )
    return users.onboarded(rated)


@query(
    """
WITH people AS (
  SELECT l_partkey, l_suppkey, l_returnflag,
    row_number() OVER (PARTITION BY l_partkey, l_returnflag
      ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity) AS pos
  FROM lineitem),
crew AS (SELECT l_partkey,
    string_agg('D' || l_suppkey, ',' ORDER BY pos) FILTER (WHERE l_returnflag = 'R') AS directors,
    string_agg('A' || l_suppkey, ',' ORDER BY pos)
      FILTER (WHERE l_returnflag = 'A' AND pos <= 5) AS actors
  FROM people GROUP BY l_partkey),
films AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, CASE WHEN p_size < 10 THEN '  '
      WHEN p_size < 20 THEN NULL ELSE repeat(p_name || ' ', 50) END AS own,
    CASE WHEN p_size % 2 = 0 THEN 'english ' || p_name END AS english FROM part),
texts AS (SELECT *, coalesce(CASE WHEN trim(own) <> '' THEN own END, english, 'Aucun résumé.')
            AS overview FROM films)
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title,
  CASE WHEN p_size > 45 THEN '????' ELSE CAST(1950 + p_size AS VARCHAR) END AS year,
  p_type || ', ' || p_brand AS genre_names, p_size AS runtime,
  coalesce(directors, '') AS directors, coalesce(actors, '') AS actors,
  'https://image.tmdb.org/t/p/w500/' || p_brand AS poster_url, overview,
  CASE WHEN length(overview) > 400 THEN substr(overview, 1, 400) || '...' ELSE overview END
    AS overview_short
FROM texts LEFT JOIN crew ON p_partkey = l_partkey
"""
)
def film_details(t: Tables) -> DataFrame:
    """Records are written as JSON lines and read back with their schema, as landed files are."""
    name = lambda c: F.struct(c.cast("string").alias("name"))
    records = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") <= 45, F.concat(F.col("p_size") + 1950, F.lit("-07-14"))).alias(
            "release_date"
        ),
        F.col("p_size").alias("runtime"),
        F.when(F.col("p_size") < 10, F.lit("  "))
        .when(F.col("p_size") >= 20, F.repeat(F.concat("p_name", F.lit(" ")), F.lit(50)))
        .alias("overview"),
        F.concat(F.lit("/"), "p_brand").alias("poster_path"),
        F.array(name(F.col("p_type")), name(F.col("p_brand"))).alias("genres"),
    )
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")]

    def members(flag: str, entry):
        rows = F.when(F.col("l_returnflag") == flag, F.struct(*order))
        return F.transform(F.array_sort(F.collect_list(rows)), entry)

    # Only five actors are shown, so no more get into a list; ranking prunes in every task.
    role = Window.partitionBy("l_partkey", "l_returnflag").orderBy(*order)
    acting = t.lineitem.filter("l_returnflag = 'A'").withColumn("pos", F.row_number().over(role))
    people = acting.filter("pos <= 5").drop("pos").unionByName(
        t.lineitem.filter("l_returnflag != 'A'")
    )
    credits = people.groupBy(F.col("l_partkey").alias("id")).agg(
        F.concat(
            F.array(F.struct(F.lit("Writer").alias("job"), F.lit("W").alias("name"))),
            members(
                "R",
                lambda r: F.struct(
                    F.lit("Director").alias("job"),
                    F.concat(F.lit("D"), r["l_suppkey"]).alias("name"),
                ),
            ),
        ).alias("crew"),
        members(
            "A", lambda r: F.struct(F.concat(F.lit("A"), r["l_suppkey"]).alias("name"))
        ).alias("cast"),
    )
    landed = []
    for df, kind, schema in (
        (records, "details", schemas.FILM_DETAILS),
        (credits, "credits", schemas.FILM_CREDITS),
    ):
        path = scratch_path(t.spark, kind)
        write_json(df, path)
        landed.append(read_json(t.spark, path, schema))
    english = t.part.filter(F.col("p_size") % 2 == 0).select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("english "), "p_name").alias("overview")
    )
    shown = details.flatten(*landed, english=english)
    return shown.withColumns(
        {c: F.array_join(c, ",") for c in ("directors", "actors")}
    )


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name FROM customer WHERE c_nationkey % 3 <> 0
"""
)
def numeric_ids(t: Tables) -> DataFrame:
    """Customers of every third nation have an id that is no number."""
    mixed = F.when(F.col("c_nationkey") % 3 == 0, F.col("c_name")).otherwise(
        F.concat("c_custkey", F.lit(".0"))
    )
    return details.numeric_ids(t.customer.select(mixed.alias("id"), "c_name"))
