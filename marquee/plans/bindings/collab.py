"""Collaborative recommendations on the driver tables.

Customers rate the parts they ordered; for the fold-in the embeddings are the item
vectors and events the ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import factors, ratings, recommend, sgd
from marquee.plans.bindings.registry import Tables, query
from marquee.session import landed


def ml_ratings(t: Tables) -> DataFrame:
    """Ratings as delivered: one row per order line."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) * 0.5).cast("double").alias("rating"),
        F.col("o_orderdate").alias("timestamp"),
    )


def links(t: Tables) -> DataFrame:
    """Parts of size 1 have no link, and pairs of neighbouring parts share one."""
    return t.part.select(
        F.col("p_partkey").alias("movieId"),
        F.col("p_brand").alias("imdbId"),
        F.when(F.col("p_size") > 1, F.floor(F.col("p_partkey") / 2)).alias("tmdbId"),
    )


def catalog(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_type") != "PROMO").select(F.col("p_partkey").alias("id"))


def user_item(t: Tables) -> DataFrame:
    """Mean rating of each customer and part."""
    return (
        ml_ratings(t)
        .groupBy(F.col("userId").alias("user_id"), F.col("movieId").alias("item_id"))
        .agg(F.avg("rating").alias("rating"))
    )


LINKED_SQL = """
links AS (SELECT p_partkey AS movie, p_brand,
  CASE WHEN p_size > 1 THEN p_partkey // 2 END AS tmdb FROM part),
linked AS (
  SELECT o_custkey AS "userId", 0.5 * ceil(l_quantity / 5) AS rating, tmdb AS "tmdbId"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN links ON l_partkey = movie),
kept AS (SELECT * FROM linked
  WHERE "tmdbId" IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO'))
"""


@query(f'WITH {LINKED_SQL} SELECT "userId", rating, "tmdbId" FROM linked')
def link_ratings(t: Tables) -> DataFrame:
    return ratings.link_ratings(ml_ratings(t), links(t))


@query(f'WITH {LINKED_SQL} SELECT "userId", rating, "tmdbId" FROM kept')
def restrict_to_catalog(t: Tables) -> DataFrame:
    linked = ratings.link_ratings(ml_ratings(t), links(t))
    return ratings.restrict_to_catalog(linked, catalog(t)).select("userId", "rating", "tmdbId")


@query(
    f"""
WITH {LINKED_SQL}
SELECT "userId", rating, k."tmdbId", p_name AS title, p_brand AS "imdbId"
FROM kept k LEFT JOIN (SELECT tmdb, p_name, l.p_brand FROM part LEFT JOIN links l
  ON p_partkey = movie) m ON k."tmdbId" = m.tmdb
"""
)
def denormalize(t: Tables) -> DataFrame:
    kept = ratings.restrict_to_catalog(
        ratings.link_ratings(ml_ratings(t), links(t)), catalog(t)
    )
    movies = t.part.select(F.col("p_partkey").alias("movieId"), F.col("p_name").alias("title"))
    joined = ratings.denormalize(kept, ratings.movie_metadata(movies, links(t)))
    return joined.select("userId", "rating", "tmdbId", "title", "imdbId")


USER_ITEM_SQL = """
r AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, avg(0.5 * ceil(l_quantity / 5)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)
"""

_SHARE_SQL = (
    "CAST('0x' || substr(md5(user_id || '|' || item_id || '|42'), 1, 8) AS BIGINT) / 4294967296.0"
)


@query(
    f"""
WITH {USER_ITEM_SQL}
SELECT user_id, item_id, {_SHARE_SQL} < 0.2 AS is_test FROM r
"""
)
def train_test_split(t: Tables) -> DataFrame:
    train, test = factors.split(user_item(t), 0.2, 42)
    return train.select("user_id", "item_id", F.lit(False).alias("is_test")).unionByName(
        test.select("user_id", "item_id", F.lit(True).alias("is_test"))
    )


@query(
    f"""
WITH {USER_ITEM_SQL},
i AS (SELECT item_id, sum(rating - (SELECT avg(rating) FROM r)) / (count(*) + 5.0) AS b
      FROM r GROUP BY item_id),
u AS (SELECT user_id, sum(rating - (SELECT avg(rating) FROM r) - b) / (count(*) + 5.0) AS b
      FROM r JOIN i USING (item_id) GROUP BY user_id)
SELECT 'item' AS side, item_id AS id, round(b, 6) AS bias FROM i
UNION ALL SELECT 'user', user_id, round(b, 6) FROM u
"""
)
def rating_biases(t: Tables) -> DataFrame:
    items, users = factors.rating_biases(user_item(t))
    return items.select(
        F.lit("item").alias("side"),
        F.col("item_id").alias("id"),
        F.round("item_bias", 6).alias("bias"),
    ).unionByName(
        users.select(
            F.lit("user").alias("side"),
            F.col("user_id").alias("id"),
            F.round("user_bias", 6).alias("bias"),
        )
    )


GIVEN_SQL = f"""
{USER_ITEM_SQL},
marked AS (SELECT *, {_SHARE_SQL} < 0.2 AS is_test FROM r),
train AS (SELECT * FROM marked WHERE NOT is_test),
m AS (SELECT avg(rating) AS mean FROM train),
ib AS (SELECT item_id, sum(rating - (SELECT mean FROM m)) / (count(*) + 5.0) AS b
      FROM train GROUP BY item_id),
ub AS (SELECT user_id, sum(rating - (SELECT mean FROM m) - b) / (count(*) + 5.0) AS b
      FROM train JOIN ib USING (item_id) GROUP BY user_id),
vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
predicted AS (
  SELECT t.user_id, t.item_id, rating,
    least(greatest((SELECT mean FROM m) + coalesce(ub.b, 0) + coalesce(ib.b, 0)
      + CASE WHEN ub.b IS NULL OR ib.b IS NULL THEN 0
        ELSE coalesce(list_dot_product(p.v, q.v), 0) END, 0.5), 5.0) AS prediction
  FROM marked t LEFT JOIN ib ON ib.item_id = t.item_id LEFT JOIN ub ON ub.user_id = t.user_id
  LEFT JOIN vecs p ON p.vec_id = t.user_id LEFT JOIN vecs q ON q.vec_id = t.item_id
  WHERE is_test)
"""


def given_model(t: Tables, train: DataFrame) -> factors.FactorModel:
    """Biases of the training part, and the embeddings of the same number as vectors."""
    items, users = factors.rating_biases(train)
    vectors = t.embeddings.select("vec_id", F.col("embedding").alias("features"))

    def side(biases: DataFrame, own: str, bias: str) -> DataFrame:
        joined = biases.join(vectors, F.col(own) == F.col("vec_id"), "left")
        return joined.select(own, F.col(bias).alias("bias"), "features")

    return factors.FactorModel(
        mean=train.agg(F.avg("rating").alias("mean")),
        users=side(users, "user_id", "user_bias"),
        items=side(items, "item_id", "item_bias"),
    )


def parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    return factors.split(landed(user_item(t), "user-item"))


@query(
    f"""
WITH {USER_ITEM_SQL},
i AS (SELECT item_id, sum(rating - (SELECT avg(rating) FROM r)) / (count(*) + 5.0) AS b
      FROM r GROUP BY item_id)
SELECT item_id, round(b, 4) AS bias, 40 AS rank, true AS beats_biases FROM i
"""
)
def train_cf(t: Tables) -> DataFrame:
    """Bias and number of factors of every item, and whether the model's error on what it
    has learned from is lower than that of mean and biases alone."""
    rated = landed(user_item(t), "user-item")
    model = factors.train_cf(rated, written=True)
    no_factors = F.lit(None).cast("array<float>")
    plain = factors.FactorModel(
        model.mean,
        model.users.withColumn("features", no_factors),
        model.items.withColumn("features", no_factors),
    )
    errors = [factors.evaluate(factors.predict(m, rated)).select("rmse").scalar() for m in (model, plain)]
    return model.items.select(
        "item_id",
        F.round("bias", 4).alias("bias"),
        F.size("features").alias("rank"),
        (errors[0] < errors[1]).alias("beats_biases"),
    )


@query(
    f"WITH {GIVEN_SQL} SELECT user_id, item_id, rating, round(prediction, 6) AS prediction "
    "FROM predicted"
)
def predict(t: Tables) -> DataFrame:
    train, test = parts(t)
    found = factors.predict(given_model(t, train), test)
    return found.withColumn("prediction", F.round("prediction", 6))


@query(
    f"""
WITH {GIVEN_SQL}
SELECT round(sqrt(avg((rating - prediction) ** 2)), 6) AS rmse,
  round(avg(abs(rating - prediction)), 6) AS mae
FROM predicted
"""
)
def evaluate(t: Tables) -> DataFrame:
    train, test = parts(t)
    errors = factors.evaluate(factors.predict(given_model(t, train), test))
    return errors.select(F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


@query(
    f"""
WITH {GIVEN_SQL},
seen AS (SELECT DISTINCT user_id, item_id FROM train),
scored AS (
  SELECT ub.user_id, ib.item_id, round(least(greatest((SELECT mean FROM m) + ub.b + ib.b
    + list_dot_product(p.v, q.v), 0.5), 5.0), 6) AS score
  FROM ub JOIN vecs p ON p.vec_id = ub.user_id, ib JOIN vecs q ON q.vec_id = ib.item_id)
SELECT user_id, item_id, score,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
FROM scored ANTI JOIN seen USING (user_id, item_id)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) <= 5
"""
)
def top_unseen(t: Tables) -> DataFrame:
    train, _ = parts(t)
    return factors.top_unseen(given_model(t, train), train)


@query()
def train_sgd(t: Tables) -> DataFrame:
    """Held-out errors of the model learned by gradient descent, and of the mean alone."""
    train, test = parts(t)
    model = sgd.train_sgd(train)
    nothing = factors.FactorModel(
        model.mean, model.users.filter("false"), model.items.filter("false")
    )
    rows = [
        factors.evaluate(factors.predict(m, test)).select(F.lit(name).alias("model"), "rmse", "mae")
        for name, m in (("mean", nothing), ("factors", model))
    ]
    return rows[0].unionByName(rows[1])


@query()
def tune(t: Tables) -> DataFrame:
    """Cross-validated errors of every choice of rank and regularisation, best first."""
    train, _ = parts(t)
    return sgd.tune(train, {"rank": [40], "rate": [0.005], "reg": [0.02, 0.025]}, blocks=2)


def item_factors(t: Tables) -> DataFrame:
    return t.embeddings.select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("features")
    )


def event_ratings(t: Tables) -> DataFrame:
    """Every event rates an item from 1 to 5; the latest event of a pair counts."""
    n_items = t.embeddings.agg(F.count(F.lit(1)).alias("n")).scalar()
    rated = t.events.select(
        "user_id",
        (F.col("event_id") % n_items).alias("item_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("rating"),
        "ts",
        "event_id",
    )
    return ratings.current(rated, tie="event_id").drop("ts")


EVENT_SQL = """
rated AS (
  SELECT user_id, event_id % (SELECT count(*) FROM embeddings) AS item_id,
    CAST(event_id % 5 + 1 AS INTEGER) AS rating FROM events
  QUALIFY row_number() OVER (
    PARTITION BY user_id, event_id % (SELECT count(*) FROM embeddings)
    ORDER BY ts DESC, event_id DESC) = 1)
"""

FOLD_SQL = f"""
{EVENT_SQL},
vecs AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
parts AS (
  SELECT user_id, i.d, avg(v[i.d] * rating / 5.0) AS x
  FROM rated JOIN vecs USING (item_id), (SELECT unnest(range(1, 65)) AS d) i
  GROUP BY user_id, i.d),
profiles AS (SELECT user_id, list(x ORDER BY d) AS p FROM parts GROUP BY user_id),
scored AS (SELECT user_id, item_id, round(list_dot_product(p, v), 6) AS score
           FROM profiles, vecs),
recs AS (SELECT user_id, item_id, score, row_number() OVER (
    PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scored
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) <= 100)
"""


def recommendations(t: Tables) -> tuple[DataFrame, DataFrame]:
    """What is recommended by the ratings, and the ratings, built once for both uses."""
    rated = landed(event_ratings(t), "event-ratings")
    return factors.fold_in(item_factors(t), rated, k=100, rank=64), rated


@query(
    f"""
WITH {FOLD_SQL}
SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM recs
"""
)
def fold_in(t: Tables) -> DataFrame:
    return recommendations(t)[0]


@query(
    f"""
WITH {FOLD_SQL}
SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank
FROM recs ANTI JOIN rated USING (user_id, item_id)
"""
)
def exclude_seen(t: Tables) -> DataFrame:
    fresh = recommend.exclude_seen(*recommendations(t))
    return fresh.select("user_id", "item_id", "rank")


@query(
    f"""
WITH {FOLD_SQL}
SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, rating IS NOT NULL AS seen,
  coalesce(CAST(rating AS VARCHAR), '?') AS own_score
FROM recs LEFT JOIN rated USING (user_id, item_id)
"""
)
def annotate_seen(t: Tables) -> DataFrame:
    marked = recommend.annotate_seen(*recommendations(t))
    return marked.select("user_id", "item_id", "rank", "seen", "own_score")


@query(
    f"""
WITH {FOLD_SQL},
marked AS (SELECT user_id, item_id, rating IS NOT NULL AS seen
           FROM recs LEFT JOIN rated USING (user_id, item_id)),
open AS (SELECT *, bool_or(NOT seen) OVER (PARTITION BY user_id) AS has_new FROM marked)
SELECT user_id, item_id, seen FROM open WHERE NOT seen OR NOT has_new
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY md5('42|' || user_id || '|' || item_id), item_id) = 1
"""
)
def surprise(t: Tables) -> DataFrame:
    return recommend.surprise(*recommendations(t))


@query(
    f"""
WITH {FOLD_SQL},
asked AS (SELECT DISTINCT user_id FROM rated UNION SELECT -o_custkey FROM orders),
best AS (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank
  FROM rated GROUP BY item_id QUALIFY rank <= 100)
SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM recs
UNION ALL
SELECT user_id, item_id, NULL, CAST(rank AS INTEGER)
FROM (SELECT user_id FROM asked ANTI JOIN recs USING (user_id)), best
"""
)
def cold_users(t: Tables) -> DataFrame:
    """Customers have no rating of an item with a vector: they get the popular items."""
    found, rated = recommendations(t)
    recs = landed(found, "recs")
    new = t.orders.select((-F.col("o_custkey")).alias("user_id"))
    return factors.with_popular(recs, rated.select("user_id").union(new), rated)
