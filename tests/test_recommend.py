import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import factors, ranking, recommend


def vectors(spark, data, id_col):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in data.items()], f"{id_col} int, features array<double>"
    )


@pytest.mark.parametrize("per_block", [(1000, 1000), (7, 5), (1, 1)])
def test_top_scores_is_brute_force_for_any_blocks(spark, per_block):
    rng = np.random.default_rng(3)
    users = {i: rng.integers(-3, 4, 4) for i in range(20)}
    items = {i * 3: rng.integers(-3, 4, 4) for i in range(30)}
    got = {}
    best = factors.top_scores(
        vectors(spark, users, "user_id"),
        vectors(spark, items, "item_id"),
        6,
        items_per_block=per_block[0],
        queries_per_block=per_block[1],
    )
    for r in best.orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append((r["item_id"], r["score"]))
    for user, u in users.items():
        ranked = sorted((-float(u @ v), i) for i, v in items.items())[:6]
        assert got[user] == [(i, -s) for s, i in ranked]


@pytest.mark.parametrize("clip", [None, (-2.0, 9.0)])
def test_bounds_skip_blocks_and_lose_nothing(spark, clip):
    """Norms fall fast: most pairs of a query and a block never meet, and the rows are
    those of brute force; some queries keep more rows than others."""
    rng = np.random.default_rng(5)
    users = {i: rng.normal(size=6) for i in range(40)}
    items = {i: rng.normal(size=6) * 20 / (1 + i % 200) for i in range(400)}
    more = {i: i % 3 for i in users}
    asked = vectors(spark, users, "user_id").withColumn("more", F.col("user_id") % 3)
    report = []
    best = factors.top_scores(
        asked, vectors(spark, items, "item_id"), 4, clip=clip, extra="more",
        items_per_block=10, queries_per_block=16, report=report,
    )
    got = {}
    for r in best.orderBy("user_id", F.desc("score"), "item_id").collect():
        got.setdefault(r["user_id"], []).append((r["item_id"], r["score"]))
    for user, u in users.items():
        scores = {i: float(u @ v) for i, v in items.items()}
        if clip:
            scores = {i: min(max(x, clip[0]), clip[1]) for i, x in scores.items()}
        ranked = sorted((-round(x, 6) + 0.0, i) for i, x in scores.items())[: 4 + more[user]]
        assert got[user] == [(i, -x + 0.0) for x, i in ranked]
    met, pairs = sum(r["met"] for r in report), 40 * 40
    assert met < (0.5 if clip is None else 0.8) * pairs


def test_fold_in_averages_known_items_only(spark):
    items = vectors(spark, {1: [1, 0], 2: [0, 1], 3: [1, 1]}, "item_id")
    rated = spark.createDataFrame(
        [("u", 1, 5.0), ("u", 2, 2.5), ("u", 99, 5.0), ("none", 99, 5.0)],
        "user_id string, item_id int, rating double",
    )
    got = [tuple(r) for r in factors.fold_in(items, rated, k=2).orderBy("rank").collect()]
    assert got == [("u", 3, 0.75, 1), ("u", 1, 0.5, 2)]


def planted(spark, n_users=60, n_items=50):
    rng = np.random.default_rng(0)
    p, q = rng.normal(size=(n_users, 2)), rng.normal(size=(n_items, 2))
    rows = [
        (u, i, float(np.clip(3 + p[u] @ q[i], 0.5, 5)))
        for u in range(n_users)
        for i in range(n_items)
        if rng.random() < 0.6
    ]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double")


def test_model_beats_the_mean_and_survives_a_save(spark, tmp_path):
    train, test = factors.split(planted(spark))
    share = test.count() / (train.count() + test.count())
    assert 0.15 < share < 0.25 and train.join(test, ["user_id", "item_id"], "left_semi").count() == 0
    model = factors.train_cf(train, rank=4, iterations=8, reg=0.05)
    scores = factors.evaluate(factors.predict(model, test)).first()
    mean = train.agg(F.avg("rating")).first()[0]
    base = test.agg(F.sqrt(F.avg((F.col("rating") - mean) ** 2))).first()[0]
    assert scores["rmse"] < 0.6 * base and scores["mae"] < scores["rmse"]

    model.save(str(tmp_path / "model"))
    loaded = factors.FactorModel.load(spark, str(tmp_path / "model"))
    again = factors.evaluate(factors.predict(loaded, test)).first()
    assert abs(again["rmse"] - scores["rmse"]) < 1e-12

    unknown = spark.createDataFrame([(-1, -1)], "user_id int, item_id int")
    assert abs(factors.predict(model, unknown).first()["prediction"] - mean) < 1e-9


def test_hot_items_are_as_accurate_as_others(spark):
    """Two items are rated by everybody. Ids are texts."""
    rng = np.random.default_rng(1)
    p, q = rng.normal(size=(300, 2)), rng.normal(size=(40, 2))
    data = spark.createDataFrame(
        [
            (f"u{u}", f"i{i}", float(np.clip(3 + p[u] @ q[i], 0.5, 5)))
            for u in range(300)
            for i in range(40)
            if i < 2 or rng.random() < 0.3
        ],
        "user_id string, item_id string, rating double",
    )
    train, test = factors.split(data)
    model = factors.train_cf(train, rank=3, iterations=8, reg=0.05)
    assert model.items.count() == 40 and model.users.count() == 300
    hot = F.col("item_id").isin("i0", "i1")
    rmse = [
        factors.evaluate(factors.predict(model, test.filter(part))).first()["rmse"]
        for part in (hot, ~hot)
    ]
    assert rmse[0] < 1.2 * rmse[1]


def test_cold_users_get_the_popular_items(spark):
    rated = spark.createDataFrame(
        [("a", 1), ("b", 1), ("b", 2), ("c", 3)], "user_id string, item_id int"
    )
    known = spark.createDataFrame(
        [("a", 9, 0.5, 1)], "user_id string, item_id int, score double, rank int"
    )
    users = spark.createDataFrame([("a",), ("new",), ("new",)], "user_id string")
    got = factors.with_popular(known, users, rated, k=2).collect()
    assert sorted((r["user_id"], r["item_id"], r["rank"]) for r in got) == [
        ("a", 9, 1),
        ("new", 1, 1),
        ("new", 2, 2),
    ]


def test_fit_best_refits_the_best_choice(spark):
    grid = {"rank": [2], "iterations": [3], "reg": [0.05, 5.0]}
    model, choice, errors = factors.fit_best(planted(spark, 20, 20), grid)
    assert choice == {"rank": 2, "iterations": 3, "reg": 0.05}
    assert model.items.count() == 20 and errors.first()["rmse"] > 0


def test_top_unseen_is_the_best_of_all_predictions(spark):
    rated = planted(spark, 12, 15)
    model = factors.train_cf(rated, rank=3, iterations=4)
    got = {}
    for r in factors.top_unseen(model, rated, k=3).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["item_id"])
    pairs = model.users.select("user_id").crossJoin(model.items.select("item_id"))
    seen = {(r["user_id"], r["item_id"]) for r in rated.collect()}
    want = {}
    for r in factors.predict(model, pairs).collect():
        if (r["user_id"], r["item_id"]) not in seen:
            want.setdefault(r["user_id"], []).append(
                (-round(r["prediction"], 6), r["item_id"])
            )
    assert got == {u: [i for _, i in sorted(v)[:3]] for u, v in want.items()}


def test_tune_orders_by_rmse(spark):
    got = factors.tune(planted(spark, 20, 20), {"rank": [2], "iterations": [3], "reg": [0.05, 5.0]})
    assert [r["reg"] for r in got.collect()] == [0.05, 5.0]


def recs(spark):
    return spark.createDataFrame(
        [("u", i, 1.0 / i) for i in (1, 2, 3)] + [("v", 1, 1.0), ("w", 7, 1.0)],
        "user_id string, item_id int, score double",
    )


def own(spark):
    return spark.createDataFrame(
        [("u", " 1.0", 4), ("u", "2", 5), ("v", "1", 3)], "user_id string, item_id string, rating int"
    )


def test_seen_items(spark, rows):
    assert rows(recommend.exclude_seen(recs(spark), own(spark)), "user_id", "item_id") == [
        ("u", 3),
        ("w", 7),
    ]
    marked = recommend.annotate_seen(recs(spark), own(spark))
    assert rows(marked, "user_id", "item_id", "seen", "own_score") == [
        ("u", 1, True, "4"),
        ("u", 2, True, "5"),
        ("u", 3, False, "?"),
        ("v", 1, True, "3"),
        ("w", 7, False, "?"),
    ]


def test_surprise_is_unseen_unless_all_are_seen(spark, rows):
    for seed in range(3):
        got = rows(recommend.surprise(recs(spark), own(spark), seed))
        assert got == [("u", 3, False), ("v", 1, True), ("w", 7, False)]


def test_number_in_group_counts_up_without_gaps(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("g"), F.col("id").alias("k")
    )
    got = ranking.number_in_group(df, "g", "k").collect()
    for group, size in (("hot", 4000), ("cold", 1000)):
        assert sorted(r["position"] for r in got if r["g"] == group) == list(range(size))


def test_surprise_documentary(spark):
    films = spark.createDataFrame(
        [
            (1, ["Documentary", "War"]),
            (2, ["War"]),
            (3, ["Documentary", "Music", None]),
            (4, ["Documentary", "War", "Music"]),
            (5, None),
        ],
        "id int, genres array<string>",
    )
    wanted = {"War": {1, 4}, "Music": {3, 4}, "none": {1, 3, 4}, "Sport": {1, 3, 4}}
    users = spark.createDataFrame(
        [(f"{t}{n}", None if t == "none" else [t]) for t in wanted for n in range(200)],
        "user_id string, doc_genres_pref array<string>",
    )
    drawn = {t: [] for t in wanted}
    for r in recommend.surprise_documentary(films, users, 1).collect():
        drawn[r["user_id"].rstrip("0123456789")].append(r["item_id"])
    for theme, films_ in wanted.items():
        assert len(drawn[theme]) == 200 and set(drawn[theme]) == films_
        assert min(drawn[theme].count(f) for f in films_) > 200 / len(films_) * 0.6


def test_a_block_gives_only_items_that_reach_the_least_score(spark):
    """Ties with it stay, a query without one gets its best, and clipped scores count."""
    left = spark.createDataFrame(
        [(1, [1.0], 0, 3.0, 0, 0), (2, [1.0], 1, None, 0, 0), (3, [1.0], 0, 9.0, 0, 0)],
        "q int, qv array<double>, more bigint, least double, qb int, ib int",
    )
    right = spark.createDataFrame(
        [(i, [float(i)], 0, 0) for i in range(1, 6)], "i int, iv array<double>, qb int, ib int"
    )

    def met(clip):
        return sorted((r["q"], r["i"], r["score"]) for r in factors._met(left, right, 4, clip).collect())

    every = [(2, i, float(i)) for i in range(1, 6)]
    assert met(None) == [(1, i, float(i)) for i in (3, 4, 5)] + every
    clipped = [(q, i, min(x, 4.0)) for q, i, x in every]
    assert met((0.5, 4.0)) == [(1, i, min(float(i), 4.0)) for i in (3, 4, 5)] + clipped


def test_profiles_are_averaged_after_the_shuffle(spark, monkeypatch):
    """No sums for each dimension are shuffled, with vectors small or large."""
    rng = np.random.default_rng(4)
    items = {i: rng.normal(size=3) for i in range(8)}
    rated = [(u, i, float(1 + (u + i) % 5)) for u in range(9) for i in range(10) if (u * i) % 3]
    ratings = spark.createDataFrame(rated, "user_id int, item_id int, rating double")
    want = {
        u: np.mean([items[i] * r / 5 for v, i, r in rated if v == u and i in items], axis=0)
        for u in {u for u, i, _ in rated if i in items}
    }
    for limit in (factors.BROADCAST_BYTES, 0):
        monkeypatch.setattr(factors, "BROADCAST_BYTES", limit)
        found = factors.profiles(vectors(spark, items, "item_id"), ratings, 3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("partial_avg") < plan.index("Exchange hashpartitioning(user_id")
        got = {r["user_id"]: r["features"] for r in found.collect()}
        assert got.keys() == want.keys()
        assert all(np.allclose(got[u], want[u]) for u in want)


def test_biases_of_items_are_computed_once(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 3.0)], "user_id int, item_id int, rating double"
    )
    items, users = factors.rating_biases(ratings)
    assert any("item-bias" in f for f in users.inputFiles())
    assert {r["item_id"]: round(r["item_bias"], 6) for r in items.collect()} == {
        1: round(1 / 7, 6), 2: round(-1 / 6, 6),
    }
