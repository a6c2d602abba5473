import datetime as dt

from marquee.operators import details, ratings, users
from marquee.sources import schemas

T0 = dt.datetime(2024, 1, 1)


def submissions(spark):
    hour = lambda n: T0 + dt.timedelta(hours=n)
    return spark.createDataFrame(
        [
            ("u", "submit_ratings", {"1": 3, "2.0": 4}, None, hour(1)),
            ("u", "submit_ratings", {"1": 5}, None, hour(2)),
            ("u", "add_watchlist", None, "1", hour(0)),
            ("u", "add_watchlist", None, "9", hour(3)),
            ("u", "add_watchlist", None, "9", hour(4)),
            ("u", "add_watchlist", None, "8", hour(5)),
            ("v", "add_watchlist", None, "1", hour(0)),
        ],
        schemas.SUBMISSIONS,
    )


def test_interaction_log(spark, rows):
    log = submissions(spark)
    current = ratings.current(ratings.explode_submissions(log))
    assert rows(current, "user_id", "item_id", "rating") == [("u", "1", 5), ("u", "2", 4)]
    waiting = ratings.pending(ratings.watchlist(log), current)
    assert rows(waiting, "user_id", "item_id") == [("u", "8"), ("u", "9"), ("v", "1")]
    assert rows(ratings.pending_summary(waiting)) == [("u", 2, "9"), ("v", 1, "1")]


def test_from_stars(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 4)], "film int, stars int")
    assert rows(ratings.from_stars(df), "film", "rating") == [(1, 1), (3, 5)]


def test_linking(spark, rows):
    rated = spark.createDataFrame(
        [(1, 10, 4.0, 0), (1, 11, 3.0, 0), (2, 12, 2.0, 0)], schemas.ML_RATINGS
    )
    links = spark.createDataFrame([(10, "a", 100), (11, "b", None), (12, "c", 100)], schemas.ML_LINKS)
    linked = ratings.link_ratings(rated, links)
    assert rows(linked, "userId", "rating", "tmdbId") == [(1, 3.0, None), (1, 4.0, 100), (2, 2.0, 100)]
    catalog = spark.createDataFrame([(100,), (100,)], "id bigint")
    kept = ratings.restrict_to_catalog(linked, catalog)
    assert kept.count() == 2
    movies = spark.createDataFrame([(10, "x", ""), (12, "y", "")], schemas.ML_MOVIES)
    assert ratings.denormalize(kept, ratings.movie_metadata(movies, links)).count() == 4


def test_users(spark, rows):
    raw = spark.createDataFrame(
        [
            (1, "ann", "p", "Ann", "a@x", None, '["War"]', None),
            (2, "ann", "p", "Ann B", "a@x", "admin", '["War"]', "oops"),
            (3, "bob", None, "Bob", "b@x", None, None, None),
            (4, "10", "p", "Ten", "t@x", None, None, '["Music"]'),
            (5, "", "p", "No", "n@x", None, None, None),
        ],
        f"row int, {schemas.USERS}",
    )
    parsed = users.parse_users(raw, "row")
    assert "password" not in parsed.columns
    assert rows(parsed) == [
        ("10", "Ten", "t@x", "utilisateur", [], ["Music"]),
        ("ann", "Ann B", "a@x", "admin", [], []),
    ]
    assert rows(users.valid_users(raw), "row") == [(1,), (2,)]
    updates = spark.createDataFrame(
        [("10", ["A"], [], 1), ("10", ["B"], ["C"], 2)],
        "username string, genres_pref array<string>, doc_genres_pref array<string>, ts int",
    )
    changed = users.apply_updates(parsed, updates)
    assert rows(changed, "username", "genres_pref", "doc_genres_pref") == [
        ("10", ["B"], ["C"]),
        ("ann", [], []),
    ]
    assert rows(users.to_payload(changed), "username", "genres_pref")[0] == ("10", '["B"]')


def test_onboarded(spark, rows):
    df = spark.createDataFrame(
        [("a", i) for i in range(5)] + [("b", i % 4) for i in range(9)], "user_id string, item_id int"
    )
    assert rows(users.onboarded(df)) == [("a", 5)]


def test_numeric_ids(spark, rows):
    df = spark.createDataFrame([("12.0",), ("x",), (None,), (" 7",)], "id string")
    assert rows(details.numeric_ids(df)) == [("12",), ("7",)]


def test_details(spark):
    films = spark.createDataFrame(
        [
            (1, "One", "1999-01-01", 90, " ", "/p", [("Drame",), ("Guerre",)]),
            (2, "Two", None, None, "y" * 500, None, None),
            (3, "Three", "2000", 1, None, None, []),
            (None, "No id", None, None, None, None, None),
        ],
        schemas.FILM_DETAILS,
    )
    credits = spark.createDataFrame(
        [(1, [("Director", "D"), ("Writer", "W"), ("Director", "E")], [(c,) for c in "abcdefg"])],
        schemas.FILM_CREDITS,
    )
    english = spark.createDataFrame([(1, "In English")], "id bigint, overview string")
    got = {r["id"]: r for r in details.flatten(films, credits, english).collect()}
    assert set(got) == {"1", "2", "3"}
    one, two, three = got["1"], got["2"], got["3"]
    assert (one["year"], one["genre_names"], one["directors"]) == ("1999", "Drame, Guerre", ["D", "E"])
    assert one["actors"] == list("abcde") and one["overview"] == "In English"
    assert one["poster_url"] == "https://image.tmdb.org/t/p/w500/p"
    assert (two["year"], two["directors"], two["poster_url"]) == ("????", [], None)
    assert len(two["overview"]) == 500 and two["overview_short"] == "y" * 400 + "..."
    assert three["overview"] == "Aucun résumé."
