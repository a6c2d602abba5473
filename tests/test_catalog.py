import pytest
from pyspark.sql import functions as F

from marquee.operators import catalog, titles
from marquee.plans import pipelines
from marquee.sources import schemas


def test_quality_gate_is_strict(spark, rows):
    good = ("ok", "movie", "1991", "6.6", "76", "501")
    cases = [
        good,
        ("year", "movie", "1990", "6.6", "76", "501"),
        ("kind", "short", "1991", "6.6", "76", "501"),
        ("rating", "movie", "1991", "6.5", "76", "501"),
        ("runtime", "movie", "1991", "6.6", "75", "501"),
        ("votes", "movie", "1991", "6.6", "76", "500"),
        ("blank", "movie", "\\N", "6.6", "76", "501"),
        ("null", "movie", "1991", None, "76", "501"),
    ]
    df = spark.createDataFrame(
        cases,
        "tconst string, titleType string, startYear string, averageRating string, "
        "runtimeMinutes string, numVotes string",
    )
    assert rows(catalog.quality_gate(df), "tconst") == [("ok",)]


def credits(spark):
    return spark.createDataFrame(
        [
            ("t1", 2, "b", "actor"),
            ("t1", 1, "a", "actor"),
            ("t1", 3, "a", "actor"),
            ("t1", 4, "c", "actress"),
            ("t1", 5, "d", "composer"),
            ("t2", 1, "e", "producer"),
        ],
        "tconst string, ordering int, nconst string, category string",
    )


def test_principals_pivot(spark, rows):
    got = rows(catalog.principals_pivot(credits(spark)))
    assert got == [
        ("t1", ["a", "b", "a"], ["c"], []),
        ("t2", [], [], ["e"]),
    ]


def test_a_title_of_many_credits_is_one_row(spark):
    """However many credits, and however far apart their order, a title is one film."""
    many = spark.range(5000).select(
        F.lit("hot").alias("tconst"),
        F.when(F.col("id") == 4999, F.lit(2_000_000_000)).otherwise(F.col("id")).cast("int").alias(
            "ordering"
        ),
        F.concat(F.lit("n"), "id").alias("nconst"),
        F.lit("actor").alias("category"),
    )
    df = catalog.principals_pivot(many.unionByName(credits(spark)))
    (hot,) = df.filter("tconst = 'hot'").collect()
    assert hot["actor"] == [f"n{i}" for i in range(5000)]
    assert df.count() == 3
    names = spark.createDataFrame([("n1", "Ann"), ("a", "Bob")], "nconst string, primaryName string")
    named = catalog.cast_lists(catalog.name_credits(catalog.select_credits(many), names))
    assert named.first()["actor"][:3] == [None, "Ann", None]


def test_resolve_names(spark, rows):
    names = spark.createDataFrame(
        [("a", "Ann"), ("b", "Bob")], "nconst string, primaryName string"
    )
    df = spark.createDataFrame(
        [("t1", "b,a,x", ["a", "a"]), ("t2", None, []), ("t3", "x", None)],
        "tconst string, directors string, actor array<string>",
    )
    got = rows(catalog.resolve_names(df, names, ["directors", "actor"]))
    assert got == [
        ("t1", ["Bob", "Ann", None], ["Ann", "Ann"]),
        ("t2", None, []),
        ("t3", [None], None),
    ]


@pytest.mark.parametrize("dedup, films", [(False, 2), (True, 1)])
def test_enrich_fans_out_unless_deduplicated(spark, dedup, films):
    base = spark.createDataFrame([("t1",), ("t2",)], "tconst string")
    extra = spark.createDataFrame(
        [("t1", 9, "fr", "x", "p"), ("t1", 5, "en", "x", "p"), (None, 1, "en", "x", "p")],
        "imdb_id string, id bigint, original_language string, genres string, poster_path string",
    )
    got = catalog.enrich(base, extra, dedup)
    assert "genres" not in got.columns
    assert got.filter("tconst = 't1'").count() == films
    assert got.filter("tconst = 't2' AND id IS NULL").count() == 1
    if dedup:
        assert got.filter("tconst = 't1'").first()["id"] == 5


def test_language_and_missing(spark, rows):
    df = spark.createDataFrame(
        [("en", "p", "o"), ("zh", "p", "o"), (None, "p", "o"), ("fr", None, "o"), ("ja", "p", None)],
        "original_language string, poster_path string, overview string",
    )
    kept = catalog.drop_incomplete(catalog.keep_languages(df))
    assert rows(kept, "original_language") == [("en",)]


def test_first_per_key_and_title_final(spark, rows):
    akas = spark.createDataFrame(
        [("t1", 3, "Trois", "FR"), ("t1", 2, "Déjà", "FR"), ("t1", 1, "One", "US")],
        "titleId string, ordering int, title string, region string",
    )
    films = spark.createDataFrame([("t1", "One"), ("t2", "Two")], "tconst string, primaryTitle string")
    got = rows(titles.search_catalog(films, akas))
    assert got == [("t1", "Déjà", "deja"), ("t2", "Two", "two")]


def sources(spark):
    frame = spark.createDataFrame
    basics = frame(
        [
            ("t1", "movie", "One", "One", "0", "2000", None, "100", "Drama,Sci-Fi"),
            ("t2", "movie", "Old", "Old", "0", "1980", None, "100", "Drama"),
            ("t3", "movie", "Three", "Three", "0", "2001", None, "90", None),
        ],
        schemas.TITLE_BASICS,
    )
    crew = frame([("t1", "n1", "n1,n9"), ("t2", "n1", None), ("t3", None, None)], schemas.TITLE_CREW)
    ratings = frame(
        [("t1", "7.1", "600"), ("t2", "9.0", "900"), ("t3", "8.0", "700")], schemas.TITLE_RATINGS
    )
    principals = frame(
        [
            ("t1", 1, "n2", "actress", None, None),
            ("t1", 2, "n1", "actor", None, None),
            ("t2", 1, "n1", "actor", None, None),
        ],
        schemas.TITLE_PRINCIPALS,
    )
    names = frame(
        [("n1", "Ann Lee", None, None, None, None), ("n2", "Bo", None, None, None, None)],
        schemas.NAME_BASICS,
    )
    extra = frame(
        [
            {
                "id": i,
                "imdb_id": t,
                "original_language": "en",
                "overview": "The dogs are running",
                "poster_path": "/p.jpg",
                "budget": "12.0",
                "revenue": "x",
                "popularity": 1.5,
                "production_companies_name": "['A B', \"C's\"]",
                "genres": "ignored",
            }
            for i, t in ((11, "t1"), (13, "t3"))
        ],
        schemas.TMDB,
    )
    akas = frame([("t1", 1, "Un été", "FR", None, None, None, None)], schemas.TITLE_AKAS)
    return basics, crew, ratings, principals, names, extra, akas


def test_pipeline_end_to_end(spark):
    *tables, akas = sources(spark)
    films = pipelines.build_catalog(*tables)
    assert dict(films.dtypes) == schemas.CATALOG and films.columns == list(schemas.CATALOG)
    by_id = {r["tconst"]: r for r in films.collect()}
    assert set(by_id) == {"t1", "t3"}
    one = by_id["t1"]
    assert one["genres"] == ["Drama", "Sci-Fi"]
    assert one["actor_actress"] == ["Ann Lee", "Bo"]
    assert one["writers"] == ["Ann Lee", None]
    assert one["production_companies_name"] == ["A B", "C's"]
    assert (one["budget"], one["revenue"]) == (12, None)
    assert by_id["t3"]["actor_actress"] == [] and by_id["t3"]["genres"] == []

    ready = {r["tconst"]: r for r in pipelines.build_text_columns(films).collect()}
    assert ready["t1"]["NLP"] == "dogs running"
    assert ready["t1"]["actor_actress_clean"] == "annlee bo"
    assert ready["t1"]["writers_clean"] == "annlee"

    found = {r["tconst"]: r for r in pipelines.build_search(films, akas).collect()}
    assert found["t1"]["title_final"] == "Un été" and found["t1"]["title_search"] == "un ete"
    assert found["t3"]["title_final"] == "Three"
    assert pipelines.build_features(films).filter("block = 'year'").count() == 2
