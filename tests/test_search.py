from pyspark.sql import functions as F

from marquee.functions import fold_text
from marquee.operators import profile, search, stats


def films(spark):
    data = [
        (1, "Amélie", ["Comedy", None], ["A"], ["P"], 2001, "fr", 122),
        (2, "Alien", ["Horror"], ["B"], None, 1979, "en", 117),
        (3, "Aliens", ["Action"], ["B", "A"], [], 1986, "en", 137),
        (4, "My alien", ["Documentary", "Comedy"], None, ["P"], None, "en", 89),
        (5, "Alien", None, [], ["P"], 2020, None, None),
        (6, "alien zone", ["Documentary"], ["C"], ["Q"], 1999, "en", 90),
    ]
    df = spark.createDataFrame(
        data,
        "id bigint, title_final string, genres array<string>, actor_actress array<string>, "
        "producer array<string>, startYear int, original_language string, runtimeMinutes int",
    )
    return df.withColumn("title_search", fold_text(F.col("title_final"))).withColumn(
        "row_order", F.col("id")
    )


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_filters(spark):
    df = films(spark)
    assert ids(search.filter_catalog(df)) == [1, 2, 3, 4, 5, 6]
    assert ids(search.filter_catalog(df, genre="Comedy")) == [1, 4]
    assert ids(search.filter_catalog(df, actor="A", producer="Tous")) == [1, 3]
    assert ids(search.filter_catalog(df, duration="90-120 min")) == [2, 6]
    assert ids(search.filter_catalog(df, duration="Moins de 90 min")) == [4]
    assert ids(search.filter_catalog(df, duration="Toutes", year=1986)) == [3]
    assert ids(search.documentaries(df)) == [4, 6]
    one = search.filter_catalog(search.filter_catalog(df, language="en"), actor="B")
    two = search.filter_catalog(search.filter_catalog(df, actor="B"), language="en")
    assert ids(one) == ids(two) == [2, 3]


def test_filter_search_counts_all_matches(spark):
    got = search.filter_search(films(spark), n=2, seed=1, language="en").collect()
    assert len(got) == 2 and {r["n_found"] for r in got} == {4}


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = search.sample_n(df.repartition(1), 20, 5, "k").collect()
    two = search.sample_n(df.repartition(7), 20, 5, "k").collect()
    assert one == two and len(one) == 20
    assert one != search.sample_n(df, 20, 6, "k").collect()


def test_facets(spark):
    df = films(spark)
    values = lambda *a, **k: [r["value"] for r in search.facet_values(df, *a, **k).collect()]
    assert values("producer") == ["P", "Q"]
    assert values("startYear", desc=True) == [2020, 2001, 1999, 1986, 1979]
    assert values("original_language") == ["en", "fr"]


def expected_search(entries, query):
    """Tiers of the list form: exact, starting with, containing."""
    exact = [t for k, t, _ in entries if k == query]
    starts = [t for k, t, _ in entries if k.startswith(query) and t not in exact]
    inside = [t for k, t, _ in entries if query in k and t not in exact + starts]
    return (exact + sorted(starts, key=str.lower) + sorted(inside, key=str.lower))[:20]


def test_title_search_matches_list_form(spark):
    df = films(spark)
    more = spark.range(60).select(
        (F.col("id") + 100).alias("row_order"),
        F.concat(F.lit("Zone "), (F.col("id") * 7 % 60).cast("string")).alias("title_final"),
    ).withColumn("title_search", fold_text(F.col("title_final")))
    catalog = df.select("row_order", "title_final", "title_search").unionByName(
        more.select("row_order", "title_final", "title_search")
    )
    plain = ["amelie", "a", "ie", "zone", "zone 1", "no such", "", "lie", "e 1"]
    asked = {**dict(zip(plain, plain, strict=True)), "ALIEN": "alien", "!!": ""}
    queries = spark.createDataFrame([(q, q) for q in asked], "query_id string, query string")
    entries = [
        (r["title_search"], r["title_final"], r["row_order"])
        for r in catalog.orderBy("row_order").collect()
    ]
    got = {}
    for r in search.title_search(catalog, queries).orderBy("query_id", "position").collect():
        got.setdefault(r["query_id"], []).append(r["title"])
    for q, key in asked.items():
        want = expected_search(entries, key) if key else []
        assert got.get(q, []) == want, q


def test_title_search_with_shuffled_join(spark, monkeypatch):
    queries = spark.createDataFrame([("q", "alien")], "query_id string, query string")
    usual = search.title_search(films(spark), queries).collect()
    monkeypatch.setattr(search, "settle", lambda df, name: df.hint("merge"))
    assert sorted(search.title_search(films(spark), queries).collect()) == sorted(usual)


def test_matches_are_sorted_in_partitions_that_follow_the_catalogue(spark, monkeypatch):
    monkeypatch.setattr(search, "PART_BYTES", 1000)
    queries = spark.createDataFrame([("q", "zone"), ("n", "zone 39")], "query_id string, query string")
    for n in (500, 1000):
        key = F.concat(F.lit("zone "), F.lpad(F.col("id").cast("string"), 5, "0"))
        catalog = spark.range(n).coalesce(1).select(
            F.col("id").alias("row_order"), key.alias("title_final"), key.alias("title_search")
        )
        entries = catalog.toDF("row_order", "title", "key")
        sizes = search._spread(entries).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 250 and sum(r["count"] for r in sizes) == n
        found = search.title_search(catalog, queries)
        assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
        assert [r["row_order"] for r in found.orderBy("position").collect()] == list(range(20))
    assert search._spread(entries.filter("false")).count() == 0


def test_lookup_title_takes_first(spark):
    queries = spark.createDataFrame([("q", " ALIEN "), ("n", "none")], "query_id string, query string")
    got = search.lookup_title(films(spark), queries).collect()
    assert [(r["query_id"], r["id"]) for r in got] == [("q", 2)]


def test_metrics(spark):
    row = stats.catalog_metrics(films(spark)).first()
    assert (row["titles"], row["cast_rows"], row["languages"], row["cast_distinct"]) == (5, 7, 2, 3)
    counts = [tuple(r) for r in stats.genre_counts(films(spark)).collect()]
    assert counts[:2] == [("Comedy", 2), ("Documentary", 2)]


def test_histogram(spark):
    df = spark.createDataFrame([(x / 10,) for x in range(66, 98)], "r double")
    bins = stats.nice_histogram(df, "r").collect()
    assert len(bins) <= 31 and sum(b["n"] for b in bins) == 32
    assert abs(bins[0]["bin_end"] - bins[0]["bin_start"] - 0.2) < 1e-9
    assert stats.nice_histogram(df.limit(1), "r").first()["n"] == 1


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "x")], "a int, b string")
    assert rows(profile.null_counts(df)) == [("a", 0), ("b", 1)]
    assert rows(profile.rows_with_nulls(df)) == [(1, None)]
    assert rows(profile.value_counts(df, "b")) == [("x", 2)]
    assert rows(profile.shape(df)) == [(3, 2)]
    report = profile.check_schema(df, {"a": "int", "b": "int", "c": "int"})
    assert rows(report) == [
        ("a", "int", "int", True, 3, 3),
        ("b", "int", "string", False, 2, 3),
        ("c", "int", None, False, 0, 3),
    ]
