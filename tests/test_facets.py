import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import facets, stats

FILMS = "id string, genres array<string>, year int, language string"


def films(n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        genres = [rng.choice(["drama", "action", None, "comedy"]) for _ in range(rng.randint(0, 3))]
        rows.append(
            (f"f{k}", rng.choice([genres, genres, None]), rng.choice([1990, 2000, None]), rng.choice("abc"))
        )
    return rows


def brute(rows, choices):
    out = {}
    for _, genres, year, language in rows:
        own = {"genres": set(genres or []), "year": {year}, "language": {language}}
        own = {f: {str(v) for v in vs if v is not None} for f, vs in own.items()}
        for facet, values in own.items():
            met = all(str(v) in own[f] for f, v in choices.items() if f != facet)
            for value in values:
                out[facet, value] = out.get((facet, value), 0) + met
    return out


@pytest.mark.parametrize(
    "choices",
    [{}, {"genres": "drama"}, {"genres": "drama", "year": 2000}, {"language": "x"},
     {"genres": "comedy", "year": 1990, "language": "b"}, {"genres": "drama", "language": "x"}],
)
def test_counts_under_the_other_choices(spark, choices):
    rows = films()
    index = facets.bitmap_index(spark.createDataFrame(rows, FILMS), ["genres", "year", "language"])
    got = {(r["facet"], r["value"]): r["n"] for r in facets.facet_counts(index, choices).collect()}
    assert got == brute(rows, choices)


def test_several_buckets_and_no_choice(spark):
    many = spark.range(70_000).select(
        F.col("id").cast("string").alias("id"),
        (F.col("id") % 2).alias("even"),
        (F.col("id") % 3).alias("third"),
    )
    index = facets.bitmap_index(many, ["even", "third"])
    assert index.select("bucket").distinct().count() == 3
    got = {tuple(r) for r in facets.facet_counts(index, {"even": 1, "third": None}).collect()}
    assert got == {
        ("even", "0", 35_000), ("even", "1", 35_000),
        ("third", "0", 11_667), ("third", "1", 11_667), ("third", "2", 11_666),
    }
    none = facets.bitmap_index(many.filter("false"), ["even"])
    assert facets.facet_counts(none, {"even": 1}).count() == 0


def test_sketches_add_up(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("day"),
        (F.col("id") % 20_000).alias("user"),
        F.array(F.lit("a"), F.lit(None).cast("string"), (F.col("id") % 5).cast("string")).alias("tags"),
    )
    first = stats.distinct_sketches(df.filter("day < 3"), "day", ["user", "tags"])
    rest = stats.distinct_sketches(df.filter("day >= 3"), "day", ["user", "tags"])
    got = {r["column"]: r["n"] for r in stats.distinct_estimates(first.unionByName(rest)).collect()}
    assert got["tags"] == 6
    assert abs(got["user"] - 20_000) < 3 * 1.04 / 64 * 20_000
