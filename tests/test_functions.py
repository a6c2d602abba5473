import ast
import re

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee import functions as fn
from marquee.functions.genres import DOCUMENTARY_GENRES, FILM_GENRES


def apply(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expr(F.col("c"))).collect()]


def test_fold_text_edges(spark):
    keys = {
        "Amélie": "amelie",
        "Kill Bill: Vol. 1": "kill bill vol 1",
        "ﬁn": "fin",
        "½": "1 2",
        "Œuvre": "uvre",
        "Łódź": "odz",
        "?!...": "",
        "": "",
        "á𝐀ﬁ😀x": "aafi x",
        "１２": "12",
        "İstanbul ẞ K": "istanbul k",
        " two  spaces\t": "two spaces",
    }
    assert apply(spark, list(keys), fn.fold_text) == list(keys.values())
    assert apply(spark, [None], fn.fold_text) == [None]


def test_fold_text_every_character(spark):
    """DuckDB takes accents off by tables of its own; where its result is plain letters and
    digits, the key must be the same. ASCII is checked by class."""
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    got = dict(zip(codes, apply(spark, [f"x{chr(c)}y" for c in codes], fn.fold_text), strict=True))
    plain = duckdb.sql(
        "SELECT i, lower(strip_accents(chr(i::INTEGER))) AS s FROM (SELECT unnest(range(128, "
        "55296) || range(57344, 1114112)) AS i) WHERE s SIMILAR TO '[a-z0-9]'"
    ).fetchall()
    assert len(plain) > 300
    assert {c: got[c] for c, _ in plain} == {c: f"x{s}y" for c, s in plain}
    for c in range(1, 128):
        assert got[c] == (f"x{chr(c).lower()}y" if chr(c).isalnum() else "x y")
    assert all(re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", key) for key in got.values())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_fold_text_idempotent(spark, texts):
    once = apply(spark, texts, fn.fold_text)
    assert apply(spark, once, fn.fold_text) == once


def test_parse_literal_list(spark):
    good = [
        "['A', 'B']",
        """["Rock'n", 'C']""",
        r"""['it\'s "x"']""",
        r"['a\xa0b']",
        r"['a\\x41']",
        "['A', None]",
        "['a, None, b']",
        "[]",
        "[ 'a', ]",
    ]
    assert apply(spark, good, fn.parse_literal_list) == [ast.literal_eval(g) for g in good]
    assert apply(spark, [None, "oops", "['a'", "{'a': 1}"], fn.parse_literal_list) == [
        [],
        None,
        None,
        None,
    ]


def test_ids_and_numbers(spark):
    ids = ["12", "12.0", "\t12 \n", "\tabc\n", "nan", "inf", "12f", "1e3", None]
    assert apply(spark, ids, fn.canonical_id) == [
        "12",
        "12",
        "12",
        "abc",
        "nan",
        "inf",
        "12f",
        "1000",
        None,
    ]
    assert apply(spark, ["7", "7.9", "x", "nan", "12d", None], fn.to_long) == [
        7,
        7,
        None,
        None,
        None,
        None,
    ]


def test_lists(spark):
    assert apply(spark, ["a,b", None, ""], fn.split_list) == [["a", "b"], [], [""]]
    assert apply(spark, ["a,b", None], lambda c: fn.split_list(c, False)) == [["a", "b"], None]
    lists = [["Une Nuit", "X y Z"], ["A", None], [], None]
    assert apply(spark, lists, fn.compact_tokens, "array<string>") == ["unenuit xyz", "a", "", ""]
    assert apply(spark, lists, lambda c: fn.compact_tokens(c, "none"), "array<string>")[1] == (
        "a none"
    )
    joined = apply(spark, [["b", "b"], None], lambda c: fn.concat_lists(c, c), "array<string>")
    assert joined == [["b", "b", "b", "b"], []]


def test_duration_text_and_dates(spark):
    minutes = [89, 90, 120, 121, None]
    assert apply(spark, minutes, fn.duration_bucket, "int") == [
        "Moins de 90 min",
        "90-120 min",
        "90-120 min",
        "Plus de 120 min",
        None,
    ]
    assert apply(spark, ["x" * 400, "x" * 401], fn.truncate) == ["x" * 400, "x" * 400 + "..."]
    assert apply(spark, ["1999-03-04", None, ""], fn.year_text) == ["1999", "????", ""]
    assert apply(spark, ["/p.jpg", None], fn.image_url) == [
        "https://image.tmdb.org/t/p/w500/p.jpg",
        None,
    ]
    assert apply(spark, [0, 4], fn.stars_to_score, "int") == [1, 5]
    assert apply(spark, ['["a"]', "oops", None], fn.json_list) == [["a"], None, None]


def test_genres(spark):
    assert apply(spark, list(FILM_GENRES), fn.translate_genre) == list(FILM_GENRES.values())
    assert apply(
        spark, ["Documentary", "Western", "x"], lambda c: fn.translate_genre(c, "documentary")
    ) == ["Autres", None, None]
    assert len(DOCUMENTARY_GENRES) == 22
    assert apply(spark, ["Comédie musicale", "?"], fn.genre_from_label) == ["Musical", None]
