from marquee.operators import lemmas, text

TABLE = [
    ("walking", "walk"), ("talking", "talk"), ("jumping", "jump"), ("king", "king"),
    ("cities", "city"), ("ponies", "pony"), ("ladies", "lady"), ("cats", "cat"), ("dogs", "dog"),
    ("trees", "tree"), ("runs", "run"), ("mice", "mouse"), ("Was", "be"), (None, "x"), ("y", None),
]


def test_rules_and_unlisted_forms(spark, rows):
    table = spark.createDataFrame(TABLE, "form string, lemma string")
    rules = {r["suffix"]: r for r in lemmas.learn_rules(table).collect()}
    assert rules["ing"]["ending"] == "" and (rules["ing"]["n_forms"], rules["ing"]["share"]) == (3, 1.0)
    assert rules["ies"]["ending"] == "y" and rules["s"]["ending"] == ""
    assert "mice" not in rules and "e" not in rules
    words = ["barking", "stories", "birds", "mice", "was", "sing", "x", "s", "", None, "birds"]
    forms = spark.createDataFrame([(w,) for w in words], "form string")
    got = dict(lemmas.complete(forms, table).collect())
    assert got == {
        "barking": "bark", "stories": "story", "birds": "bird", "mice": "mouse", "was": "be",
        "sing": "sing", "x": "x", "s": "s", "": "",
    }


def test_as_a_table_for_overviews(spark):
    table = spark.createDataFrame(TABLE, "form string, lemma string")
    films = spark.createDataFrame([(1, "Barking dogs and cities")], "id int, overview string")
    forms = spark.createDataFrame([(w,) for w in ("barking", "dogs", "and", "cities")], "form string")
    done = text.normalize(films, "overview", lemmas=lemmas.complete(forms, table))
    assert done.first()["NLP"] == "bark dog city"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "form string, lemma string")
    assert lemmas.learn_rules(none).count() == 0
    forms = spark.createDataFrame([("cats",)], "form string")
    assert lemmas.complete(forms, none).collect() == [("cats", "cats")]
