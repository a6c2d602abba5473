import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns or inside.
CLASHES = (
    "n_words spans cuts item_ids lang_pred score n_lines n_removed kept row h at key w node n "
    "comp owner repository value slot shard ids start length block place _row _ats host"
).split()


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(rows, clash=False):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] else 0) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            from pyspark.sql import functions as F

            for k, name in enumerate(CLASHES):
                df = df.withColumn(name, F.lit(f"x{k}"))
        return df

    return build


@pytest.fixture
def odd():
    """Null, empty and blank texts, null and repeated ids, repeated rows, a long text."""
    return [
        (1, None, None, None),
        (2, "", "en", "s"),
        (3, " \t\n ", None, "s"),
        (None, "word without an id " * 30, "en", None),
        (4, "the same row twice\nwith a second line\nand a third one", "en", "s"),
        (4, "the same row twice\nwith a second line\nand a third one", "en", "s"),
        (4, "another text of this id", "de", "t"),
        (5, "é 日本 𝔘 ﬁ İ Σ", "fr", "t"),
        (6, "long " * 40_000 + "x" * 50_000, "en", "t"),
    ]
