"""Lemmas of words that the lemma table lacks, by rules learned from the words it has.

A rule replaces a suffix: it is learned from all listed forms of that suffix, and of the
rules that fit a new form the longest suffix decides, since it has seen the forms most alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.sizing import settle

#: Longest suffix, and what a suffix's best ending needs: forms, and its share of them.
LONGEST, MIN_FORMS, MIN_SHARE = 5, 3, 0.5
#: Letters that a suffix leaves at least.
MIN_STEM = 2


def _cut(forms: DataFrame, longest: int) -> DataFrame:
    """A row for each suffix of each form that leaves ``MIN_STEM`` letters: ``stem``, ``suffix``."""
    n = F.length("form")
    sizes = F.sequence(F.lit(1), F.least(n - MIN_STEM, F.lit(longest)))
    cut = forms.filter(n > MIN_STEM).withColumn("_size", F.explode(sizes))
    return cut.withColumns(
        {
            "stem": F.left(F.col("form"), n - F.col("_size")),
            "suffix": F.right(F.col("form"), F.col("_size")),
        }
    ).drop("_size")


def _listed(lemmas: DataFrame) -> DataFrame:
    """One lemma for each form of a table, in lower case."""
    named = lemmas.select(F.lower("form").alias("form"), F.lower("lemma").alias("lemma"))
    return named.dropna().groupBy("form").agg(F.min("lemma").alias("lemma"))


def learn_rules(
    lemmas: DataFrame,
    longest: int = LONGEST,
    min_forms: int = MIN_FORMS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """(suffix, ending, n_forms, share) from a table of form and lemma: for each suffix that
    ``min_forms`` listed forms have, the ending that most of their lemmas have in its place,
    if ``min_share`` of them do. Ties go to the shorter ending, then by letter.

    Forms that are their own lemma teach that a suffix stays. Nulls are left out.
    """
    cut = _cut(_listed(lemmas), longest)
    ending = F.when(
        F.col("lemma").startswith(F.col("stem")),
        F.substring("lemma", F.length("stem") + 1, F.length("lemma")),
    )
    counted = cut.groupBy("suffix", ending.alias("ending")).agg(F.count(F.lit(1)).alias("n"))
    # Most first, then the shorter ending: the least of these is the best.
    order = F.struct(-F.col("n"), F.length("ending"), F.col("ending"))
    best = F.min(F.when(F.col("ending").isNotNull(), order))
    return (
        counted.groupBy("suffix")
        .agg(F.sum("n").alias("n_forms"), best.alias("best"))
        .select(
            "suffix",
            F.col("best.ending").alias("ending"),
            "n_forms",
            (-F.col("best.col1") / F.col("n_forms")).alias("share"),
        )
        .filter((F.col("n_forms") >= min_forms) & (F.col("share") >= min_share))
    )


def by_rules(forms: DataFrame, rules: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(form, lemma) of different forms; one that no rule fits is its own lemma."""
    named = forms.select("form").dropna().distinct()
    known = settle(rules.select("suffix", "ending"), "lemma-rules")
    met = _cut(named, longest).join(known, "suffix")
    lemma: Column = F.max_by(F.concat("stem", "ending"), F.length("suffix"))
    found = met.groupBy("form").agg(lemma.alias("_lemma"))
    return named.join(found, "form", "left").select(
        "form", F.coalesce(F.nullif("_lemma", F.lit("")), "form").alias("lemma")
    )


def complete(forms: DataFrame, lemmas: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(form, lemma) of all different ``forms``: the listed lemma, or that of the rules, which
    are learned from the list unless they are given. Ready for ``text.normalize``."""
    rules = learn_rules(lemmas) if rules is None else rules
    listed = _listed(lemmas).withColumnRenamed("lemma", "_listed")
    return by_rules(forms, rules).join(listed, "form", "left").select(
        "form", F.coalesce("_listed", "lemma").alias("lemma")
    )
