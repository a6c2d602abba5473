import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(values, fan=16):
    """All levels of a tree."""
    levels = [values]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[k : k + fan]) for k in range(0, len(last), fan)])
    return levels


def steps(levels, at, fan=16):
    out = []
    for level in levels[:-1]:
        run = level[at // fan * fan : at // fan * fan + fan]
        out.append((at % fan, run[: at % fan] + run[at % fan + 1 :]))
        at //= fan
    return out


def brute(rows, fan=16):
    """(key, value) -> subroot, root and path of rows (key, group, value)."""
    groups = {}
    for key, group, value in rows:
        groups.setdefault(group, []).append((key is not None, key or 0, value, key))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([v for _, _, v, _ in sorted(groups[g], key=lambda x: x[:3])], fan) for g in names}
    top = climb([trees[g][-1][0] for g in names], fan)
    found = []
    for place, g in enumerate(names):
        for at, (_, _, value, key) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = steps(trees[g], at, fan) + steps(top, place, fan)
            found.append((key, value, trees[g][-1][0], top[-1][0], path))
    return found


def shown(df):
    return [
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["place"], s["siblings"]) for s in r["path"]])
        for r in df.collect()
    ]


@pytest.mark.parametrize("fan,digits", [(16, 2), (16, 1), (2, 1), (3, 2)])
def test_against_plain_trees(spark, fan, digits):
    rng = random.Random(fan)
    sizes = {"a": 1, "b": 2, "é": 16, "c": 17, None: 5, "": 40, "hot": 700, "A": 33, "z": 256}
    rows = [(rng.randrange(10**6), g, sha(f"{g}{k}")) for g, n in sizes.items() for k in range(n)]
    rows += [(None, "a", sha("null")), (7, "a", sha("same")), (7, "a", sha("same"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(5)
    got = merkle.manifest(df, fan=fan, digits=digits)
    assert sorted(shown(got), key=repr) == sorted(brute(rows, fan), key=repr)


def test_proofs_fold_to_the_root_and_tampering_shows(spark):
    rows = [(k, f"s{k % 20}", sha(str(k)), sha(f"x{k}") if k % 3 == 0 else None) for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string, other string")
    found = merkle.manifest(df, carry=["other"]).select(
        "*", merkle.folded(F.coalesce("other", "leaf"), F.col("path")).alias("folded")
    )
    for r in found.collect():
        own = r["other"] or r["leaf"]
        for s in r["path"]:
            own = sha(*s["siblings"][: s["place"]], own, *s["siblings"][s["place"] :])
        assert r["folded"] == own
        assert (own == r["root"]) == (r["doc_id"] % 3 != 0)


def test_leaves(make):
    rows = make([(1, "é𝔘", "en", None), (None, None, None, "s")]).withColumn(
        "leaf", merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    )
    assert {r["leaf"] for r in rows.collect()} == {
        sha("1:1", "-", "2:en", "1:2", "6:é𝔘"),
        sha("-", "1:s", "-", "1:0", "-"),
    }


def test_odd_rows(make, odd):
    df = make(odd, clash=True).withColumn("leaf", merkle.leaf(F.col("doc_id"), F.col("text")))
    df = df.withColumn("rank", F.lit(1)).withColumn("group", F.lit(2)).withColumn("value", F.lit(3))
    rows = merkle.manifest(df).collect()
    assert len(rows) == len(odd) and len({r["root"] for r in rows}) == 1
    assert merkle.manifest(df.filter("false")).count() == 0
    one = make([(5, "only")]).withColumn("leaf", merkle.leaf(F.col("text")))
    r = merkle.manifest(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] and r["path"] == []
