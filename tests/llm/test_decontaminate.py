import random
import re

import numpy as np
import pytest

from marquee.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items, window=10):
    own, hit, ids = words(text), set(), set()
    for item, phrase in items:
        w = words(phrase)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            part = w[k : k + window]
            for i in range(len(own) - len(part) + 1):
                if own[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    if item is not None:
                        ids.add(str(item))
    return len(own), len(hit), sorted(ids)


def result(df):
    return [
        (r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["item_ids"])
        for r in df.collect()
    ]


@pytest.mark.parametrize("seed", range(3))
def test_index_counts_and_locates(seed):
    rng = np.random.default_rng(seed)
    symbols = np.append(rng.integers(0, 4, 300), 0)
    symbols[20:60] = symbols[100:140] = symbols[200:240]
    index = dc.FMIndex(symbols, 3, step=5)
    phrases = np.array([[a, b, c] for a in range(1, 4) for b in range(1, 4) for c in range(1, 4)])
    low, high = index.search(phrases, np.full(len(phrases), 3))
    for p, a, b in zip(phrases, low, high, strict=True):
        want = [i for i in range(len(symbols) - 2) if (symbols[i : i + 3] == p).all()]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_against_brute_force(spark, make):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(6)] + ["É", "ok", "7"]
    phrase = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, phrase(n)) for k, n in enumerate([12, 15, 10, 4, 1, 0, 25])]
    items += [(7, "A zzz only-here"), (0, items[1][1]), (None, "nine Words of its own without any id at"), (9, None)]
    texts = [phrase(rng.randint(0, 30)) for _ in range(40)]
    texts += [f"{phrase(5)}, {t}! {phrase(5).upper()}" for _, t in items if t]
    docs = make(list(enumerate(texts)))
    table = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((d, *brute(t, items)) for d, t in enumerate(texts))
    assert sorted(result(dc.find(docs, table, keep=["doc_id"]))) == want
    # A benchmark of any size: the same in several passes.
    assert sorted(result(dc.find(docs, table, keep=["doc_id"], phrase_bytes=80))) == want


def test_cuts(spark, make):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    text = "Før: One, two three four five six seven eight nine ten ELEVEN. One two end"
    row = dc.find(make([(1, text)]), items).withColumn("t", dc.cut_text()).first()
    assert row["t"] == "Før: . One two end" and row["spans"] == [(1, 12)]


def test_odd_rows_and_clashing_names(spark, make, odd):
    items = spark.createDataFrame([(1, "the same row twice")], "item_id long, text string")
    found = dc.find(make(odd, clash=True), items)
    rows = found.collect()
    assert len(rows) == len(odd) and found.columns.count("spans") == 1
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in rows if r["spans"]) == [(4, 12), (4, 12)]
    assert dc.find(make([]), items).count() == 0
    assert all(not r["spans"] for r in dc.find(make(odd), items.limit(0)).collect())
