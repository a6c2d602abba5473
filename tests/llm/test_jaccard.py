import random
import re

import numpy as np
import pytest

from marquee.llm import jaccard
from marquee.llm.graph import components


def shingles(text, width):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, num, den):
    sets = [shingles(t, width) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[x][0] for x in range(len(rows)) if group[x] == group[k] and rows[x][0] is not None]
        out.append((doc_id, len(sets[k]), min(ids, default=None) if sets[k] else doc_id))
    return sorted(out, key=repr)


def corpus(rng, n=40):
    texts = []
    for _ in range(n):
        texts.append([f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([1, 2, 5, 9, 30, 100, 300, 700]))])
    for _ in range(3 * n):
        new = list(rng.choice(texts))
        for _ in range(rng.choice([0, 1, 1, 2, 5, 10])):
            at = rng.randrange(len(new) + 1)
            if rng.random() < 0.5:
                new[at:at] = [f"n{rng.randint(0, 99)}" for _ in range(rng.choice([1, 3]))]
            elif len(new) > 1:
                del new[at : at + 1]
        texts.append(new)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize(("width", "num", "den"), [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_against_brute_force(make, width, num, den):
    rng = random.Random(width)
    rows = list(enumerate(corpus(rng)))
    rng.shuffle(rows)
    rows += [(500, None), (501, ""), (502, "A b"), (503, "a  B"), (504, "a")]
    got = [tuple(r) for r in jaccard.link(make(rows), width=width, num=num, den=den).collect()]
    want = brute(rows, width, num, den)
    assert sorted(got, key=repr) == want
    assert len({c for _, _, c in want}) < len(rows) - 30  # there is something to find


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100)])
def test_linked_sets_show_an_equal_lane(num, den):
    rng = np.random.default_rng(1)
    bands = jaccard.Bands(num, den)
    for _ in range(1500):
        n = int(rng.integers(4, 600))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        common = a[rng.random(len(a)) < rng.uniform(0.8, 1)]
        b = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)]))
        both = len(common)
        if not both or den * both < num * (len(a) + len(b) - both) or both == len(a) == len(b):
            continue
        assert set(bands.keys(a).tolist()) & set(bands.keys(b).tolist())


def test_hot_lanes_give_the_same(make, monkeypatch):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(120):
        new = list(base)
        new[rng.randrange(60)] = f"x{k % 7}"
        rows.append((k, " ".join(new)))
    monkeypatch.setattr(jaccard, "SAMPLED", 1)
    monkeypatch.setattr(jaccard, "HOT_ROWS", 5)
    got = [tuple(r) for r in jaccard.link(make(rows), width=1, num=90, den=100).collect()]
    assert sorted(got, key=repr) == brute(rows, 1, 90, 100)


def test_odd_rows(make, odd):
    rows = [o[:2] for o in odd] + [(None, "word without an id " * 30)]
    got = [tuple(r) for r in jaccard.link(make(rows, clash=True)).collect()]
    assert len(got) == len(rows)
    assert (1, 0, 1) in got and (2, 0, 2) in got and got.count((4, 8, 4)) == 2
    assert sum(r[0] is None and r[2] is None for r in got) == 2
    assert jaccard.link(make([])).count() == 0


def test_representatives(make):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(3, text), (1, text + " end"), (7, text.upper()), (5, "alone"), (6, None), (8, "alone")]
    kept = jaccard.representatives(make(rows, clash=True))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5, 6]


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 100)] + [(5000, 5000)]
    names = list(range(6000))
    rng.shuffle(names)
    df = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    found = {r["node"]: r["comp"] for r in components(df).collect()}
    assert len({found[names[k]] for k in range(201)}) == 1
    assert len({found[names[1000 + k]] for k in range(100)}) == 1
    assert len(set(found.values())) == 2 and len(found) == 301
    assert components(df.limit(0)).count() == 0


def test_sizes_far_apart_below_one_half(make):
    """At 40/100 a set of 6 links with one of 14, two bands further on."""
    rows = []
    for k in range(20):
        own = [f"p{k}w{i}" for i in range(14)]
        rows += [(2 * k, " ".join(own[:6])), (2 * k + 1, " ".join(own))]
    got = {tuple(r) for r in jaccard.link(make(rows), width=1, num=40, den=100).collect()}
    assert got == {(2 * k + j, (6, 14)[j], 2 * k) for k in range(20) for j in range(2)}
