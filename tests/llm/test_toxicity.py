import random

import numpy as np
import pytest

from marquee.llm import toxicity

INSULTS = ["moron", "grubling", "vequté", "日罵"]


def texts(rng, n, first=0):
    """(doc_id, text) and (doc_id, toxic): one in five holds insults; a few labels only."""
    rows, labels = [], []
    for k in range(first, first + n):
        words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(5, 200))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS).capitalize() + rng.choice(["", ",", "!"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture
def frame(spark):
    return lambda labels: spark.createDataFrame(labels, "doc_id long, toxic int")


def test_word_hashes():
    a, owner = toxicity.word_hashes(["Abc abc, x", "", "é" * 100 + " " + "é" * 100, "idiotic idioms"])
    own = lambda k: a[owner == k]
    # Three-letter words have no stem; longer ones have their first 3 to 6 bytes.
    assert len(own(0)) == 3 and own(0)[0] == own(0)[1] != own(0)[2]
    assert len(own(1)) == 0 and len(set(own(2).tolist())) == 1  # long words have none
    assert len(own(3)) == 2 + 4 + 3 and len(set(own(3).tolist())) == 9 - 3 + 1
    assert not set(toxicity.word_hashes(["idi"])[0].tolist()) & set(own(3).tolist())


@pytest.mark.parametrize("all_labels", [True, False])
def test_held_out_accuracy(make, frame, all_labels):
    """Confirmed toxic texts and the rest without labels, or with the share of clean ones."""
    rows, labels = texts(random.Random(1), 1500)
    given = [(k, t) for k, t in labels if t or all_labels]
    model = toxicity.train(make(rows), frame(given), prior=None if all_labels else 0.2)
    rows, labels = texts(random.Random(2), 400, first=10_000)
    truth = dict(labels)
    found = toxicity.predict(make(rows), model).collect()
    right = [r["predicted"] == truth[r["doc_id"]] for r in found]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    clean = [r["predicted"] for r in found if not truth[r["doc_id"]]]
    assert np.mean(clean) < 0.01


def test_risk_steps_back_below_zero(monkeypatch):
    """A prior that is too high drives the estimated clean risk below zero; training that
    steps back keeps it near there."""
    texts_ = [np.array([0, 2 + k % 50]) for k in range(300)]
    texts_ += [np.array([0 if k % 6 == 0 else 1, 2 + k % 50]) for k in range(900)]
    toxic = np.array([True] * 300 + [False] * 900)

    def clean_risk(slack, prior):
        monkeypatch.setattr(toxicity, "SLACK", slack)
        weights, bias = toxicity.fit(texts_, toxic, 52, prior)
        score = 1 / (1 + np.exp(-np.array([weights[t].sum() + bias for t in texts_])))
        assert (score[:300] >= 0.5).mean() > 0.9
        return score[300:].mean() - prior * score[:300].mean()

    assert abs(clean_risk(0.1, 1 / 6)) < 0.03
    stepped, free = clean_risk(0.1, 0.3), clean_risk(10**9, 0.3)
    assert free < -0.1 < stepped


def test_odd_rows(make, frame, odd):
    rows, labels = texts(random.Random(1), 600)
    labels += [(None, 1), (3, None), (10**9, 1), (labels[0][0], 1), (labels[0][0], 0)]
    model = toxicity.train(make(rows + odd), frame(labels))
    again = toxicity.train(make(rows + odd).repartition(7), frame(labels))
    assert np.array_equal(model.words, again.words) and np.allclose(model.weights, again.weights)
    found = toxicity.predict(make(odd, clash=True), model).collect()
    assert len(found) == len(odd)
    assert all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in found)
    assert toxicity.predict(make([]), model).count() == 0
    for docs, marks in (([], []), (rows, []), (rows, [(1, 0)]), ([], labels)):
        none = toxicity.train(make(docs), frame(marks))
        assert toxicity.predict(make([(1, "moron"), (2, None)]), none).first()["score"] <= 0.5
