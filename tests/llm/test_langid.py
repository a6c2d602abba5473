import random

import numpy as np

from marquee.llm import langid


def speak(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


LETTERS = {"aa": "abcdeéf", "bb": "abcxyzü", "日": "日本語文字"}


def corpus(n=20, seed=1):
    rng = random.Random(seed)
    return [(k * 3 + j, speak(rng, LETTERS[lang], 60), lang, "s") for k in range(n) for j, lang in enumerate(LETTERS)]


def phrases(text, training):
    """Longest-match parsing by search."""
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n <= len(text) and text[at : at + n] in training:
            n += 1
        at += max(1, n - 1)
        count += 1
    return count


def test_phrases_against_search():
    rng = random.Random(4)
    texts = {"a": speak(rng, "abc", 200).encode(), "b": speak(rng, "abcd", 150).encode()}
    model = langid.Model(texts)
    parsed = sorted((speak(rng, "abcde", n).encode() for n in (1, 5, 30, 60)), key=len, reverse=True)
    parsed = [p[:200] for p in parsed]
    sizes = np.array([len(p) for p in parsed])
    pieces = np.zeros((200, len(parsed)), np.int32)
    for k, p in enumerate(parsed):
        pieces[: len(p), k] = model.code[np.frombuffer(p, np.uint8)]
    got = model.phrases(pieces, sizes)
    for row, name in enumerate(model.languages):
        for k, p in enumerate(parsed):
            assert got[row, k] == phrases(p, texts[name])


def test_held_out_accuracy(make):
    model = langid.train(make(corpus()))
    test = make(corpus(10, seed=9))
    rows = langid.predict(test, model).collect()
    assert all(r["lang"] == r["lang_pred"] and 0.5 <= r["score"] <= 1 for r in rows)


def test_odd_rows(make, odd):
    model = langid.train(make(corpus()))
    rows = langid.predict(make(odd, clash=True), model).collect()
    assert len(rows) == len(odd)
    for r in rows:
        if r["doc_id"] in (1, 2, 3):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in LETTERS
    for text in ("12 - 34", "½ ² ①", "Ⅷ", "٣", "½ ² ① Ⅷ ٣ _"):
        r = langid.predict(make([(1, text)]), model).first()
        assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert all(not c.isalpha() for c in langid._NUMERALS) and langid.normal("aⅧbª") == "a bª".encode()
    assert langid.predict(make([]), model).count() == 0
    nothing = langid.train(make([(1, None, "en", "s"), (2, "text", None, "s")]))
    assert langid.predict(make([(1, "text")]), nothing).first()["lang_pred"] == "und"
    alone = langid.train(make([(1, "some text", "en", "s")]))
    assert langid.predict(make([(1, "text")]), alone).first()["score"] == 1.0
