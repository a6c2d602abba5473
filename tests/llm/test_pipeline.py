"""The whole pipeline against a plain version of every stage."""

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from marquee.llm import langid
from marquee.llm.queries import language_model
from marquee.llm.tokens import default_tokenizer
from tests.llm import test_decontaminate, test_jaccard, test_langid, test_linededup


def documents(rng):
    speak = lambda lang, n: test_langid.speak(rng, test_langid.LETTERS[lang], n)
    rows = []
    for k in range(40):
        lang = ("aa", "bb")[k % 2]
        text = "\n".join(speak(lang, rng.randint(3, 20)) for _ in range(rng.randint(1, 8)))
        rows.append((k, text, lang, f"s{k % 3}"))
    passage = "\n".join(speak("aa", 15) for _ in range(4))
    rows += [(100 + k, f"{speak('aa', 10)}\n{passage}\n{speak('aa', 10)}", "aa", "s1") for k in range(3)]
    line = speak("bb", 60)
    rows += [(200 + k, f"{line} {speak('bb', 1)}", "bb", "s1") for k in range(5)]
    rows += [(300, None, "aa", "s1"), (301, "", None, None), (302, "12 34 -", "aa", "s1"), (303, "c", "bb", "s2")]
    leak = speak("aa", 12)
    rows += [(400, f"{speak('aa', 20)} {leak.encode().upper().decode()}, {speak('aa', 20)}", "aa", "s2"), (401, leak, "aa", "s2")]
    return rows, [(1, leak), (2, speak("bb", 11)), (3, None)]


def without_hits(text, items):
    """Text less the spans of hit words, a span at a time."""
    words = list(test_decontaminate.WORD.finditer(text.translate({c: c + 32 for c in range(65, 91)})))
    plain = [m.group() for m in words]
    hit = set()
    for _, phrase in items:
        w = test_decontaminate.words(phrase)
        for k in range(max(1, len(w) - 9) if w else 0):
            part = w[k : k + 10]
            for i in range(len(plain) - len(part) + 1):
                if plain[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
    for k in sorted(hit, reverse=True):
        end = words[k + 1].start() if k + 1 in hit else words[k].end()
        text = text[: words[k].start()] + text[end:]
    return text


def test_against_a_plain_version(spark, make, tmp_path):
    rows, items = documents(random.Random(11))
    docs = make(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        stages.append(docs)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(s.columns == columns for s in stages[:-1])
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in stages[:-1]]

    # Language: what has no letters goes; a text that two languages explain alike stays.
    model = language_model(make(rows))
    found = {r["doc_id"]: r for r in langid.predict(make(rows), model).collect()}
    sure = {d: t for d, t, *_ in rows if found[d]["lang_pred"] != "und"}
    for doc_id, text, lang, _ in rows:
        if len(langid.normal(text or "")) > 5:
            assert doc_id in sure and found[doc_id]["lang_pred"] == lang
        elif not langid.normal(text or ""):
            assert doc_id not in sure
    assert texts[0] == sure and 303 in sure and found[303]["score"] == 0.5
    assert not {300, 301, 302} & set(sure)

    # Line deduplication.
    want = {d: t for d, _, _, t in test_linededup.brute(sorted(sure.items())) if t.split()}
    assert texts[1] == want and want != sure

    # Near duplicates.
    groups = test_jaccard.brute(sorted(want.items()), 5, 80, 100)
    want = {d: want[d] for d, _, c in groups if d == c}
    assert texts[2] == want and len(want) < len(groups)

    # Benchmark spans.
    cut = {d: without_hits(t, items) for d, t in want.items()}
    assert texts[3] == {d: t for d, t in cut.items() if t.split()}
    assert 401 not in texts[3] and texts[3][400] != want[400]
    for r in stages[3].collect():
        assert r["n_chars"] == len(r["text"])

    # Packing.
    tokenizer = Tokenizer.from_file(default_tokenizer())
    ids = {d: tokenizer.encode(t, add_special_tokens=False).ids + [2] for d, t in texts[3].items()}
    done = dict.fromkeys(ids, 0)
    for r in sorted(stages[4].collect(), key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == done[r["doc_id"]] and r["doc_tokens"] == len(own)
        part = np.array(own[r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        done[r["doc_id"]] += r["length"]
    assert done == {d: len(own) for d, own in ids.items()}


def test_run_and_empty_tables(spark, make, tmp_path):
    make([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
