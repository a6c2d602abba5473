import hashlib
import random
import re
import zlib

import numpy as np

from marquee.llm import queries, runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lyndon(s):
    """Length of the longest prefix of every suffix that is below all its own suffixes."""
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def brute(words, least=12):
    """Runs (start, length, period) by trying every period."""
    n, found = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(least, 2 * p):
                part = words[i : j + p]
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    found.append((i, length, p))
            i = j + 1
    return sorted(found)


def collapsed(words, found):
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def texts(rng, n):
    out = []
    for _ in range(n):
        letters = "abcdefghij"[: rng.choice([1, 2, 3, 10])]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 70))]
        if rng.random() < 0.6 and len(words) > 3:
            a = rng.randrange(len(words))
            p = 1 + rng.randint(0, (len(words) - a) // 3)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        out.append(rng.choice([" ", "\n", "\t ", "\r\n"]).join(words))
    return out


def test_lyndon_words_under_both_orders():
    rng = random.Random(2)
    for _ in range(500):
        s = [rng.randint(0, rng.choice([0, 1, 3])) for _ in range(rng.randint(0, 30))]
        assert runs.lyndon_lengths(s) == lyndon(s)
        assert runs.lyndon_lengths([-c for c in s]) == lyndon([-c for c in s])


def test_runs_against_brute_force():
    rng = random.Random(3)
    for least in (2, 3, 5, 12):
        parts = [t.split() for t in texts(rng, 150)]
        flat = [w for p in parts for w in p]
        codes = np.array([sorted(set(flat)).index(w) for w in flat], np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        want, at = [], 0
        for p in parts:
            want += [(at + s, n, q) for s, n, q in brute(p, least)]
            at += len(p)
        assert [tuple(r) for r in runs.runs_of(codes, owner, least).tolist()] == want


def test_documents_against_brute_force(make):
    rows = list(enumerate(texts(random.Random(5), 200)))
    got = runs.find(make(rows)).collect()
    assert sum(len(r["runs"]) for r in got) > 50
    for r in got:
        words = words_of(r["text"])
        found = brute(words)
        assert r["n_words"] == len(words)
        assert [tuple(x) for x in r["runs"]] == found
        assert r["collapsed"] == collapsed(words, found)


def test_query(spark, make, odd, tmp_path):
    """The whole query against its contract, planted stretches included."""
    rng = random.Random(8)
    rows = [*enumerate(texts(rng, 150), 1000), *odd[:-1]]
    rows += [(k, " ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(1, 90)))) for k in range(400)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in queries.op13_runs(spark, str(tmp_path)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(len(v) for v in got.values()) == len(rows)
    n_planted = 0
    for doc_id, text, *_ in rows:
        words, n = words_of(text), len(words_of(text))
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            n_planted += 1
        found = brute(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want = (
            doc_id, len(found), best[0], best[1], best[2],
            1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(collapsed(words, found)),
        )
        assert want in [tuple(r) for r in got[doc_id]]
    assert n_planted > 20


def test_odd_rows(make, odd):
    rows = runs.find(make(odd, clash=True)).collect()
    assert len(rows) == len(odd)
    for r in rows:
        if r["doc_id"] in (1, 2, 3):
            assert (r["n_words"], r["runs"], r["collapsed"]) == (0, [], "")
    long = next(r for r in rows if r["doc_id"] == 6)
    assert [tuple(x) for x in long["runs"]] == [(0, 40_000, 1)]
    assert long["collapsed"] == "long " + "x" * 50_000
    assert runs.find(make([])).count() == 0
