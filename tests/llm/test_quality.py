import random
import re

from marquee.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(again),
    )


def test_statistics_against_brute_force(make, odd):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab #|é\n\t\x0b𝔘") for _ in range(rng.randint(0, 80))) for _ in range(60)]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (2, 3, 4, 60)]
    rows = [*enumerate(texts, 100), *[o[:2] for o in odd if o[0] != 6]]
    got = sorted(
        tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        for r in quality.judge(make(rows)).collect()
    )
    assert got == sorted(brute(t) for _, t in rows)


def test_frequent_lines_deplete(make):
    own = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    menu = " ".join(f"menu{i}" for i in range(70))
    rows = [(k, f"{menu.upper()} {k}\n{own(k)}", None, "a") for k in range(4)]
    rows += [(9, f"{menu} 7\n{own(9)}", None, "b"), (10, f"{menu} 1\n{own(10)}\n{own(11)}", None, "a")]
    found = {r["doc_id"]: r for r in quality.judge(make(rows), max_percent=50).collect()}
    assert not any(found[k]["kept"] or found[k]["base_failed"] for k in range(4))
    assert found[0]["n_removed"] == 71
    assert found[9]["kept"] and found[9]["n_removed"] == 0  # rare on its own host
    assert found[10]["kept"] and found[10]["n_removed"] == 71
    assert all(r["kept"] for r in quality.judge(make(rows), least_documents=5).collect())


def test_the_limit_follows_the_host(make):
    """A line in 6 of a host's documents goes while they are over a twentieth of them."""
    letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731 - digits are alike
    own = lambda k: " ".join(f"{letters(k)}x{letters(i)}" for i in range(60))
    for n, gone in ((119, 2), (120, 0)):
        rows = [(k, own(k) + ("\nsite notice" if k < 6 else ""), None, "a") for k in range(n)]
        found = quality.judge(make(rows)).collect()
        assert [r["n_removed"] for r in sorted(found, key=lambda r: r["doc_id"])[:7]] == [gone] * 6 + [0]
        assert all(r["kept"] for r in found)


def test_odd_rows(make, odd):
    rows = quality.judge(make(odd, clash=True)).collect()
    assert len(rows) == len(odd)
    assert all(r["n_words"] == 0 and r["base_failed"] for r in rows if r["doc_id"] in (1, 2, 3))
    assert quality.judge(make([])).count() == 0
