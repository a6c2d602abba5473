import random

from marquee.llm import linededup


def brute(rows):
    """Texts after removal, in the order of (doc_id, hash) as given by the row order."""
    seen, out = set(), []
    for doc_id, text in rows:
        lines = text.split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for j in range(len(full) - 2):
            w = tuple(lines[full[j + k]].strip(" \t\n\x0b\x0c\r").lower() for k in range(3))
            if w in seen:
                gone.update(full[j : j + 3])
            seen.add(w)
        out.append((doc_id, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


def got(df):
    return [(r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in df.collect()]


def test_against_brute_force(make):
    rng = random.Random(6)
    lines = ["a", "B ", "b", " c", "d", "", "e é", "\t"]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14)))) for k in range(50)]
    rows.append((90, "\n".join(f"only line {k}" for k in range(3000))))
    rows.append((91, "before\n" + rows[-1][1] + "\nafter"))
    assert sorted(got(linededup.dedup(make(rows)))) == sorted(brute(rows))


def test_overlapping_windows_are_one_stretch(make):
    passage = [f"p{k}" for k in range(5)]
    rows = [(1, "\n".join(["x", *passage, "y"])), (2, "\n".join(["z", *passage, "", "q"]))]
    assert sorted(got(linededup.dedup(make(rows))))[1] == (2, 8, 5, "z\n\nq")


def test_odd_rows(make, odd):
    found = linededup.dedup(make(odd, clash=True))
    rows = got(found)
    assert len(rows) == len(odd) and "slot" in found.columns
    assert (1, 0, 0, None) in rows and (2, 1, 0, "") in rows
    # Rows alike are one document: neither is later than the other.
    assert sum(r[0] == 4 and r[2] == 0 for r in rows) == 3
    assert linededup.dedup(make([])).count() == 0
