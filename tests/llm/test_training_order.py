import os

import numpy as np
import pytest
from tokenizers import Tokenizer

from marquee.llm import training_order as to
from marquee.llm.tokens import default_tokenizer


@pytest.mark.parametrize("size", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation(size):
    index = np.arange(size)
    slot = to.permuted(index, size, key=7)
    assert sorted(slot) == list(range(size))
    assert (to.permuted(slot, size, 7, back=True) == index).all()
    if size > 100:
        assert (slot != to.permuted(index, size, key=8)).mean() > 0.9


def test_shards_round_trip(make, odd, tmp_path):
    docs = make(odd, clash=True)
    ordered = to.order(docs, length=64, per_shard=50)
    rows = sorted(ordered.collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    written = to.write_shards(ordered, str(tmp_path)).collect()
    assert sum(w["n_records"] for w in written) == len(rows)
    data = b"".join((tmp_path / f).read_bytes() for f in sorted(os.listdir(tmp_path)) if f.endswith(".bin"))
    assert len(data) == 128 * len(rows)
    # Resume at any record of any shard.
    third = (tmp_path / "shard-00000000.bin").read_bytes()
    assert (to.read_records(third, rows[3]["offset"], 64)[0] == np.frombuffer(rows[3]["ids"], to.ID)).all()
    tokenizer = Tokenizer.from_file(default_tokenizer())
    want = sorted(tokenizer.encode(t[1] or "", add_special_tokens=False).ids + [2] for t in odd)
    texts, parts = [], sorted((r for r in rows), key=lambda r: (str(r["doc_id"]), r["start"]))
    by_doc = {}
    for r in parts:
        by_doc.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], to.ID)[: r["n"]].tolist())
    for doc_id, pieces in by_doc.items():
        if doc_id not in (4,):
            texts.append([i for p in pieces for i in p])
    once = [w for w, t in zip([tokenizer.encode(t[1] or "", add_special_tokens=False).ids + [2] for t in odd], odd, strict=True) if t[0] != 4]
    assert sorted(texts) == sorted(once)
    assert sum(r["n"] for r in rows) == sum(map(len, want))


def test_key_changes_the_order(make):
    docs = make([(k, "some words " * 40) for k in range(60)])
    a = [r["doc_id"] for r in sorted(to.order(docs, length=16, key=1).collect(), key=lambda r: r["slot"])]
    b = [r["doc_id"] for r in sorted(to.order(docs, length=16, key=2).collect(), key=lambda r: r["slot"])]
    assert sorted(a) == sorted(b) and a != b


def test_empty_table(make):
    assert to.order(make([])).count() == 0
