import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from marquee.llm import packing
from marquee.llm.tokens import Encoder, default_tokenizer


def test_encoder_equals_the_tokenizer():
    rng = random.Random(5)
    texts = ["", "  ", "'s''s 'RE don't x<|endoftext|>y ÀÉÏ İstanbul ΣΑΣ a\x1cb ́x ½² ﬁ ÿŸẞß ×÷ '''ll", "日本語 𝔘𝔫 \u0085z"]
    alphabet = "abz'sREtmld \n\t09.,!<|>_-éÉßÿ×÷µΣİ́\x1c\xa0½日"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    tokenizer = Tokenizer.from_file(default_tokenizer())
    with open(default_tokenizer(), encoding="utf-8") as f:
        encoder = Encoder(f.read(), {})
    for part in (texts[:700], texts[700:]):
        ids, bounds = encoder.encode(pa.array(part, pa.large_string()))
        for text, a, b in zip(part, bounds, bounds[1:], strict=False):
            assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_place():
    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(200)] + [0]
    room = [100] * (sum(lengths) // 100) + packing.powers(sum(lengths) % 100)
    pieces = list(packing.place(lengths, room, 1.0, 0.01))
    for j, capacity in enumerate(room):
        at = 0
        for _, _, n, _, offset in sorted((p for p in pieces if p[3] == j), key=lambda p: p[4]):
            assert offset == at
            at += n
        assert at == capacity
    for k, length in enumerate(lengths):
        own = sorted((s, n) for d, s, n, _, _ in pieces if d == k)
        assert sum(n for _, n in own) == length
        assert all(s + n == t for (s, n), (t, _) in zip(own, own[1:], strict=False))
    assert packing.powers(0) == [] and packing.powers(13) == [8, 4, 1]


def test_costs_are_balanced():
    rng = random.Random(2)
    lengths = [rng.choice([5, 10, 400]) for _ in range(400)]
    room = [1000] * (sum(lengths) // 1000 + 1)
    cost = np.zeros(len(room))
    for _, _, n, j, _ in packing.place(lengths, room, 1.0, 0.01):
        cost[j] += n + 0.01 * n * n
    in_order = np.zeros(len(room))
    for k, n in enumerate(lengths):
        in_order[k * len(room) // len(lengths)] += n + 0.01 * n * n
    assert cost.std() < in_order.std()


def test_every_id_once(make, odd):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    rows = packing.pack(make(odd, clash=True), capacity=64, block_tokens=500).collect()
    total = sum(len(tokenizer.encode(o[1] or "", add_special_tokens=False).ids) + 1 for o in odd)
    assert sum(r["length"] for r in rows) == total
    by_sequence = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        pieces.sort()
        n = sum(length for _, length in pieces)
        assert n == 64 or n & (n - 1) == 0
        assert [o for o, _ in pieces] == [sum(x for _, x in pieces[:k]) for k in range(len(pieces))]
    for doc_id in (1, 2, 3, None, 5, 6):
        own = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == doc_id)
        ids = np.frombuffer(b"".join(i for _, i in own), "<u4").tolist()
        text = next(o[1] for o in odd if o[0] == doc_id)
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    assert packing.pack(make([])).count() == 0
