from marquee.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def rows(conv, *texts, start=0):
    return [(conv, start + k, "user" if k % 2 == 0 else "bot", t) for k, t in enumerate(texts)]


def kept(spark, data):
    found = chat.collapse(spark.createDataFrame(data, SCHEMA)).collect()
    return {(r["conv_id"], r["part"]): (r["n_turns"], r["text"]) for r in found}


def test_snapshots_collapse(spark):
    data = [
        *rows(1, "a", "b", "c"),
        *rows(2, "a", "b"),
        *rows(3, "a", "b", "c", "d", start=5),
        *rows(4, "a", "x"),
        *rows(5, "b", "a"),
        *rows(7, "a", "x"),
        *rows(8, "a"),
    ]
    found = kept(spark, data)
    assert set(found) == {(3, 0), (4, 0), (5, 0)}
    assert found[4, 0] == (2, "<|im_start|>user\na<|im_end|>\n<|im_start|>bot\nx<|im_end|>")


def test_hot_first_turn_and_long_conversation(spark):
    long = rows(1, *[f"t{k}" for k in range(600)])
    data = long + [(2, t, r, x) for _, t, r, x in long[:599]]
    data += [r for k in range(50) for r in rows(10 + k, "t0", f"other {k}")]
    found = kept(spark, data)
    assert [found[1, p][0] for p in range(3)] == [600] * 3 and (2, 0) not in found
    whole = "\n".join(found[1, p][1] for p in range(3))
    assert whole.count("<|im_start|>") == 600 and whole.index("t300<") < whole.index("t301<")
    assert sum(c >= 10 for c, _ in found) == 50


def test_odd_rows(spark):
    data = [
        (1, None, "user", "first"), (1, 1, None, None), (1, 1, None, None), (1, 2, "bot", ""),
        (2, 1, "user", "first"), (2, 2, None, ""),
        (3, 7, "user", "first"),
        (None, 1, "user", "nobody"),
    ]
    found = kept(spark, data)
    assert set(found) == {(1, 0), (2, 0)}  # a null text isn't an empty one
    assert found[1, 0][0] == 3 and "unknown\n<|im_end|>" in found[1, 0][1]
    assert kept(spark, []) == {}
    extra = spark.createDataFrame([(*rows(1, "a")[0], 5)], SCHEMA + ", place long")
    assert chat.collapse(extra).count() == 1
