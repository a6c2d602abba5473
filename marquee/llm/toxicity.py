"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are known; the rest of the corpus is unlabelled and holds toxic
texts too, a share of it that is the class prior. The risk of calling a clean text toxic
can't be measured directly: it is the risk over all texts less the prior times that over
toxic ones. A flexible classifier drives this difference below zero, which no true risk
can be; where it does, training steps back instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.batches import slices, without
from marquee.session import landed

#: Texts that are learned from, about so many: confirmed toxic ones, and any at all. These
#: bound the fitted sample; texts are taken by a hash, whole, each different one once.
TOXIC_TEXTS, ANY_TEXTS = 4_000, 16_000
#: A word or stem is a feature if so many toxic texts have it, if its share among them is
#: this many times its share among all, and so many standard errors above it.
MIN_TEXTS, MIN_RATIO, MIN_ERRORS = 3, 2.0, 4.0
#: Classifiers; each leaves out its own part of the sample, and the mean of them scores.
MEMBERS = 5
#: Share of toxic texts where the labels don't tell because all of them are toxic.
PRIOR = 0.1
#: Steps over a member's sample, texts of each sort in a step, step size, and the pull of
#: weights towards zero, which leaves most words without any.
ROUNDS, BATCH, RATE, PULL = 30, 256, 0.3, 1e-3
THRESHOLD = 0.5
#: Training steps back where the clean risk is below zero by this share of the prior.
SLACK = 0.1

#: Bytes of words: ASCII letters and digits, and all of other scripts.
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
#: Lengths of stems, and of the words that are hashed side by side.
STEMS = (3, 4, 5, 6)
SHORT = 48


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-case words of all texts and of the words' first letters,
    ``STEMS`` bytes of them, and the number of each one's text. A word of over ``SHORT`` bytes
    has no stems."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = IN_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[np.append(0, np.cumsum(sizes))] = True
    start = np.flatnonzero(inside & (~np.append(False, inside[:-1]) | first[:-1]))
    end = np.flatnonzero(inside & (~np.append(inside[1:], False) | first[1:])) + 1
    owner = np.searchsorted(np.cumsum(sizes), start, side="right")
    length = end - start
    found = np.zeros(len(start), np.uint64)
    left = np.flatnonzero(length <= SHORT)
    stems, whose = [], []
    at = 0
    while len(left):
        found[left] = (found[left] + data[start[left] + at]) * np.uint64(0x9E3779B97F4A7C15)
        found[left] ^= found[left] >> np.uint64(29)
        at += 1
        left = left[length[left] > at]
        if at in STEMS:  # of words that go on
            stems.append(~found[left])
            whose.append(owner[left])
    for k in np.flatnonzero(length > SHORT).tolist():
        found[k] = xxhash.xxh64_intdigest(data[start[k] : end[k]].tobytes())
    return np.concatenate([found, *stems]), np.concatenate([owner, *whose])


def once(owner: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (owner, feature) once, by owner."""
    order = np.lexsort((feature, owner))
    owner, feature = owner[order], feature[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1]))[: len(owner)]
    return owner[new], feature[new]


@dataclass
class Model:
    """Hashes of the words that count, in order, and the weight of each in every member;
    ``bias`` has one number a member. Without members every text scores 0."""

    words: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Mean over the members of the probability that a text is toxic."""
        if not len(self.bias):
            return np.zeros(len(texts))
        found, owner = word_hashes(texts)
        total = np.tile(self.bias[:, None], (1, len(texts)))
        if len(self.words) and len(found):
            at = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
            known = self.words[at] == found
            owner, at = once(owner[known], at[known])
            for member, weights in enumerate(self.weights):
                total[member] += np.bincount(owner, weights[at], len(texts))
        return (1 / (1 + np.exp(-np.clip(total, -40, 40)))).mean(axis=0)


def fit(
    texts: list[np.ndarray],
    toxic: np.ndarray,
    n_words: int,
    prior: float,
    seed: int = 0,
    rounds: int = ROUNDS,
) -> tuple[np.ndarray, float]:
    """Weights and bias of one linear classifier of texts given as numbers of their words.

    Sigmoid losses, since bounded ones bear a prior that is a little off; adaptive steps, each followed by a pull of every weight towards zero.
    The bias has no pull.
    """
    rng = np.random.default_rng(seed)
    sizes = np.array([len(t) for t in texts])
    flat = np.concatenate(texts) if len(texts) else np.zeros(0, np.int64)
    begin = np.append(0, np.cumsum(sizes))
    kinds = [np.flatnonzero(toxic), np.flatnonzero(~toxic)]
    weights, bias = np.zeros(n_words), 0.0
    squares, bias_squares = np.full(n_words, 1e-8), 1e-8

    def rows(picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = sizes[picked]
        at = np.repeat(begin[picked] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return np.repeat(np.arange(len(picked)), n), flat[at]

    def margin(row: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        return np.clip(bias + np.bincount(row, weights[word], n), -40, 40)

    steps = max(1, -(-max(len(k) for k in kinds) // BATCH))
    for _ in range(rounds * steps):
        p = rng.choice(kinds[0], min(BATCH, len(kinds[0])), replace=False)
        u = rng.choice(kinds[1], min(BATCH, len(kinds[1])), replace=False)
        p_row, p_word = rows(p)
        u_row, u_word = rows(u)
        p_margin, u_margin = margin(p_row, p_word, len(p)), margin(u_row, u_word, len(u))
        p_share, u_share = 1 / (1 + np.exp(-p_margin)), 1 / (1 + np.exp(-u_margin))
        clean_risk = u_share.mean() - prior * p_share.mean()
        # Slopes of the risks: toxic texts called clean, all texts and toxic ones called toxic.
        p_slope, u_slope = p_share * (1 - p_share) / len(p), u_share * (1 - u_share) / len(u)
        if clean_risk >= -SLACK * prior:
            p_slope = -2 * prior * p_slope
        else:
            p_slope, u_slope = prior * p_slope, -u_slope
        slope = np.bincount(p_word, p_slope[p_row], n_words)
        slope += np.bincount(u_word, u_slope[u_row], n_words)
        bias_slope = p_slope.sum() + u_slope.sum()
        squares += slope * slope
        bias_squares += bias_slope * bias_slope
        rate = RATE / np.sqrt(squares)
        weights -= rate * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * PULL * prior, 0)
        bias -= RATE / np.sqrt(bias_squares) * bias_slope
    return weights, bias


def _features(rows: DataFrame) -> DataFrame:
    """(part, toxic, features): the different words of each different text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found, owner = word_hashes(texts)
            owner, found = once(owner, found)
            offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts))))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(found.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), part.column("h"), lists], names=["toxic", "h", "features"]
            )

    schema = "toxic boolean, h bigint, features array<bigint>"
    found = rows.select("toxic", "h", "text").mapInArrow(read, schema)
    return found.dropDuplicates(["toxic", "h"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    prior: float | None = None,
    toxic_texts: int = TOXIC_TEXTS,
    any_texts: int = ANY_TEXTS,
    members: int = MEMBERS,
) -> Model:
    """Model from ``labels`` (doc_id, toxic) and the texts of ``docs`` (doc_id, text).

    A doc_id is confirmed toxic if one of its labels is 1; labels of 0 serve only for the
    prior, which is the share of labelled ids that are toxic unless it is given (or, where
    none is labelled clean, ``PRIOR``). Unlabelled texts are drawn from all of ``docs``,
    so that they hold the classes in their natural shares. Rows without doc_id, text or
    label are left out; a repeated text counts once. With no confirmed toxic text, every
    score is 0.

    The sample is chosen by hashes of ids and texts. Its features are made and screened by
    Spark; one task fits each member on the rows' features that passed.
    """
    spark = docs.sparkSession
    marked = landed(
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg((F.max("toxic") == 1).alias("toxic")),
        "toxic-labels",
    )
    counts = marked.agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("toxic")).first()
    if not counts["toxic"]:
        return Model(np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0))
    if prior is None:
        prior = counts["toxic"] / counts["n"] if counts["toxic"] < counts["n"] else PRIOR
    prior = min(max(prior, 1e-3), 1 - 1e-3)

    known = docs.filter("doc_id is not null and text is not null").select(
        "doc_id", "text", F.xxhash64("text").alias("h")
    )
    # Whole texts are only read for what is drawn.
    def drawn(column: F.Column, wanted: int, of: int) -> F.Column:
        return F.pmod(F.xxhash64(F.lit(11), column), F.lit(1 << 40)) < F.lit(
            int((1 << 40) * min(1.0, wanted / max(1, of)))
        )

    ids = marked.filter("toxic").filter(drawn(F.col("doc_id"), toxic_texts, counts["toxic"]))
    toxic = known.join(ids.select("doc_id"), "doc_id", "left_semi")
    anything = known.filter(drawn(F.col("h"), any_texts, docs.count()))
    sample = landed(
        _features(
            toxic.withColumn("toxic", F.lit(True)).unionByName(
                anything.withColumn("toxic", F.lit(False))
            )
        ),
        "toxic-sample",
    )
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_any = n.get(True, 0), n.get(False, 0)
    p, u = F.col("toxic") / max(1, n_toxic), F.col("any") / max(1, n_any)
    mean = (F.col("toxic") + F.col("any")) / max(1, n_toxic + n_any)
    error = F.sqrt(mean * (1 - mean) * (1 / max(1, n_toxic) + 1 / max(1, n_any)))
    words = (
        sample.select("toxic", F.explode("features").alias("word"))
        .groupBy("word")
        .agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("any"))
        .filter(F.col("toxic") >= MIN_TEXTS)
        .filter((p >= MIN_RATIO * u) & (p - u >= MIN_ERRORS * error))
    )
    vocabulary = np.sort(words.select("word").toPandas()["word"].to_numpy(np.int64))
    shared = spark.sparkContext.broadcast(vocabulary)

    def learn(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        vocabulary = shared.value
        rows = rows.sort_values(["toxic", "h"], kind="stable")
        texts = []
        for words in rows["features"]:
            words = np.asarray(words, np.int64)
            at = np.searchsorted(vocabulary, words)
            at = np.minimum(at, max(0, len(vocabulary) - 1))
            texts.append(at[vocabulary[at] == words] if len(vocabulary) else at[:0])
        toxic = rows["toxic"].to_numpy(bool)
        if toxic.all() or not toxic.any():
            return pd.DataFrame({"member": [], "word": [], "weight": []})
        weights, bias = fit(texts, toxic, len(vocabulary), prior, seed=key[0])
        some = np.flatnonzero(weights)
        return pd.DataFrame(
            {
                "member": key[0],
                "word": pd.array([None, *vocabulary[some].tolist()], "Int64"),
                "weight": [bias, *weights[some].tolist()],
            }
        )

    others = F.filter(
        F.sequence(F.lit(0), F.lit(members - 1)),
        lambda m: (m != F.pmod(F.xxhash64(F.lit(5), "h"), F.lit(members))) | F.lit(members == 1),
    )
    fitted = (
        sample.withColumn("member", F.explode(others))
        .groupBy("member")
        .applyInPandas(learn, "member int, word bigint, weight double")
        .collect()
    )
    biases = {r["member"]: r["weight"] for r in fitted if r["word"] is None}
    kept = np.unique(np.array([r["word"] for r in fitted if r["word"] is not None], np.int64))
    weights = np.zeros((len(biases), len(kept)))
    place = {m: k for k, m in enumerate(sorted(biases))}
    for r in fitted:
        if r["word"] is not None:
            weights[place[r["member"]], np.searchsorted(kept, r["word"])] = r["weight"]
    unsigned = kept.view(np.uint64)
    order = np.argsort(unsigned)
    return Model(unsigned[order], weights[:, order], np.array([biases[m] for m in sorted(biases)]))


def predict(
    docs: DataFrame, model: Model, *, threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """Add score and predicted to ``docs`` (or to its columns in ``keep``).

    ``score`` is the probability that the whole text is toxic, ``predicted`` 1 from
    ``threshold`` on. A word counts once a text, so a text's length doesn't dilute it. A
    null or empty text scores what one without any known word does. Rows alike are each
    scored; own columns replace columns of their names; an empty table gives no rows.
    """
    kept = docs.columns if keep is None else keep
    fields = [f for f in without(docs.schema, ["score", "predicted"]) if f.name in kept]
    schema = T.StructType(
        [*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for part in slices(batches, "text"):
            score = model.scores([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(f.name) for f in fields],
                    pa.array(score, pa.float64()),
                    pa.array((score >= threshold).astype(np.int32)),
                ],
                names=schema.names,
            )

    read = list(dict.fromkeys([*[f.name for f in fields], "text"]))
    return docs.select(*read).mapInArrow(run, schema)
