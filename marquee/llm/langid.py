"""Language identification by cross-parsing against one suffix automaton per language.

A text is cut into the fewest phrases that each occur in a language's training text: from
every position the automaton follows the text for as long as it can, and where it can't
go on, the next phrase begins. The language with the lowest entropy estimate, phrases
times the bits of a position in the training text for each byte, wins.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.batches import slices, without

#: Training text of all languages together, in bytes after normalisation, and the
#: labelled rows of each language it is taken from: the bounds of the fitted sample.
TRAIN_BYTES = 160_000
TRAIN_ROWS = 50
LANGUAGES = 200
#: Every text is parsed in pieces of so many bytes, all pieces of a slice side by side.
GRAIN = 512
UNKNOWN = "und"

#: Numerals that are no decimal digits, such as fractions and Roman numerals, count as word
#: characters but are no letters.
_NUMERALS = frozenset(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()
)
_OTHER = re.compile(r"[\W\d_]+")


def normal(text: str) -> bytes:
    """Lower-case letters, every stretch of other characters one space."""
    text = text.lower()
    if not text.isascii() and not _NUMERALS.isdisjoint(text):
        # Few texts have any: a pattern of all of them would slow down every text.
        text = text.translate(dict.fromkeys(map(ord, _NUMERALS.intersection(text)), " "))
    return _OTHER.sub(" ", text).strip().encode()


def suffix_automaton(text: np.ndarray, symbols: int) -> np.ndarray:
    """Transitions [state, symbol] of the automaton of all substrings; state 0 is the
    start, and 0 as a target means that there is none."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text.tolist():
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p != -1:
            q = following[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and following[p].get(c) == q:
                    following[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.zeros((len(following), symbols), np.int32)
    for state, targets in enumerate(following):
        for c, target in targets.items():
            table[state, c] = target
    return table


class Model:
    """Languages, and their automata as one table over the bytes seen in training."""

    def __init__(self, texts: dict[str, bytes]):
        self.languages = sorted(texts)
        seen = sorted(set(b"".join(texts.values())) | {32})
        self.code = np.zeros(256, np.int64)  # 0: a byte no language has
        self.code[seen] = np.arange(1, len(seen) + 1)
        self.symbols = len(seen) + 1
        tables, roots, at = [], [], 0
        for name in self.languages:
            own = suffix_automaton(self.code[np.frombuffer(texts[name], np.uint8)], self.symbols)
            own[own > 0] += at
            # One more state, without a way on, after a byte that is no phrase's beginning.
            tables.append(np.concatenate([own, np.zeros((1, self.symbols), np.int32)]))
            roots.append(at)
            at += len(own) + 1
        # Targets are row offsets, ready to add the next symbol to.
        self.table = np.concatenate(tables).ravel() * np.int32(self.symbols) if tables else None
        self.roots = np.array(roots, np.int32) * np.int32(self.symbols)
        self.dead = np.array([*roots[1:], at], np.int32) * np.int32(self.symbols) - self.symbols
        self.bits = np.array([np.log2(max(2, len(texts[n]))) for n in self.languages])

    def phrases(self, pieces: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases [language, piece] of pieces [position, piece] of symbols, sorted by
        falling size, none empty."""
        n = pieces.shape[1]
        count = np.zeros((len(self.roots), n), np.int32)
        lasting = np.searchsorted(-sizes, -np.arange(len(pieces)), side="left").tolist()
        for k, root in enumerate(self.roots):
            start = self.table[root : root + self.symbols]
            start = np.where(start > 0, start, self.dead[k]).astype(np.int32)
            state = start[pieces[0]]
            for at, m in enumerate(lasting[1:], 1):  # m pieces are longer than ``at``
                now = pieces[at, :m]
                following = self.table[state[:m] + now]
                stuck = following == 0
                count[k, :m] += stuck
                state[:m] = np.where(stuck, start[now], following)
        # A piece's last phrase ends with the piece.
        return count + 1


def train(
    labelled: DataFrame,
    *,
    train_bytes: int = TRAIN_BYTES,
    rows: int = TRAIN_ROWS,
    languages: int = LANGUAGES,
) -> Model:
    """Model of the languages in (doc_id, text, lang).

    Rows without text or lang are left out. The sample is bounded: of every language the
    ``rows`` rows with the lowest hash of doc_id, in that order up to its share of
    ``train_bytes``. More than ``languages`` different labels are refused.
    """
    some = labelled.filter("text is not null and lang is not null").select(
        "doc_id", "text", "lang"
    )
    counted = some.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(languages + 1)
    sizes = {r["lang"]: r["n"] for r in counted.collect()}
    if len(sizes) > languages:
        raise ValueError(f"more than {languages} languages")
    if not sizes:
        return Model({})
    share = train_bytes // len(sizes)
    # Hashes below this hold four times the rows needed, at any number of rows; ranking
    # then takes the lowest of them, and of each text no more than can count.
    below = F.create_map(
        *[F.lit(x) for name, n in sizes.items() for x in (name, 4.0 * rows / n)]
    )
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    ordered = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    picked = (
        some.withColumn("h", draw)
        .filter(F.col("h") < below[F.col("lang")])
        .withColumn("text", F.substring("text", 1, share))
        .withColumn("rank", F.row_number().over(ordered))
        .filter(F.col("rank") <= rows)
    )
    parts: dict[str, list[tuple]] = {}
    for r in picked.collect():
        parts.setdefault(r["lang"], []).append((r["rank"], normal(r["text"])))
    texts = {}
    for name, found in parts.items():
        joined = b" ".join(t for _, t in sorted(found))[:share]
        if joined.strip():
            texts[name] = joined
    return Model(texts)


def predict(docs: DataFrame, model: Model, *, keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred and score to ``docs`` (or to its columns in ``keep``).

    ``score`` is between 0 and 1: the runner-up's entropy estimate as a share of the
    winner's and its own, so 0.5 is a tie; with one language it is 1. A null text or one
    without letters is ``und`` with score 0, as is every text if no language was learned.
    Ties go to the first language in sorted order. Whole texts count, whatever their
    length. Rows alike are each predicted; own columns replace columns of their names; an
    empty table gives no rows.
    """
    kept = docs.columns if keep is None else keep
    fields = [f for f in without(docs.schema, ["lang_pred", "score"]) if f.name in kept]
    schema = T.StructType(
        [*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def entropies(texts: list[bytes], model: Model) -> np.ndarray:
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = model.code[np.frombuffer(b"".join(texts), np.uint8)].astype(np.int32)
        n_pieces = np.maximum(1, -(-sizes // GRAIN))
        owner = np.repeat(np.arange(len(texts)), n_pieces)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        begin = np.repeat(np.cumsum(sizes) - sizes, n_pieces) + place * GRAIN
        size = np.minimum(GRAIN, np.repeat(sizes, n_pieces) - place * GRAIN)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        flat = np.append(flat, np.zeros(GRAIN, np.int32))
        pieces = flat[begin + np.arange(GRAIN)[:, None]]
        counts = model.phrases(pieces, size)
        total = np.stack([np.bincount(owner, c, len(texts)) for c in counts])
        return total * model.bits[:, None] / np.maximum(1, sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = object.__new__(Model)
        vars(model).update(shared.value)
        for part in slices(batches, "text"):
            texts = [normal(t) if t else b"" for t in part.column("text").to_pylist()]
            some = [k for k, t in enumerate(texts) if t]
            name = [UNKNOWN] * len(texts)
            score = [0.0] * len(texts)
            if some and model.languages:
                each = entropies([texts[k] for k in some], model)
                best = np.argmin(each, axis=0)
                low = each.min(axis=0)
                if len(model.languages) > 1:
                    second = np.partition(each, 1, axis=0)[1]
                    sure = second / (low + second)
                else:
                    sure = np.ones(len(some))
                for k, b, s in zip(some, best.tolist(), sure.tolist(), strict=True):
                    name[k], score[k] = model.languages[b], s
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(f.name) for f in fields],
                    pa.array(name, pa.string()),
                    pa.array(score, pa.float64()),
                ],
                names=schema.names,
            )

    read = list(dict.fromkeys([*[f.name for f in fields], "text"]))
    return docs.select(*read).mapInArrow(run, schema)
