"""Benchmark decontamination with an FM-index over every shard of the training texts.

A shard is a slice of a task's documents. Words no phrase has, and stretches shorter than
the shortest phrase, can't take part in a match; they become separators, and the rest is
indexed: suffix order, Burrows-Wheeler transform, wavelet ranks, sampled positions. All
test phrases are searched backwards at once, their occurrences located, and the spans of
words they cover merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.batches import flat_words, slices, strings, translated, without
from marquee.session import landed

WINDOW = 10
#: Bytes of phrases that are broadcast at a time; more are searched in several passes.
PHRASE_BYTES = 32 << 20
SAMPLE_STEP = 8
SPAN = "array<struct<start:int,end:int>>"

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
#: A word in any case.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, every other ASCII character but letters and digits a space."""
    return translated(texts, _WORD_BYTES)


class Phrases:
    """Different windows of the items' words, as word numbers from 1 on."""

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW):
        texts = strings(pa.array([text or "" for _, text in items], pa.large_string()))
        words, counts = flat_words(fold(texts))
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
        owners: dict[tuple, set] = {}
        at = 0
        for (item, _), n in zip(items, counts.tolist(), strict=True):
            own = number[at : at + n].tolist()
            at += n
            for k in range(max(1, n - window + 1) if n else 0):
                owners.setdefault(tuple(own[k : k + window]), set()).add(item)
        self.sizes = np.array([len(w) for w in owners], np.int64)
        self.words = np.zeros((len(owners), window), np.int32)
        for k, w in enumerate(owners):
            self.words[k, : len(w)] = w
        self.items = [sorted((i for i in own if i is not None), key=str) for own in owners.values()]
        self.shortest = int(self.sizes.min()) if owners else 0

    def state(self) -> tuple:
        return self.vocabulary, self.sizes, self.words, self.items, self.shortest


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; 0 is a separator, each one unlike the others and ordered by
    position, and the last symbol is one. Ranks of the first h symbols give those of 2h;
    only suffixes that still tie are sorted again."""
    n = len(symbols)
    separator = symbols == 0
    key = symbols.astype(np.int64) + n
    key[separator] = np.arange(np.count_nonzero(separator))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    alone = new & np.append(new[1:], True)
    tied = order[~alone]
    h = 1
    while len(tied):
        key = rank[tied] * n + rank[tied + h]
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        group = rank[tied]
        place = np.arange(len(tied))
        head = np.concatenate([[True], group[1:] != group[:-1]])
        new = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.maximum.accumulate(np.where(head, place, 0))
        first = np.maximum.accumulate(np.where(new, place, 0))
        rank[tied] = group + first - start
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


class Wavelet:
    """Ranks and symbols of a sequence, one level of bits for each bit of a symbol."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros, self.level = bits, [], [], []
        for b in range(bits - 1, -1, -1):
            bit = (sequence >> b & 1).astype(bool)
            self.level.append(bit)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(len(sequence) - int(self.ones[-1][-1]))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the lowest level has the first ``at`` places' last ``symbol``."""
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.ones[k][at]
            at = np.where(symbol >> b & 1, self.zeros[k] + ones, at - ones)
        return at

    def symbol_and_down(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at these places, and ``down`` of them."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.bits):
            bit = self.level[k][at]
            ones = self.ones[k][at]
            at = np.where(bit, self.zeros[k] + ones, at - ones)
            symbol = symbol << 1 | bit
        return symbol, at


class FMIndex:
    """Count and locate phrases in ``symbols`` (0: separator, at the end as well)."""

    def __init__(self, symbols: np.ndarray, largest: int, step: int = SAMPLE_STEP):
        suffixes = suffix_array(symbols)
        self.n = len(symbols)
        self.last = Wavelet(symbols[suffixes - 1], max(1, int(largest).bit_length()))
        every = np.arange(largest + 1)
        counts = np.bincount(symbols, minlength=largest + 1)
        # From the lowest level's place of a symbol to the row of suffixes it begins.
        self.shift = np.cumsum(counts) - counts - self.last.down(every, np.zeros(len(every), int))
        # Every step-th position of a stretch is sampled, its first one always, so that
        # walking back never crosses a separator.
        place = np.arange(self.n)
        begins = np.maximum.accumulate(np.where(symbols == 0, place + 1, 0))
        sampled = ((place - begins) % step == 0) | (symbols == 0)
        self.marked = sampled[suffixes]
        self.sample_rank = np.cumsum(self.marked) - 1
        self.samples = suffixes[self.marked]

    def back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.shift[symbol] + self.last.down(symbol, row)

    def search(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of suffixes that begin with each phrase, from its last word
        backwards."""
        low = np.zeros(len(sizes), np.int64)
        high = np.full(len(sizes), self.n, np.int64)
        alive = np.arange(len(sizes))
        for k in range(int(sizes.max()) if len(sizes) else 0):
            alive = alive[low[alive] < high[alive]]
            now = alive[sizes[alive] > k]
            symbol = words[now, sizes[now] - 1 - k].astype(np.int64)
            low[now] = self.back(symbol, low[now])
            high[now] = self.back(symbol, high[now])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: back to a sampled one, counting the steps."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walk = np.flatnonzero(~self.marked[at])
        while len(walk):
            symbol, down = self.last.symbol_and_down(at[walk])
            at[walk] = self.shift[symbol] + down
            steps[walk] += 1
            walk = walk[~self.marked[at[walk]]]
        return self.samples[self.sample_rank[at]] + steps


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of all [low, high), and which range each is from."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n), which


def search_shard(texts: pa.Array, phrases: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; then for all occurrences the first word (counted over the
    whole shard) and the phrase."""
    vocabulary, sizes, windows, _, shortest = phrases
    words, counts = flat_words(fold(texts))
    none = np.zeros(0, np.int64)
    if not len(sizes) or not len(words):
        return counts, none, none
    found = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1)
    number = found.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    known = np.flatnonzero(number)
    if not len(known):
        return counts, none, none
    owner = np.repeat(np.arange(len(counts)), counts)[known]
    begins = np.concatenate([[True], (np.diff(known) > 1) | (np.diff(owner) > 0)])
    stretch = np.cumsum(begins) - 1
    long_enough = (np.bincount(stretch) >= shortest)[stretch]
    known, begins = known[long_enough], begins[long_enough]
    if not len(known):
        return counts, none, none
    stretch = np.cumsum(begins) - 1
    place = np.arange(len(known)) + stretch
    symbols = np.zeros(len(known) + int(stretch[-1]) + 1, np.int64)
    symbols[place] = number[known]
    word_at = np.zeros(len(symbols), np.int64)
    word_at[place] = known
    index = FMIndex(symbols, len(vocabulary))
    low, high = index.search(windows, sizes)
    rows, which = ranges(low, np.maximum(low, high))
    return counts, word_at[index.locate(rows)], which


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans; those that touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    phrase_bytes: int = PHRASE_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Where the words of ``docs`` repeat ``window`` consecutive words of an item.

    Words are runs of digits, A-Z in lower case and characters outside ASCII. An item of
    fewer words, but not none, is one phrase. Result: the columns of ``docs`` (or those
    in ``keep``), n_words, spans (hit words: merged [start, end) of word numbers), cuts
    (the same in characters), item_ids (as strings, sorted). Own columns replace columns
    of the same names.

    A null text has no words, a null item no phrases; an item without item_id marks words
    and isn't listed. Repeated items count once, repeated rows of ``docs`` are each
    marked. Empty tables give no rows or no hits. ``items`` may be of any size: phrases
    are broadcast ``phrase_bytes`` at a time, one pass over the texts each.
    """
    items = items.select("item_id", "text").filter("text is not null")
    n_bytes = items.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    passes = max(1, -(-int(n_bytes) // phrase_bytes))
    kept = docs.columns if keep is None else keep
    out = docs
    for k in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        rows = [(r["item_id"], r["text"]) for r in part.collect()]
        phrases = docs.sparkSession.sparkContext.broadcast(Phrases(rows, window).state())
        # Until the last pass the text is needed again.
        names = kept if k == passes - 1 else [*dict.fromkeys([*kept, "text"])]
        out = _scan(out, names, phrases, again=k > 0)
        if k < passes - 1:
            out = landed(out, "phrases")
    return out


def _scan(docs: DataFrame, names: list[str], phrases, again: bool) -> DataFrame:
    own = ["n_words", "spans", "cuts", "item_ids"]
    fields = [f for f in without(docs.schema, own) if f.name in names]
    schema = T.StructType(
        [
            *fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T._parse_datatype_string(SPAN)),
            T.StructField("cuts", T._parse_datatype_string(SPAN)),
            T.StructField("item_ids", T.ArrayType(T.StringType())),
        ]
    )
    earlier = ["spans", "item_ids"] if again else []
    read = list(dict.fromkeys([*[f.name for f in fields], "text", *earlier]))
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = phrases.value
        _, sizes, _, items, _ = known
        for part in slices(batches, "text"):
            texts = strings(part.column("text"))
            counts, first, which = search_shard(texts, known)
            last = np.cumsum(counts)
            owner = np.searchsorted(last, first, side="right")
            spans: list[list] = [[] for _ in counts]
            ids: list[set] = [set() for _ in counts]
            for d, w in np.unique(np.stack([owner, which]), axis=1).T.tolist():
                ids[d].update(map(str, items[w]))
            at = first - (last - counts)[owner]
            for d, a, b in zip(owner.tolist(), at.tolist(), (at + sizes[which]).tolist(), strict=True):
                spans[d].append((a, b))
            if again:
                for d, (old, listed) in enumerate(
                    zip(part.column("spans").to_pylist(), part.column("item_ids").to_pylist(), strict=True)
                ):
                    spans[d] += [(s["start"], s["end"]) for s in old]
                    ids[d].update(listed)
            cuts: list[list] = [[] for _ in counts]
            for d, own_spans in enumerate(spans):
                if own_spans:
                    spans[d] = merged(own_spans)
                    ends = [m.span() for m in _WORD.finditer(texts[d].as_py())]
                    cuts[d] = [(ends[a][0], ends[b - 1][1]) for a, b in spans[d]]
            shown = [[{"start": a, "end": b} for a, b in s] for s in spans]
            cut = [[{"start": a, "end": b} for a, b in s] for s in cuts]
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(f.name) for f in fields],
                    pa.array(counts, pa.int64()),
                    pa.array(shown, pair),
                    pa.array(cut, pair),
                    pa.array([sorted(s) for s in ids], pa.list_(pa.string())),
                ],
                names=schema.names,
            )

    return docs.select(*read).mapInArrow(run, schema)


def n_hit() -> F.Column:
    """Words inside the spans that ``find`` gave."""
    zero = F.lit(0).cast("long")
    return F.aggregate("spans", zero, lambda n, s: n + s["end"] - s["start"])


def cut_text() -> F.Column:
    """The text without its cuts; a space stays where words were taken out."""
    start = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    walked = F.aggregate(
        "cuts",
        start,
        lambda s, c: F.struct(
            F.concat(s["kept"], F.substr("text", s["at"] + 1, c["start"] - s["at"])).alias("kept"),
            c["end"].alias("at"),
        ),
    )
    rest = F.concat(walked["kept"], F.substr(F.col("text"), walked["at"] + 1))
    return F.when(F.size("cuts") == 0, F.col("text")).otherwise(rest)
