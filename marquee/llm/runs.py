"""Periodic runs of words: the maximal stretches that repeat themselves.

Every run holds a Lyndon word of its period that, under an order of the words or under its
reverse, is the longest Lyndon word where it begins. Both Lyndon arrays are read off the
first phase of Baier's suffix sorting, which groups suffixes by exactly these words without
sorting them. Each root is then extended to both sides by longest common extensions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.batches import flat_words, slices, strings, without

#: A run has two periods and this many words at least.
MIN_LENGTH = 12

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place, by Baier's grouping.

    Suffixes are grouped by a common prefix, first by their first symbol, and groups are
    taken from the highest to the lowest. The group at hand has prefix u. The place before
    each member that no group has handled yet is followed by u, once or several times:
    these places leave their group, of prefix w, for new ones of prefix wu, wuu and so on
    right above it. A group's prefix, when its turn comes, is its members' Lyndon word.
    """
    n = len(symbols)
    rank = {c: g for g, c in enumerate(sorted(set(symbols)))}
    group = [rank[c] for c in symbols]
    members: list[list[int]] = [[] for _ in rank]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    handled = bytearray(n)
    before = [-1] * n
    length = [1] * n
    g = len(members) - 1
    while g >= 0:
        u = size[g]
        times: dict[int, int] = {}
        for s in members[g]:  # ascending, and so are the places before them
            if group[s] != g:
                continue
            p = s - 1
            if p >= 0 and handled[p]:
                q = p
                while p >= 0 and handled[p]:
                    p = before[p]
                while q != p:  # later searches skip what this one has passed
                    before[q], q = p, before[q]
            before[s] = p
            handled[s] = 1
            length[s] = u
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        leaving: dict[int, dict[int, list[int]]] = {}
        for p, k in times.items():
            leaving.setdefault(group[p], {}).setdefault(k, []).append(p)
        for old, by_times in leaving.items():
            lower, higher = old, above[old]
            for k in sorted(by_times):
                new = len(members)
                members.append(by_times[k])
                size.append(size[old] + k * u)
                below.append(lower)
                above.append(higher)
                above[lower] = new
                for p in by_times[k]:
                    group[p] = new
                lower = new
            below[higher] = lower
        members[g] = []
        g = below[g]
    return length


class Extensions:
    """Longest common extensions to both sides, from names of all stretches of 1, 2, 4, ...
    symbols up to ``longest``: equal names are equal stretches."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.names = [np.unique(symbols, return_inverse=True)[1].astype(np.int64)]
        width = 1
        while 2 * width <= longest and 2 * width <= len(symbols):
            last = self.names[-1]
            pair = last[:-width] * (last.max() + 1) + last[width:]
            self.names.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
            width *= 2

    def right(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Symbols that agree from ``a`` and ``b`` on, at most ``room``."""
        done = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            names, width = self.names[level], 1 << level
            may = np.flatnonzero(done + width <= room)
            same = names[a[may] + done[may]] == names[b[may] + done[may]]
            done[may[same]] += width
        return done

    def left(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Symbols that agree before ``a`` and ``b``, at most ``room``."""
        done = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            names, width = self.names[level], 1 << level
            may = np.flatnonzero(done + width <= room)
            at = done[may] + width
            same = names[a[may] - at] == names[b[may] - at]
            done[may[same]] += width
        return done


def stretches(words: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of ``words`` that windows of ``width`` words cover
    which occur again in the same text.

    A run of ``2 * width`` words or more, and of two periods, has ``width`` words at least
    beside its last period: its windows there occur one period later, and they and these
    cover it. So a run lies in one stretch, which it can't reach beyond.
    """
    if len(words) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(words) - width + 1
    rng = np.random.default_rng(13)
    key = owner[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        key += words[k : k + n].astype(np.uint64) * (rng.integers(1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        key ^= key >> np.uint64(31)
    inside = np.flatnonzero(owner[:n] == owner[width - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    edge = np.zeros(len(words) + 1, np.int64)
    edge[: n] += np.bincount(order[again], minlength=n)
    edge[width : width + n] -= np.bincount(order[again], minlength=n)
    covered = np.cumsum(edge[:-1]) > 0
    fresh = np.append(True, owner[1:] != owner[:-1])
    was = np.append(False, covered[:-1])
    begin = np.flatnonzero(covered & (~was | fresh))
    follows = np.append(~covered[1:] | fresh[1:], True)
    return begin, np.flatnonzero(covered & follows) + 1


def runs_of(words: np.ndarray, owner: np.ndarray, min_length: int) -> np.ndarray:
    """Runs (begin, length, period) in the numbered words of several texts, in order."""
    none = np.zeros((0, 3), np.int64)
    begin, end = stretches(words, owner, max(1, min_length // 2))
    wide = end - begin >= min_length
    begin, end = begin[wide], end[wide]
    if not len(begin):
        return none
    sizes = end - begin
    at = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(at[-1]) + np.repeat(begin - at[:-1], sizes)
    flat = words[place]
    roots = np.empty((2, len(flat)), np.int64)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        part = flat[a:b].tolist()
        roots[0, a:b] = lyndon_lengths(part)
        roots[1, a:b] = lyndon_lengths([-c for c in part])
    extend = Extensions(flat, int(sizes.max()))
    first, last = np.repeat(at[:-1], sizes), np.repeat(at[1:], sizes)
    found = [none]
    for period in roots:
        i = np.flatnonzero(np.arange(len(flat)) + period <= last)
        p = period[i]
        back = extend.left(i, i + p, i - first[i])
        forth = extend.right(i, i + p, last[i] - i - p)
        length = back + p + forth
        good = (length >= 2 * p) & (length >= min_length)
        found.append(np.stack([place[i[good]] - back[good], length[good], p[good]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def find(
    docs: DataFrame,
    *,
    min_length: int = MIN_LENGTH,
    column: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add n_words, runs and collapsed to ``docs`` (or to its columns in ``keep``).

    Words are what lies between ASCII white space. ``runs`` is an array of (start, length,
    period), in words from 0, by start and period: stretches of ``min_length`` words and
    two periods at least whose words recur after ``period`` words, the least such number,
    and that no word beside them continues. ``collapsed`` is the text without what any run
    holds after its first period: the words left, joined by one space.

    A null text has no words, no runs and an empty ``collapsed``. Rows alike are each
    searched; own columns replace columns of their names; an empty table gives no rows. A
    row's whole text is searched, in memory of its task, at some 200 bytes a word in runs.
    """
    kept = docs.columns if keep is None else keep
    own = ["n_words", "runs", "collapsed"]
    fields = [f for f in without(docs.schema, own) if f.name in kept]
    triple = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType(
        [
            *fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(triple)),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def search(part: pa.RecordBatch) -> list[pa.Array]:
        flat, counts = flat_words(strings(part.column(column)))
        n_rows, n = len(counts), len(flat)
        begin = np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(n_rows), counts)
        codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64) if n else owner
        runs = runs_of(codes, owner, min_length)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        stays = np.cumsum(edge[:-1]) == 0
        left = flat if stays.all() else flat.filter(pa.array(stays))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[stays], minlength=n_rows))])
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), left)
        text = pc.binary_join(lists, pa.scalar(" ", left.type)).cast(pa.string())
        whose = owner[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=n_rows))])
        shown = pa.StructArray.from_arrays(
            [pa.array(x) for x in (runs[:, 0] - begin[whose], runs[:, 1], runs[:, 2])],
            fields=list(RUN),
        )
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), shown)
        return [pa.array(counts.astype(np.int64)), listed, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            yield pa.RecordBatch.from_arrays(
                [*[part.column(f.name) for f in fields], *search(part)], names=schema.names
            )

    read = list(dict.fromkeys([*[f.name for f in fields], column]))
    return docs.select(*read).mapInArrow(run, schema)
