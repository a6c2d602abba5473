"""Jaccard join of shingle sets by parity sketches.

The sketch of a set has some lanes of 2**32 bits; every shingle flips one bit of one lane,
so the bits, and all the more the lanes, in which two sketches differ are no more than the
symmetric difference. A lane is kept as the XOR of its set bits' 64-bit images. Two sets
of a size band that are similar enough differ in d lanes at most, d set by the smaller
one. If each set shows d + 1 lanes, d from its own size, and all choose by the same order,
then two such sets show an equal lane: they meet there. The order is fullest lane first,
since lanes with hardly any shingles say little.

Copies are one node from the start. Of each lane's sets the one that meets others most
leads; all others are verified against their best leader. Only sets that are in different
components after that meet each other, and of those only pairs are verified whose bit
sketches' Hamming distance doesn't rule a link out already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.batches import LOWER, flat_words, slices, strings, translated
from marquee.llm.graph import components
from marquee.session import landed

#: Bits of the filter that picks texts to read again; a bound on what is broadcast (1 MB).
FILTER_BITS = 1 << 23
#: A lane that HOT_ROWS of every SAMPLED-th node show is hot; the first HOT_KEYS of them
#: are spread over the tasks.
SAMPLED, HOT_ROWS, HOT_KEYS = 64, 32, 10_000

#: Sets of a lane that are compared at a time; a lane of more is compared block by block.
BLOCK = 1024
#: Bits of a sketch: about four a shingle, up to this.
SKETCH_BITS = 1 << 13

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the different shingles of every text: ``width`` words in a
    row, or all words of a text that has fewer."""
    words, counts = flat_words(translated(texts, LOWER))
    if not len(words):
        return [np.zeros(0, np.uint64)] * len(counts)
    coded = words.dictionary_encode()
    known = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    hashed = known[coded.indices.to_numpy(zero_copy_only=False)]
    n = len(hashed)
    whole = np.zeros(n, np.uint64)
    for k in range(width):
        whole[: n - k] = mix(whole[: n - k] * _A + hashed[k:] + np.uint64(k + 1))
    out, end = [], 0
    for c in counts.tolist():
        start, end = end, end + c
        if c >= width:
            out.append(np.unique(whole[start : end - width + 1]))
        elif c:
            alone = np.zeros(1, np.uint64)
            for k in range(c):
                alone = mix(alone * _A + hashed[start + k : start + k + 1] + np.uint64(k + 1))
            out.append(mix(alone + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(shingles: np.ndarray) -> int:
    """One number for a set."""
    return int(np.bitwise_xor.reduce(mix(shingles + _A)) + np.uint64(len(shingles)))


def bit_sketch(shingles: np.ndarray) -> bytes:
    """Parities of a power of two of bits; halves XORed together are a sketch of half the
    bits, so sketches of any two sets can be compared."""
    bits = min(SKETCH_BITS, max(64, 1 << (4 * len(shingles) - 1).bit_length()))
    at = (mix(shingles + _B) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches of one length, a row of 64-bit words each."""
    least = min(map(len, sketches)) // 8
    out = np.empty((len(sketches), least), np.uint64)
    for k, sketch in enumerate(sketches):
        words = np.frombuffer(sketch, np.uint64)
        while len(words) > least:
            half = len(words) // 2
            words = words[:half] ^ words[half:]
        out[k] = words
    return out


class Bands:
    """Size bands and their lanes, for links where den * |A and B| >= num * |A or B|."""

    def __init__(self, num: int, den: int, ratio: float = 2.0):
        self.num, self.den = num, den
        edges = [-(-num // (den - num))]  # smaller sets link with equal ones only
        while edges[-1] < 1 << 40:
            edges.append(int(edges[-1] * ratio) + 1)
        self.edges = np.array(edges)

    def differ(self, size):
        """What a set of this size may differ in from a larger one, or an equal one."""
        return size * (self.den - self.num) // self.num

    def of(self, size: int) -> list[int]:
        """Bands a set is in: from its own to that of the largest set it can link with."""
        if size < self.edges[0]:
            return []
        near = np.searchsorted(self.edges, [size, size * self.den // self.num], side="right")
        return list(range(near[0] - 1, near[1]))

    def lanes(self, band: int) -> int:
        """Lanes of a band: what its sets may differ in, 1, and a seventh to choose from."""
        least = self.differ(int(self.edges[band + 1]) - 1) + 1
        return least + -(-least // 7)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the lanes that a sorted set shows, in all its bands.

        Sets a and b of a band of m lanes have m - d equal ones at least, d what the smaller
        may differ in. Had they no shown lane in common, the first of them in the order to
        reach d + 1 lanes would have shown only lanes that differ.
        """
        bits = mix((shingles & np.uint64(0xFFFFFFFF)) + _C)
        high = shingles >> np.uint64(32)
        out = []
        for band in self.of(len(shingles)):
            lanes = self.lanes(band)
            # The upper bits choose the lane, so lanes follow the order of the set.
            lane = (high * np.uint64(lanes) >> np.uint64(32)).astype(np.int64)
            filled = np.bincount(lane, minlength=lanes)
            some = np.flatnonzero(filled)
            parity = np.zeros(lanes, np.uint64)
            parity[some] = np.bitwise_xor.reduceat(bits, (np.cumsum(filled) - filled)[some])
            place = mix(np.arange(lanes, dtype=np.uint64) + np.uint64((band + 1) << 40))
            key = mix(parity ^ place)
            shown = np.lexsort((key, -filled))[: self.differ(len(shingles)) + 1]
            out.append(key[shown])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketches(docs: DataFrame, bands: Bands, width: int) -> DataFrame:
    """(doc_id, node, n, keys) of every row: fingerprint and size of its shingle set, and
    the keys of its lanes, left out where the task has met the same set before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for part in slices(batches, "text"):
            nodes, sizes, keys = [], [], []
            for shingles in shingle_sets(strings(part.column("text")), width):
                sizes.append(len(shingles))
                node = fingerprint(shingles) if len(shingles) else None
                nodes.append(node)
                new = node is not None and node not in met
                keys.append(bands.keys(shingles).view(np.int64) if new else None)
                met.add(node)
            as_long = np.array([x or 0 for x in nodes], np.uint64).view(np.int64)
            missing = np.array([x is None for x in nodes])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(as_long, pa.int64(), mask=missing),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "node", "n", "keys"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, node long, n long, keys array<long>"
    )


def wanted_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, size, bits, shingles) of the ``nodes`` (node, doc_id), read from the texts
    again: their sketches and whole sets.

    A filter of fixed size over the ids spares most other texts; the join is exact.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = (
        nodes.select(F.shiftright(bit, 6).alias("word"), (bit % 64).cast("int").alias("at"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
        .collect()
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        table[r["word"]] = r["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = shared.value.view(np.uint64)
        for batch in batches:
            at = batch.column("bit").to_numpy(zero_copy_only=False).astype(np.int64)
            is_in = flags[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
            picked = batch.filter(pa.array(is_in.astype(bool)))
            for part in slices([picked], "text"):
                sets = [s for s in shingle_sets(strings(part.column("text")), width) if len(s)]
                found = np.array([fingerprint(s) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found, pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([bit_sketch(s) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["node", "size", "bits", "shingles"],
                )

    read = docs.select("text", bit.alias("bit")).mapInArrow(
        run, "node long, size long, bits binary, shingles array<long>"
    )
    return read.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The ``pairs`` (a, b) of nodes whose sets are similar enough."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    return (
        pairs.select("a", "b")
        .join(first, "a")
        .join(second, "b")
        .filter(F.lit(den) * both >= F.lit(num) * either)
        .select("a", "b")
    )


def crossing(lanes: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (a, b) of nodes of ``lanes`` (key, node, comp) that show an equal lane, are in
    different components, and may be similar enough by their sizes and sketches.

    A lane's nodes are dealt to blocks of about ``BLOCK``, and each two blocks meet in a
    group of their own: groups are bounded whatever the lane, and only pairs that pass
    leave a task, each from the first lane that the two have in common.
    """
    sizes = lanes.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("m"))
    own = lanes.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("own"))
    sketched = sets.select("node", "size", "bits").join(own, "node")
    dealt = (
        lanes.join(sizes, "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .select(
            "key",
            "node",
            "comp",
            "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
    )
    grouped = (
        dealt.join(sketched, "node")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "node")
    )
    num, den = bands.num, bands.den

    def pairs(rows: pa.Table) -> Iterator[tuple[int, int]]:
        key = rows.column("key")[0].as_py()
        across = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
        comp, block, size, node = (
            rows.column(c).to_numpy() for c in ("comp", "block", "size", "node")
        )
        words = folded(rows.column("bits").to_pylist())
        lists = rows.column("own")
        for i in range(len(node) - 1):
            low = np.minimum(size[i], size[i + 1 :])
            high = np.maximum(size[i], size[i + 1 :])
            may = (comp[i + 1 :] != comp[i]) & (den * low >= num * high)
            if across:
                may &= block[i + 1 :] != block[i]
            js = np.flatnonzero(may)
            if not len(js):
                continue
            apart = np.bitwise_count(words[i] ^ words[i + 1 + js]).sum(axis=1)
            for j in (i + 1 + js[apart <= bands.differ(low[js])]).tolist():
                mine, theirs = lists[i].values.to_numpy(), lists[j].values.to_numpy()
                if np.intersect1d(mine, theirs, assume_unique=True)[0] == key:
                    yield int(node[i]), int(node[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def out() -> pa.RecordBatch:
            found = list(pairs(pa.Table.from_batches(held).combine_chunks()))
            columns = [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.stack(
                [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "low", "high")]
            )
            cuts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                now = tuple(group[:, a].tolist())
                if held and now != last:
                    yield out()
                    held.clear()
                last = now
                held.append(batch.slice(a, b - a))
        if held:
            yield out()

    return grouped.mapInArrow(run, "a long, b long").distinct()


def shared_lanes(lanes: DataFrame) -> DataFrame:
    """(key, node) of the lanes (key, node) that several nodes show, each once.

    Lanes are sorted by key and read as a stream. The hottest ones, told by a sample of
    nodes, never meet in one task: all their rows stay where they are, and of them alone,
    ``HOT_KEYS`` rows at most, the keys are broadcast. Which lanes those are doesn't
    change the result.
    """
    hot = landed(
        lanes.filter(F.pmod("node", F.lit(SAMPLED)) == 0)
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= HOT_ROWS)
        .orderBy(F.desc("n"), "key")
        .limit(HOT_KEYS)
        .select("key"),
        "hot",
    )
    by_key = Window.partitionBy("key").orderBy("node")
    cold = (
        lanes.join(F.broadcast(hot), "key", "left_anti")
        .withColumn("first", F.first("node").over(by_key))
        .withColumn("next", F.lead("node").over(by_key))
        .filter("first != node or first != next")
        .select("key", "node")
    )
    busy = lanes.join(F.broadcast(hot), "key").select("key", "node")
    return landed(cold.union(busy).distinct(), "shared")


def link(
    docs: DataFrame, *, width: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """Documents of (doc_id, text) linked where the Jaccard similarity of their sets of
    ``width``-word shingles is ``num / den`` or more.

    Words are runs without ASCII white space, A-Z in lower case. Result, one row for each
    row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that links lead
    to, its own included). Without words, as with a null text, n_shingles is 0 and nothing
    links. Rows alike link with each other; a null doc_id stays null and is never a
    component_id unless the component has no other. Other columns are left out; an empty
    table gives no rows.
    """
    bands = Bands(num, den)
    found = landed(sketches(docs, bands, width), "sketches")
    rows = found.select("doc_id", "node", "n")
    nodes = landed(
        rows.filter("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")),
        "nodes",
    )
    lanes = found.filter("keys is not null").select(F.explode("keys").alias("key"), "node")
    shared = shared_lanes(lanes)
    wanted = shared.select("node").distinct().join(nodes, "node")
    sets = landed(wanted_sets(docs, wanted, width), "sets")

    # Every node goes to the leader it has the most lanes in common with; a lane is led by
    # the node that meets the most others in its lanes.
    met = shared.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    known = shared.join(met, "key").groupBy("node").agg(F.sum("n").alias("known"))
    ranked = shared.select("key", "node").join(known, "node")
    leaders = ranked.groupBy("key").agg(
        F.max(F.struct("known", "node")).alias("best")
    )
    followers = (
        shared.select("key", "node")
        .join(leaders, "key")
        .select(F.col("best.node").alias("a"), F.col("best.known").alias("known"), F.col("node").alias("b"))
        .filter("a != b")
    )
    best = (
        followers.groupBy("a", "b", "known")
        .agg(F.count(F.lit(1)).alias("lanes"))
        .groupBy("b")
        .agg(F.max(F.struct("lanes", "known", "a")).alias("best"))
    )
    tried = best.select(F.col("best.a").alias("a"), "b")
    stars = landed(verified(tried, sets, num, den), "stars")
    inside = components(stars)

    # What is left: equal lanes of nodes in different components.
    placed = shared.join(inside, "node", "left").select(
        "key", "node", F.coalesce("comp", "node").alias("comp")
    )
    mixed = (
        placed.groupBy("key")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("low != high")
        .select("key")
    )
    left = landed(placed.join(mixed, "key").distinct(), "left")
    bridges = landed(verified(crossing(left, sets, bands), sets, num, den), "bridges")

    if not bridges.isEmpty():
        inside = components(stars.union(bridges))
    named = (
        nodes.join(inside, "node", "left")
        .select("node", "doc_id", F.coalesce("comp", "node").alias("comp"))
    )
    lowest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    ids = named.join(lowest, "comp").select("node", "component_id")
    return rows.join(ids, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, *, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near duplicates.

    The document of the lowest doc_id of a component stays, with all its columns. Texts
    without words stay. Rows that share a doc_id count as one document: they stay or go
    together. A row without doc_id stays, since nothing names it.
    """
    kept = docs.columns
    groups = link(docs, width=width, num=num, den=den)
    # Rows to drop are ids, not texts; most documents have no partner.
    extra = groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
    return docs.join(extra.distinct(), "doc_id", "left_anti").select(*kept)
