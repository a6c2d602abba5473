"""Personal data: patterns, and terms that give a protected value away.

Base spans come from patterns. What a term discloses of a value in its document is
estimated from how many documents of the corpus have the two together: pointwise mutual
information as a share of the value's own information, by a lower bound so that few
documents say little. Terms above one threshold are generalised, above a higher one removed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.batches import flat_words, slices, strings, without
from marquee.llm.decontaminate import fold
from marquee.session import landed

KINDS = ("email", "ip", "card", "phone")
METHOD = ("remove", "generalise")
#: Standard errors that the lower bound is below what was counted.
ERRORS = 1.0
GENERALISE, REMOVE = 0.5, 0.8
#: Bits of the filter of candidate terms; a bound on what is broadcast (4 MB).
FILTER_BITS = 1 << 25
#: Different terms a task counts before it passes its counts on.
COUNTED = 200_000

SPAN = "array<struct<kind:string,start:int,end:int>>"
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

# Loops are possessive where nothing that follows could begin with what they eat, so that
# no text takes more than linear time.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Every ``@`` with the longest local part before it, back to the match before."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, normal value) by kind and start."""
    out = []
    if "@" in text:
        out += [("email", a, b, text[a:b].translate(_LOWER)) for a, b in emails(text)]
    if _DIGIT.search(text):
        if _DOTTED.search(text):
            for m in _IP.finditer(text):
                parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
                if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                    out.append(("ip", *m.span(), ".".join(parts)))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _NO_DIGIT.sub("", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span(), digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                digits = _NO_DIGIT.sub("", m.group())
                if 9 <= len(digits) <= 15:
                    out.append(("phone", *m.span(), digits))
    return out


def hashes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=False).view(np.int64)


def outside(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of every term of a text that isn't inside one of ``spans``."""
    terms = [m.span() for m in _TERM.finditer(text)]
    starts = [a for a, _ in terms]
    ends = [b for _, b in terms]
    inside = set()
    for a, b in spans:
        inside.update(range(bisect_left(ends, a + 1), bisect_left(starts, b)))
    return [(text[x:y].translate(_LOWER), x, y) for k, (x, y) in enumerate(terms) if k not in inside]


def mentions(docs: DataFrame, keep: list[str]) -> DataFrame:
    """row (a unique number), the columns in ``keep``, base spans, entities, the different
    terms outside the spans, and the text; terms and text only where there are spans."""
    own = ["row", "spans", "entities", "terms", "held"]
    fields = [f for f in without(docs.schema, own) if f.name in keep]
    added = [("row", "bigint"), ("spans", SPAN), ("entities", "array<bigint>"), ("terms", "array<bigint>"), ("held", "string")]
    schema = T.StructType(
        [*fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in added]]
    )
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text"):
            shown, held, entities, terms = [], [], [], []
            for text in part.column("text").to_pylist():
                found = base_spans(text) if text else []
                shown.append([{"kind": k, "start": a, "end": b} for k, a, b, _ in found])
                held.append(text if found else None)
                values = list({f"{kind}:{value}" for kind, _, _, value in found})
                words = list({t for t, _, _ in outside(text, [(a, b) for _, a, b, _ in found])}) if found else []
                entities.append(hashes(values) if values else [])
                terms.append(hashes(words) if words else [])
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(f.name) for f in fields],
                    pa.array(np.arange(row, row + part.num_rows), pa.int64()),
                    pa.array(shown, SPANS),
                    pa.array(entities, pa.list_(pa.int64())),
                    pa.array(terms, pa.list_(pa.int64())),
                    pa.array(held, pa.string()),
                ],
                names=names,
            )
            row += part.num_rows

    read = list(dict.fromkeys([*[f.name for f in fields], "text"]))
    return docs.select(*read).mapInArrow(run, schema)


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df): how many documents have each of ``terms`` (term), over whole texts.

    A filter of fixed size spares most other terms; the join is exact. Tasks add up their
    own counts first.
    """
    place = F.pmod("term", F.lit(FILTER_BITS))
    words = (
        terms.select(F.shiftright(place, 6).alias("word"), (place % 64).cast("int").alias("at"))
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
        counted = pd.Series(dtype=np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(counted.index.to_numpy(np.int64)), pa.array(counted.to_numpy(np.int64))],
                names=["term", "n"],
            )

        for part in slices(batches, "text"):
            found, counts = flat_words(fold(strings(part.column("text"))))
            if not len(found):
                continue
            coded = found.dictionary_encode()
            term = pd.util.hash_array(
                coded.dictionary.to_numpy(zero_copy_only=False), categorize=False
            ).view(np.int64)
            at = np.mod(term, FILTER_BITS)
            wanted = (flags[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            code = coded.indices.to_numpy(zero_copy_only=False)
            is_in = wanted[code]
            owner = np.repeat(np.arange(len(counts)), counts)[is_in]
            both = np.unique(owner * len(term) + code[is_in])
            df = np.bincount(both % len(term), minlength=len(term))
            some = np.flatnonzero(df)
            own = pd.Series(df[some], term[some]).groupby(level=0).sum()
            counted = counted.add(own, fill_value=0)
            if len(counted) > COUNTED:
                yield out()
                counted = pd.Series(dtype=np.int64)
        if len(counted):
            yield out()

    counts = docs.select("text").mapInArrow(run, "term bigint, n bigint")
    return counts.groupBy("term").agg(F.sum("n").alias("df")).join(terms, "term", "left_semi")


def least_share(m: Column, df: Column) -> Column:
    """Wilson's lower bound of the share of a term's ``df`` documents that have the value,
    from the ``m`` that were seen to."""
    z = ERRORS * ERRORS
    return (m + z / 2 - ERRORS * F.sqrt(m * (df - m) / df + z / 4)) / (df + z)


def disclosing(docs: DataFrame, found: DataFrame, generalise: float, remove: float) -> DataFrame:
    """(row, judged): the terms of each document that give one of its values away, as an
    array of (term, action).

    With N documents, the value in c of them, the term in t and both together in m, the
    term discloses log(N p / c) of the value's log(N / c), where p is the lower bound of
    m / t; the share decides. Every pair counts, one seen in a single document too.

    Values that the same documents have are alike in c and m with any term and count as
    one, so a list of many values costs no more than one. As p is m / t and so c / t at
    most, terms in more documents than that allows are left out before pairs are made.
    """
    n = found.count()
    values = found.select("row", F.explode("entities").alias("entity"))
    known = (
        values.groupBy("entity")
        .agg(
            F.count(F.lit(1)).alias("c"),
            F.bit_xor(F.xxhash64("row")).alias("a"),
            F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b"),
        )
        .filter(F.col("c") < n)
        .select("entity", "c", F.xxhash64("c", "a", "b").alias("alike"))
    )
    most = F.col("c") * F.pow(F.lit(n) / F.col("c"), F.lit(1 - min(generalise, remove))) * (1 + 1e-9)
    held = landed(
        values.join(known, "entity").select("row", "alike", "c", most.alias("most")).distinct(), "values"
    )
    top = held.agg(F.max("most").alias("top")).first()["top"] or 0.0
    terms = found.select("row", F.explode("terms").alias("term"))
    seen = document_counts(docs, terms.select("term").distinct()).filter(F.col("df") <= top)
    pairs = landed(
        terms.join(seen, "term").join(held, "row").filter("df <= most").select("row", "alike", "term", "c", "df"),
        "pairs",
    )
    share = 1 + F.log2(least_share(F.col("m"), F.col("df"))) / F.log2(F.lit(n) / F.col("c"))
    action = F.when(share >= remove, "remove").when(share >= generalise, "generalise")
    actions = (
        pairs.groupBy("alike", "term")
        .agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("c"), F.min("df").alias("df"))
        .select("alike", "term", action.alias("action"))
        .filter("action is not null")
    )
    return (
        pairs.join(actions, ["alike", "term"])
        .groupBy("row", "term")
        .agg(F.max("action").alias("action"))  # "remove" sorts after "generalise"
        .groupBy("row")
        .agg(F.collect_list(F.struct("term", "action")).alias("judged"))
    )


def marked(docs: DataFrame) -> DataFrame:
    """(row, more): every occurrence in ``held`` of the ``judged`` terms, outside ``spans``,
    by kind and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "held"):
            more = []
            for text, spans, judged in zip(
                *[part.column(c).to_pylist() for c in ("held", "spans", "judged")], strict=True
            ):
                actions = {j["term"]: j["action"] for j in judged}
                placed = outside(text, [(s["start"], s["end"]) for s in spans])
                kinds = [actions.get(t) for t in hashes([p[0] for p in placed]).tolist()]
                more.append(
                    [
                        {"kind": kind, "start": a, "end": b}
                        for kind in METHOD
                        for k, (_, a, b) in zip(kinds, placed, strict=True)
                        if k == kind
                    ]
                )
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(more, SPANS)], names=["row", "more"])

    return docs.select("row", "held", "spans", "judged").mapInArrow(run, f"row bigint, more {SPAN}")


def find(
    docs: DataFrame,
    *,
    keep: list[str] | None = None,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """Personal data in ``docs`` (doc_id, text): the columns in ``keep`` (default doc_id)
    and spans, an array of (kind, start, end) in code points by kind and start.

    Kinds ``email``, ``ip``, ``card`` and ``phone`` are base matches. ``remove`` and
    ``generalise`` are terms that disclose a value of the same document by themselves,
    wherever they stand in it; a term judged both ways is removed. They are only marked in
    documents that have the value, so a document without base matches has no spans.

    A null text has no spans. Rows alike count as documents of their own. Columns in
    ``keep`` named like the result's or ``row`` are replaced. An empty table gives no rows.
    Values and terms are compared by 64-bit hashes.
    """
    kept = ["doc_id"] if keep is None else keep
    found = landed(mentions(docs, kept), "mentions")
    judged = disclosing(docs, found, generalise, remove)
    more = marked(found.filter("held is not null").join(judged, "row"))
    names = [c for c in found.columns if c not in ("row", "spans", "entities", "terms", "held")]
    return found.drop("entities", "terms", "held").join(more, "row", "left").select(
        *[F.col(f"`{c}`") for c in names],
        F.concat("spans", F.coalesce("more", F.array().cast(SPAN))).alias("spans"),
    )


def spelled(spans: Column) -> Column:
    """kind:start:end of all ``spans``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def sanitised() -> Column:
    """``text`` with its ``spans`` acted on: base matches and terms to generalise become
    their class in brackets, terms to remove go. Of overlapping spans the first counts."""
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )

    def step(state: Column, s: Column) -> Column:
        said = F.substr(F.col("text"), s["start"] + 1, s["end"] - s["start"])
        general = F.when(said.rlike(r"^[0-9]+$"), "[NUMBER]").when(
            said.rlike(r"^\p{Lu}"), "[NAME]"
        ).otherwise("[WORD]")
        new = F.when(s["kind"] == "remove", "").when(s["kind"] == "generalise", general).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        )
        before = F.substr(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        moved = F.struct(F.concat(state["done"], before, new).alias("done"), s["end"].alias("at"))
        return F.when(s["start"] >= state["at"], moved).otherwise(state)

    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    walked = F.aggregate(ordered, start, step)
    return F.concat(walked["done"], F.substr(F.col("text"), walked["at"] + 1))
