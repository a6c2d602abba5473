"""Casts, list handling, identifiers and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Image host, labels of the duration choice, words for "no filter".
IMAGE_BASE = "https://image.tmdb.org/t/p/w500"
SHORT, MEDIUM, LONG = "Moins de 90 min", "90-120 min", "Plus de 120 min"
NO_FILTER = ("Tous", "Toutes")

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

_QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
_ELEMENT = rf"(?:{_QUOTED}|None|[+-]?\d[\d.eE+-]*)"
_LIST = rf"^\s*\[\s*(?:{_ELEMENT}\s*(?:,\s*{_ELEMENT}\s*)*+,?\s*)?\]\s*$"


def empty_list() -> Column:
    return F.array().cast("array<string>")


def to_long(col: Column) -> Column:
    """Whole number from text or any numeric; anything else, such as ``12d``, is null."""
    number = F.when(col.cast("string").rlike(_NUMBER), col)
    return number.try_cast("double").try_cast("bigint")


def split_list(col: Column, null_as_empty: bool = True) -> Column:
    """Comma list to array. A null stays null or becomes the empty list."""
    parts = F.split(col, ",")
    return F.coalesce(parts, empty_list()) if null_as_empty else parts


def parse_literal_list(col: Column) -> Column:
    """Array from a list written as a Python literal; null gives an empty list.

    The text is cut into its elements, each element is put into JSON form (bare
    ``None`` to ``null``, ``\\xNN`` to ``\\u00NN``), and one JSON parse removes the
    quotes and escapes. Text that is not a list literal gives null.
    """
    elements = F.regexp_extract_all(col, F.lit(f"({_ELEMENT})"), F.lit(1))
    as_json = F.transform(
        elements,
        lambda e: F.when(e == "None", F.lit("null")).otherwise(
            F.regexp_replace(e, r"(?<!\\)((?:\\\\)*)\\x([0-9A-Fa-f]{2})", r"$1\\u00$2")
        ),
    )
    text = F.concat(F.lit("["), F.array_join(as_json, ","), F.lit("]"))
    parsed = F.from_json(
        text, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"}
    )
    return F.when(col.isNull(), empty_list()).when(col.rlike(_LIST), parsed)


def concat_lists(*cols: Column) -> Column:
    """Lists one after another, order and repeats kept, null as empty."""
    return F.concat(*[F.coalesce(c, empty_list()) for c in cols])


def compact_tokens(col: Column, null_token: str | None = None) -> Column:
    """Every element in lower case without its spaces, joined by spaces: ``['Une Nuit',
    'X']`` to ``'unenuit x'``; null list gives ``''``.

    Null elements are left out, or written as ``null_token`` where one is given.
    """
    glued = F.transform(col, lambda x: F.replace(F.lower(x), F.lit(" "), F.lit("")))
    joined = F.array_join(glued, " ") if null_token is None else F.array_join(glued, " ", null_token)
    return F.coalesce(joined, F.lit(""))


def canonical_id(col: Column) -> Column:
    """``12``, ``12.0`` and ``' 12 '`` become ``'12'``; other text loses its outer white
    space."""
    text = col.cast("string")
    return F.coalesce(to_long(text).cast("string"), F.regexp_replace(text, r"^\s+|\s+$", ""))


def is_wanted(value: object) -> bool:
    """False for the values that mean "no filter"."""
    return bool(value) and value not in NO_FILTER


def duration_bucket(minutes: Column) -> Column:
    """Label of the duration choice a film of this length falls into."""
    return (
        F.when(minutes < 90, F.lit(SHORT))
        .when(minutes <= 120, F.lit(MEDIUM))
        .when(minutes > 120, F.lit(LONG))
    )


def image_url(path: Column, base: str = IMAGE_BASE) -> Column:
    return F.concat(F.lit(base), path)


def json_list(col: Column) -> Column:
    """Array from a JSON list of strings; null where the text is no such list."""
    return F.from_json(col, "array<string>")


def stars_to_score(raw: Column) -> Column:
    """Star index 0-4 to score 1-5."""
    return (raw + 1).cast("int")


def full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat_ws(" ", first, last))


def year_text(date: Column) -> Column:
    """First four characters of a date text, ``????`` when there is none."""
    return F.substring(F.coalesce(date, F.lit("????")), 1, 4)


def truncate(col: Column, size: int = 400) -> Column:
    """Text over ``size`` characters is cut there and marked with dots."""
    return F.when(
        F.length(col) > size, F.concat(F.substring(col, 1, size), F.lit("..."))
    ).otherwise(col)


def random_order(seed: int | str, *ids: Column) -> Column:
    """Sort key of a seeded shuffle: the same rows and seed give the same order
    whatever the partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in ids]))
