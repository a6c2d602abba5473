"""Search key: compatibility decomposition, accents off, lower case, ``a-z0-9`` only.

Spark has no Unicode decomposition function, but the key keeps nothing outside
``a-z0-9``, so the decomposition of one character is all that matters and can be
tabulated from ``unicodedata`` by rule. Three kinds of characters need work: those
that fold to one letter or digit, those that vanish (combining marks), and the few
that fold to several characters. ``translate`` does the first two in one pass; the
third kind is expanded first, and only in rows that hold one.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\n"
NON_ASCII = r"[^\x00-\x7F]"


@lru_cache(maxsize=1)
def fold_tables() -> tuple[dict[str, str], str, dict[str, str]]:
    """(one-to-one folds, characters that vanish, folds to several characters)."""
    single: dict[str, str] = {}
    vanish: list[str] = []
    several: dict[str, str] = {}
    for code in range(128, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        parts = [c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)]
        out = "".join(parts).lower()
        if not out:
            vanish.append(char)
            continue
        key = "".join(c if c.isascii() and c.isalnum() else " " for c in out)
        if not key.strip():
            continue
        if len(key) == 1:
            single[char] = key
        else:
            several[char] = key
    return single, "".join(vanish), several


def _char_class(chars: Iterable[str]) -> str:
    """Regular expression class of ``chars``, neighbours written as ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in ranges) + "]"


def fold_text(col: Column) -> Column:
    """Folded search key of a text. Plain ASCII rows skip all of the Unicode work."""
    single, vanish, several = fold_tables()
    # Two literals that fold into one constant map keep the plan small.
    expansions = F.map_from_arrays(
        F.split(F.lit(SEPARATOR.join(several)), SEPARATOR),
        F.split(F.lit(SEPARATOR.join(several.values())), SEPARATOR),
    )
    plain = F.translate(col, "".join(single) + vanish, "".join(single.values()))
    expanded = F.array_join(
        F.transform(
            F.regexp_extract_all(plain, F.lit("(?s)(.)"), F.lit(1)),
            lambda c: F.coalesce(F.try_element_at(expansions, c), c),
        ),
        "",
    )
    rare = plain.rlike(NON_ASCII) & plain.rlike(_char_class(several))
    folded = F.when(~col.rlike(NON_ASCII), col).when(rare, expanded).otherwise(plain)
    return F.trim(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", " "))
