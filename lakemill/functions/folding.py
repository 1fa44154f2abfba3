"""Compatibility folding of text to ASCII with built-in expressions.

Decomposition works code point by code point and only the ASCII part of each result is
kept, so the whole step is a character table. Tables are generated from the Unicode data
of the interpreter: code points with one ASCII character go to `translate`, code points
with several are cut out of the text and looked up one by one.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


CUT = "\uf8ff"


def ascii_part(char: str) -> str:
    return unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")


@lru_cache(maxsize=1)
def fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """(one-to-one table, one-to-many table) over all code points beyond ASCII."""
    single, several = {}, {}
    for code in range(128, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        folded = ascii_part(chr(code))
        if len(folded) == 1:
            single[chr(code)] = folded
        elif folded:
            several[chr(code)] = folded
    return single, several


def _char_class(chars) -> str:
    """Regex class of the given characters, as ranges of code points."""
    codes = sorted(map(ord, chars))
    ranges, first, last = [], codes[0], codes[0]
    for code in codes[1:]:
        if code != last + 1:
            ranges.append((first, last))
            first = code
        last = code
    ranges.append((first, last))
    # The look-ahead rejects most characters before the long list of ranges is tried.
    beyond = f"(?=[\\x{{{codes[0]:X}}}-\\x{{10FFFF}}])"
    return beyond + "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _expand(text: Column) -> Column:
    _, several = fold_tables()
    cls = _char_class(several)
    # Two joined literals, which the optimizer folds into one map; one literal each would be slow to plan.
    table = F.map_from_arrays(*[F.split(F.lit("\n".join(x)), "\n") for x in (several, several.values())])
    # Cut around each expandable character, so lookups cost per occurrence and not per character.
    # The cut mark is a private character that folding would drop anyway.
    pieces = F.split(F.regexp_replace(text, f"({cls})", f"{CUT}$1{CUT}"), CUT)
    spelled = F.transform(pieces, lambda p: F.coalesce(F.try_element_at(table, p), p))
    return F.when(text.rlike(cls), F.array_join(spelled, "")).otherwise(text)


def fold_ascii(text: Column) -> Column:
    """Compatibility-decompose and drop whatever is not ASCII; ASCII rows pass untouched."""
    single, _ = fold_tables()
    folded = F.translate(_expand(text), "".join(single), "".join(single.values()))
    folded = F.regexp_replace(folded, r"[^\x00-\x7F]+", "")
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(folded)


@lru_cache(maxsize=1)
def composed_letter_class() -> str:
    """Regex of an ASCII letter that canonical composition would merge with a following mark."""
    by_mark: dict[str, str] = {}
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    for mark in map(chr, range(0x300, 0x370)):
        bases = "".join(b for b in letters if len(unicodedata.normalize("NFC", b + mark)) == 1)
        if bases:
            by_mark[mark] = bases
    return "|".join(f"[{bases}]\\x{{{ord(mark):X}}}" for mark, bases in by_mark.items())
