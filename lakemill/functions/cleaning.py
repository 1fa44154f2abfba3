"""Text cleaning steps as column expressions, and the chains built from them."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemill.functions.fixed import MARKER, MIN_TOKEN_LEN
from lakemill.functions.folding import composed_letter_class, fold_ascii

# Whitespace written out: regex dialects disagree on \s beyond space, tab and newline.
ASCII_SPACE = r"\x09-\x0D\x1C-\x20"
UNICODE_SPACE = (
    ASCII_SPACE + r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
PYTHON_SPACE = "[" + re.sub(r"\\x\{?([0-9A-F]+)\}?", lambda m: f"\\u{int(m[1], 16):04x}", UNICODE_SPACE) + "]"


def text_or_none_word(text: Column) -> Column:
    """Missing text is read as the word None, which later fails the length gate."""
    return F.coalesce(text, F.lit("None"))


def linebreaks_to_space(text: Column) -> Column:
    return F.regexp_replace(text, r"[\n\r\t]+", " ")


def squeeze_runs(text: Column, keep: int = 2) -> Column:
    """Runs of three or more equal characters become `keep` of them."""
    return F.regexp_replace(text, r"(?d)(.)\1{2,}", "$1" * keep)


def merge_marker(text: Column, marker: str = MARKER) -> Column:
    """Short prefixes glued to the marker word are removed."""
    merged = F.regexp_replace(text, rf"\b[a-z0-9]{{0,4}}{marker}\b", marker)
    return F.when(F.contains(text, F.lit(marker)), merged).otherwise(text)


def symbols_to_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^a-z0-9{ASCII_SPACE}]", " ")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{ASCII_SPACE}]+", " "))


def split_words(text: Column) -> Column:
    """Whitespace-separated words; none for blank text."""
    return F.filter(F.split(text, rf"[{UNICODE_SPACE}]+"), lambda w: w != "")


def drop_short_words(text: Column, min_len: int = MIN_TOKEN_LEN) -> Column:
    return F.array_join(F.filter(split_words(text), lambda w: F.length(w) >= min_len), " ")


def clean_tokens(text: Column, min_len: int = MIN_TOKEN_LEN) -> Column:
    """Words of the cleaned text.

    Line breaks, symbols and spaces all end up as separators, and short words are dropped,
    so one extraction of long-enough letter/digit runs stands for these four steps.
    """
    text = merge_marker(squeeze_runs(F.lower(fold_ascii(text_or_none_word(text)))))
    return F.regexp_extract_all(text, F.lit(f"[a-z0-9]{{{min_len},}}"), F.lit(0))


def clean_text(text: Column, min_len: int = MIN_TOKEN_LEN) -> Column:
    return F.array_join(clean_tokens(text, min_len), " ")


def clean_text_unfolded(text: Column, min_len: int = MIN_TOKEN_LEN) -> Column:
    """Older cleaner: accented letters become separators, runs shrink to one character."""
    text = text_or_none_word(text)
    composed = F.regexp_replace(text, composed_letter_class(), " ")
    text = F.when(text.rlike(r"\p{Mn}"), composed).otherwise(text)
    text = squeeze_runs(linebreaks_to_space(F.lower(text)), keep=1)
    words = F.regexp_extract_all(text, F.lit(f"[a-z0-9]{{{min_len},}}"), F.lit(0))
    return F.array_join(words, " ")


@lru_cache(maxsize=1)
def _letter_tables() -> tuple[str, str]:
    """(white space, all other ASCII but letters)."""
    space = [c for c in map(chr, range(0x3001)) if re.match(PYTHON_SPACE, c)]
    rest = [c for c in map(chr, range(128)) if not c.isalpha() and c not in space]
    return "".join(space), "".join(rest)


def has_symbol(text: Column) -> Column:
    """Whether a character is neither an ASCII letter or digit nor white space."""
    plain = "".join(c for c in map(chr, range(128)) if c.isalnum())
    return F.translate(text, plain + _letter_tables()[0], "") != ""


def letters_and_spaces(text: Column) -> Column:
    """ASCII letters and single spaces for runs of white space; all else is dropped.

    A character table does most of it: negated classes of several ranges are slow to match.
    """
    space, rest = _letter_tables()
    plain = F.regexp_replace(F.translate(text, space + rest, " " * len(space)), r"[^\x00-\x7F]+", "")
    return F.regexp_replace(plain, " {2,}", " ")


def letters_or_space(text: Column) -> Column:
    """ASCII letters, and a space in place of any other ASCII character or run of characters beyond."""
    rest = "".join(c for c in map(chr, range(128)) if not c.isalpha())
    return F.regexp_replace(F.translate(text, rest, " " * len(rest)), r"[^\x00-\x7F]+", " ")


def strip_markup(text: Column) -> Column:
    """Remove tags and links, keep letters and single spaces; missing text gives ''."""
    text = F.coalesce(text, F.lit(""))
    text = F.regexp_replace(text, r"<[^>]+>", "")
    text = F.regexp_replace(text, rf"http[^{UNICODE_SPACE}]+|www\.[^{UNICODE_SPACE}]+", "")
    return F.trim(letters_and_spaces(text))
