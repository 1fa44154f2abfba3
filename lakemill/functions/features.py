"""Text features as column expressions.

The same builders serve the silver table and scoring, so both always agree.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.cleaning import (
    clean_tokens,
    strip_markup,
    text_or_none_word,
)
from lakemill.functions.fixed import DOMAIN_STOP_WORDS, MARKER, MIN_TOKEN_LEN, SPAM_KEYWORDS
from lakemill.functions.numbers import at_least_one, half_even


def keyword_count(clean: Column, keywords: list[str] = SPAM_KEYWORDS) -> Column:
    """Non-overlapping whole-word matches of any keyword or phrase."""
    alternatives = "|".join(map(re.escape, keywords))
    return F.regexp_count(clean, F.lit(rf"\b(?:{alternatives})\b"))


def has_marker(raw: Column, marker: str = MARKER) -> Column:
    return F.coalesce(F.contains(F.lower(raw), F.lit(marker)), F.lit(False)).cast("int")


def char_share(raw: Column, pattern: str) -> Column:
    return half_even(F.regexp_count(raw, F.lit(pattern)) / at_least_one(F.length(raw)), 4)


def length_features(clean: Column, tokens: Column) -> dict[str, Column]:
    return {
        "char_count": F.length(clean),
        "word_count": F.size(tokens),
        "n_unique_words": F.size(F.array_distinct(tokens)),
    }


def ratio_features() -> dict[str, Column]:
    """Features of the counts alone; expects char_count, word_count and n_unique_words."""
    chars, words, unique = F.col("char_count"), F.col("word_count"), F.col("n_unique_words")
    return {
        "avg_word_length": half_even(chars / at_least_one(words), 2),
        "log_chars": half_even(F.log1p(chars), 4),
        "log_words": half_even(F.log1p(words), 4),
        "unique_word_ratio": half_even(unique / at_least_one(words), 4),
        "info_density": half_even(unique / at_least_one(chars), 6),
    }


def style_features(raw: Column) -> dict[str, Column]:
    raw = text_or_none_word(raw)
    return {
        "exclaim_count": F.regexp_count(raw, F.lit("!")),
        "question_count": F.regexp_count(raw, F.lit(r"\?")),
        "digit_ratio": char_share(raw, r"\p{Nd}"),
        "upper_ratio": char_share(raw, "[A-Z]"),
    }


def add_clean(df: DataFrame, text: str = "body") -> DataFrame:
    """Add `tokens` and `body_clean`.

    The words come out of a one-row generator: a later filter on the cleaned text then stays
    above it, where a plain column would be copied into the filter and cleaned twice.
    """
    words = F.array(F.struct(clean_tokens(F.col(text)).alias("tokens")))
    return df.select("*", F.inline_outer(words)).withColumn("body_clean", F.array_join("tokens", " "))


def add_text_features(
    df: DataFrame, text: str = "body", keywords: list[str] = SPAM_KEYWORDS, marker: str = MARKER
) -> DataFrame:
    """Add the sixteen silver features; expects `tokens` and `body_clean` over the whole text."""
    clean, raw = F.col("body_clean"), F.col(text)
    return (
        df.withColumns(length_features(clean, F.col("tokens")))
        .withColumns(ratio_features())
        .withColumns(
            {
                "repetition_ratio": half_even(1 - F.col("unique_word_ratio"), 4),
                "complexity": half_even(F.col("unique_word_ratio") * F.col("avg_word_length"), 4),
                **style_features(raw),
                "spam_keyword_count": keyword_count(clean, keywords),
                "has_escapenumber": has_marker(raw, marker),
            }
        )
    )


def add_scoring_features(df: DataFrame, text: str) -> DataFrame:
    """The four numeric model features of a message, by the silver formulas."""
    return (
        df.withColumns(length_features(F.col("body_clean"), F.col("tokens")))
        .withColumns(ratio_features())
        .withColumn("exclaim_count", style_features(F.col(text))["exclaim_count"])
        .drop("char_count", "word_count", "n_unique_words", "log_words", "info_density")
    )


def add_stopword_filter(
    df: DataFrame, text: str, stop_words: list[str], min_len: int = MIN_TOKEN_LEN
) -> DataFrame:
    """Strip markup, lower-case, drop stop words and short words.

    Adds text_tokens, n_stopwords_removed and text_processed.
    """
    # A list of literals becomes a hash set; an array would be searched from its start for every word.
    stops = sorted(set(stop_words) | set(DOMAIN_STOP_WORDS))
    kept = F.filter("text_tokens", lambda w: (F.length(w) >= min_len) & ~w.isin(stops))
    # The stripped text holds single spaces only. Words and kept words come out of one-row generators, as a
    # plain column would be copied to each of its uses.
    words = F.filter(F.split(F.lower(strip_markup(F.col(text))), " "), lambda w: w != "")
    return (
        df.select("*", F.inline_outer(F.array(F.struct(words.alias("text_tokens")))))
        .select("*", F.inline_outer(F.array(F.struct(kept.alias("_kept")))))
        .withColumn("n_stopwords_removed", F.size("text_tokens") - F.size("_kept"))
        .withColumn("text_processed", F.array_join("_kept", " "))
        .drop("_kept")
    )


def add_row_stats(df: DataFrame, text: str) -> DataFrame:
    """Character and word counts; expects text_tokens."""
    letters = F.split(F.replace(F.col(text), F.lit(" ")), "")
    return df.withColumns(
        {
            "n_chars": F.length(text),
            "n_unique_chars": F.size(F.filter(F.array_distinct(letters), lambda c: c != "")),
            "n_words": F.size("text_tokens"),
            "n_unique_words": F.size(F.array_distinct("text_tokens")),
        }
    )


def add_row_ratios(df: DataFrame) -> DataFrame:
    """Ratio features of the row stats; a zero denominator gives null."""
    chars, words = F.col("n_chars"), F.col("n_words")
    unique_chars, unique = F.col("n_unique_chars"), F.col("n_unique_words")
    removed = F.col("n_stopwords_removed")

    def per(a: Column, b: Column) -> Column:
        return F.try_divide(a.cast("double"), b.cast("double"))

    return df.withColumns(
        {
            "perc_stopwords_removed": per(removed, words),
            "perc_unique_words": per(unique, words),
            "stopword_ratio": per(words - removed, words),
            "unique_word_ratio": per(unique, words),
            "unique_char_ratio": per(unique_chars, chars),
            "avg_word_length": per(chars, words),
            "log_words": F.log1p(words),
            "log_chars": F.log1p(chars),
            "chars_per_unique_word": per(chars, unique),
            "repetition_ratio": 1 - per(unique, words),
            "char_repetition": 1 - per(unique_chars, chars),
            "content_ratio": per(removed, words),
            "stopword_vs_unique": per(words - removed, unique),
            "complexity": per(unique, words) * per(chars, words),
            "info_density": per(unique, chars),
        }
    )
