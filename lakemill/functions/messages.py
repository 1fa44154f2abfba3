"""Message columns: input text, body choice, header lookup, log fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemill.functions.cleaning import UNICODE_SPACE

# Labels put on scored mail.
SPAM_LABEL = "AI_SPAM"
HAM_LABEL = "AI_HAM"
ERROR_LABEL = "ERROR"

EDGE_SPACE = rf"^[{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+$"


def input_text(subject: Column, body: Column) -> Column:
    """Subject and body joined by a space, empty parts left out, trimmed."""
    parts = F.concat_ws(" ", F.nullif(subject, F.lit("")), F.nullif(body, F.lit("")))
    return F.regexp_replace(parts, EDGE_SPACE, "")


def decoded(data: Column) -> Column:
    """Text of url-safe base64; undecodable data is '' and bad UTF-8 is replaced."""
    raw = F.try_to_binary(F.translate(data, "-_", "+/"), F.lit("base64"))
    return F.coalesce(F.make_valid_utf8(raw.cast("string")), F.lit(""))


def header(headers: Column, name: str) -> Column:
    """Value of a header by case-insensitive name, the last one if repeated, else ''."""
    same = F.filter(headers, lambda h: F.lower(h["name"]) == name.lower())
    return F.coalesce(F.try_element_at(same, F.lit(-1))["value"], F.lit(""))


def one_line(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "\n\r", "  ")


def log_probability(p: Column) -> Column:
    return F.format_string("%.6f", p)


def verdict(p: Column, threshold: Column) -> Column:
    return F.when(p >= threshold, "spam").otherwise("not_spam")


def applied_label(prediction: Column, failed: Column) -> Column:
    return F.when(failed, ERROR_LABEL).when(prediction == "spam", SPAM_LABEL).otherwise(HAM_LABEL)
