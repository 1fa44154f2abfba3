"""Bronze to silver: clean, derive features, gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.features import add_clean, add_text_features
from lakemill.functions.fixed import (
    MARKER,
    MAX_CHARS,
    MIN_CHARS,
    SILVER_FEATURES,
    SPAM_KEYWORDS,
)

SILVER_COLUMNS = ["email_id", "body_clean", "label", "received_at", *SILVER_FEATURES, "month_partition"]

# Storage types of the silver table; operators compute in double.
SILVER_TYPES = {
    "label": "tinyint",
    **{c: "int" for c in ("char_count", "word_count", "n_unique_words", "exclaim_count",
                          "question_count", "spam_keyword_count")},
    **{c: "float" for c in ("avg_word_length", "log_chars", "log_words", "unique_word_ratio",
                            "repetition_ratio", "complexity", "info_density", "digit_ratio",
                            "upper_ratio")},
    "has_escapenumber": "tinyint",
}


def featured(
    bronze: DataFrame, keywords: list[str] = SPAM_KEYWORDS, marker: str = MARKER
) -> DataFrame:
    """Bronze rows with cleaned text and all features, before the gate."""
    return add_text_features(add_clean(bronze), keywords=keywords, marker=marker)


def truncated(df: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Cut over-long cleaned text; counts derived before keep describing the whole text."""
    return df.withColumn("was_truncated", F.length("body_clean") > max_chars).withColumn(
        "body_clean", F.substring("body_clean", 1, max_chars)
    )


def too_short(min_chars: int = MIN_CHARS) -> Column:
    return F.length("body_clean") < min_chars


def silver(
    bronze: DataFrame,
    keywords: list[str] = SPAM_KEYWORDS,
    marker: str = MARKER,
    min_chars: int = MIN_CHARS,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    rows = truncated(featured(bronze.where(F.col("label").isNotNull()), keywords, marker), max_chars)
    return gated(rows, min_chars)


def gated(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Silver rows of featured and truncated rows."""
    return rows.where(F.col("label").isNotNull() & ~too_short(min_chars)).select(*SILVER_COLUMNS)


def stored(df: DataFrame) -> DataFrame:
    """Pin the storage types."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in SILVER_TYPES.items() if c in df.columns})


def gate_counts(
    bronze: DataFrame, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS
) -> DataFrame:
    """Row counters per month; short and null-label rows may overlap, the total does not."""
    return gate_counts_of(truncated(add_clean(bronze), max_chars), min_chars)


def gate_counts_of(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The counters of rows that are cleaned and truncated already."""
    short, unlabelled = too_short(min_chars), F.col("label").isNull()
    return (
        rows.groupBy("month_partition")
        .agg(
            F.count(F.lit(1)).alias("initial_rows"),
            F.count_if(~short & ~unlabelled).alias("final_rows"),
            F.count_if("was_truncated").alias("truncated_rows"),
            F.count_if(short).alias("dropped_short_body"),
            F.count_if(unlabelled).alias("dropped_null_label"),
        )
        .withColumn("total_dropped", F.col("initial_rows") - F.col("final_rows"))
    )


def drop_reasons(bronze: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Months by first matching drop reason, `kept` included, so counts add up to all rows."""
    # Copies are found by digest, so no text is shuffled; rows then look themselves up by their
    # unique id, so a text that a third of all mails share is not gathered in one task.
    firsts = (
        bronze.where(F.col("body").isNotNull())
        .groupBy("month_partition", F.sha2("body", 256))
        .agg(F.min("email_id").alias("email_id"))
        .select("email_id", F.lit(True).alias("_first"))
    )
    rows = add_clean(bronze).select(
        "email_id",
        "month_partition",
        F.col("body").isNull().alias("_missing"),
        F.col("label").isNull().alias("_unlabelled"),
        (F.col("body_clean") == "").alias("_empty"),
        too_short(min_chars).alias("_short"),
    )
    reason = (
        F.when(F.col("_missing"), "null_text")
        .when(F.col("_first").isNull(), "duplicate_text")
        .when(F.col("_unlabelled"), "invalid_label")
        .when(F.col("_empty"), "empty_after_clean")
        .when(F.col("_short"), "short_text")
        .otherwise("kept")
    )
    return (
        rows.join(firsts, "email_id", "left")
        .groupBy("month_partition", reason.alias("reason"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def monthly_summary(silver_rows: DataFrame) -> DataFrame:
    """Rows, spam share and feature means per month.

    Features have six decimals at most, so decimal sums are exact in any order of rows.
    """
    n = F.count(F.lit(1))
    means = {c: F.sum(F.col(c).cast("decimal(20,6)")).cast("double") / n for c in SILVER_FEATURES}
    return silver_rows.groupBy("month_partition").agg(
        n.alias("n_rows"),
        F.avg("label").alias("spam_share"),
        *[mean.alias(f"mean_{c}") for c, mean in means.items()],
    )
