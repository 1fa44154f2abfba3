"""Data-quality profile of a text column, over the whole table or per group.

All rates of one profile come from one aggregate. Distinct values are counted by digest,
so texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.cleaning import UNICODE_SPACE, has_symbol, split_words
from lakemill.functions.fixed import PLACEHOLDERS, SPAM_SHARE_HIGH, SPAM_SHARE_LOW
from lakemill.functions.numbers import half_even, share

EDGE_SPACE = rf"^[{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+$"


def _as_string(text: str) -> Column:
    # Every check but the null and empty ones sees a missing text as the word None.
    return F.coalesce(F.col(text), F.lit("None"))


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_SPACE, "")


def completeness(text: str) -> dict[str, Column]:
    s = _as_string(text)
    return {
        "total_rows": F.count(F.lit(1)),
        "null_count": F.count_if(F.col(text).isNull()),
        "null_rate": share(F.col(text).isNull()),
        "empty_string_rate": share(F.col(text) == ""),
        "whitespace_rate": share(_stripped(s) == ""),
        "placeholder_rate": share(F.lower(s).isin(PLACEHOLDERS)),
    }


def consistency(text: str) -> dict[str, Column]:
    s = _as_string(text)
    return {
        "case_inconsistency_rate": share(s != F.lower(s)),
        "leading_trailing_spaces_rate": share(s != _stripped(s)),
        "multiple_spaces_rate": share(s.rlike(rf"[{UNICODE_SPACE}]{{2,}}")),
    }


def length(text: str) -> dict[str, Column]:
    n = F.length(_as_string(text))
    return {
        "min_length": F.min(n),
        "max_length": F.max(n),
        "mean_length": half_even(F.avg(n), 2),
        "short_text_rate_lt3": share(n < 3),
        "long_text_rate_gt100": share(n > 100),
    }


def pattern(text: str) -> dict[str, Column]:
    s = _as_string(text)
    return {
        "numeric_only_rate": share(s.rlike(r"^\p{Nd}+\n?\z")),
        "special_char_rate": share(has_symbol(s)),
        "contains_digit_rate": share(s.rlike(r"\p{Nd}")),
    }


def semantic(text: str) -> dict[str, Column]:
    s = _as_string(text)
    return {
        "single_word_rate": share(F.size(split_words(s)) == 1),
        "very_low_information_rate": share(F.length(s) < 2),
    }


def label_distribution(label: str) -> dict[str, Column]:
    y = F.col(label)
    return {
        "spam_ratio": half_even(F.avg(y), 4),
        "spam_count": F.count_if(y == 1),
        "ham_count": F.count_if(y == 0),
        "drift_flag": (F.avg(y) < SPAM_SHARE_LOW) | (F.avg(y) > SPAM_SHARE_HIGH),
    }


def profile(df: DataFrame, metrics: dict[str, Column], group: list[str] = []) -> DataFrame:
    """One row per group with the given metrics."""
    return df.groupBy(*group).agg(*[c.alias(n) for n, c in metrics.items()])


def _digest_counts(df: DataFrame, text: str, group: list[str], order: str | None = None) -> DataFrame:
    keep = [F.count(F.lit(1)).alias("_n")]
    if order:
        keep.append(F.min(order).alias("_first"))
    digest = F.unhex(F.sha2(_as_string(text), 256)).alias("_digest")
    return df.groupBy(*group, digest).agg(*keep)


def uniqueness(df: DataFrame, text: str, group: list[str] = []) -> DataFrame:
    """n_unique, unique_rate, duplicate_rate per group."""
    rows, unique = F.sum("_n"), F.count(F.lit(1))
    return (
        _digest_counts(df, text, group)
        .groupBy(*group)
        .agg(
            unique.alias("n_unique"),
            half_even(unique / rows, 4).alias("unique_rate"),
            half_even((rows - unique) / rows, 4).alias("duplicate_rate"),
        )
    )


#: Relative standard error of a sketched distinct count. A tenth is five of them, so it holds for every
#: one of a thousand groups; about 3 kB per group.
UNIQUE_ERROR = 0.02


def approx_unique(df: DataFrame, text: str, group: list[str] = []) -> DataFrame:
    """Sketch of the distinct count, when an exact digest shuffle is not worth it."""
    return df.groupBy(*group).agg(F.approx_count_distinct(_as_string(text), UNIQUE_ERROR).alias("n_unique_approx"))


def top_values(df: DataFrame, text: str, order: str, n: int = 5) -> DataFrame:
    """The n most frequent values with their counts, ties by first appearance in `order`."""
    top = (
        _digest_counts(df, text, [], order)
        .orderBy(F.desc("_n"), "_first")
        .limit(n)
        .select(F.col("_first").alias(order), F.col("_n").alias("n_rows"))
    )
    # `order` is unique, so at most n texts are fetched.
    return df.join(F.broadcast(top), order).select(order, _as_string(text).alias("value"), "n_rows")


CHECKS = {
    "completeness": completeness,
    "consistency": consistency,
    "length": length,
    "pattern": pattern,
    "semantic": semantic,
}


def summary(
    df: DataFrame, text: str, label: str | None = "label", group: list[str] = []
) -> DataFrame:
    """Long table (group, category, metric, value) of every scalar metric."""
    families = {name: check(text) for name, check in CHECKS.items()}
    if label and label in df.columns:
        families["label_distribution"] = label_distribution(label)
    wide = profile(df, {f"{f}.{m}": c for f, ms in families.items() for m, c in ms.items()}, group)
    unique = uniqueness(df, text, group)

    def long(frame: DataFrame, entries: list[tuple[str, str, str]]) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(F.lit(f).alias("category"), F.lit(m).alias("metric"),
                         F.col(f"`{c}`").cast("double").alias("value"))
                for f, m, c in entries
            ]
        )
        return frame.select(*group, F.inline(pairs))

    entries = [(f, m, f"{f}.{m}") for f, ms in families.items() for m in ms]
    unique_entries = [("uniqueness", m, m) for m in ("n_unique", "unique_rate", "duplicate_rate")]
    return long(wide, entries).unionByName(long(unique, unique_entries))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) for every column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in df.columns]
    )
    return counts.select(F.inline(pairs))


def validity(df: DataFrame, text: str, regex: str) -> DataFrame:
    """Share of texts that match `regex` at their start."""
    return df.agg(share(_as_string(text).rlike(f"^(?:{regex})"), 6).alias("valid_rate"))


def invalid_examples(df: DataFrame, text: str, regex: str, order: str, n: int = 10) -> DataFrame:
    """The first n texts that do not match."""
    bad = df.where(~_as_string(text).rlike(f"^(?:{regex})"))
    return bad.orderBy(order).limit(n).select(order, _as_string(text).alias("value"))


def top_duplicates(df: DataFrame, text: str, key: str, group: list[str], n: int = 5) -> DataFrame:
    """(group, top_duplicates): the n most repeated texts of each group with their counts, by count
    and then by first key.

    Texts are counted by digest. The best of 64 slices per group are compared, so a group with many
    repeated texts is not ranked in one task; only the texts that win are fetched.
    """
    digest = F.sha2(_as_string(text), 256)
    counts = df.groupBy(*group, digest.alias("_d")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias(key)).where("n_rows > 1")
    order = [F.desc("n_rows"), key]
    sliced = Window.partitionBy(*group, F.pmod(F.xxhash64("_d"), F.lit(64))).orderBy(*order)
    best = counts.withColumn("_p", F.row_number().over(sliced)).where(F.col("_p") <= n)
    best = best.withColumn("_p", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_p") <= n)
    named = best.select(*group, key, "n_rows", "_p").join(df.select(*group, key, _as_string(text).alias("value")), [*group, key])
    entry = F.struct(F.col("_p"), F.col("value"), F.col("n_rows"))
    return named.groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["value"].alias("value"), e["n_rows"].alias("n_rows"))).alias("top_duplicates")
    )


def quality_report(
    bronze_clean: DataFrame, gate: DataFrame, text: str = "body_clean", label: str = "label", key: str = "email_id"
) -> DataFrame:
    """Gate counters plus nested metrics per month, in the shape the JSON report is written in.

    Pass rows that are cleaned and written once: they are read several times.
    """
    month = ["month_partition"]
    families = {name: check(text) for name, check in CHECKS.items()}
    families["label_distribution"] = label_distribution(label)
    wide = profile(
        bronze_clean, {f"{f}.{m}": c for f, ms in families.items() for m, c in ms.items()}, month
    )
    nested = F.struct(
        *[
            F.struct(*[F.col(f"`{f}.{m}`").alias(m) for m in ms]).alias(f)
            for f, ms in families.items()
        ],
        F.struct("n_unique", "unique_rate", "duplicate_rate", "top_duplicates").alias("uniqueness"),
    ).alias("quality_metrics")
    flag = F.col("`label_distribution.drift_flag`").alias("drift_flag")
    return (
        gate.join(wide, month)
        .join(uniqueness(bronze_clean, text, month), month)
        .join(top_duplicates(bronze_clean, text, key, month), month, "left")
        .select(*gate.columns, nested, flag)
    )
