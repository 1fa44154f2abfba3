"""Exploratory profiles: counts, shares, top lists, histograms, correlation, association."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.cleaning import split_words
from lakemill.functions.numbers import half_even, share
from lakemill.operators.ranks import exact_quantiles, value_counts


def label_pivot(df: DataFrame, labels: list[str] = ["ham", "spam"]) -> DataFrame:
    """Rows per month and raw label, one column per label."""
    return df.groupBy("month_partition").agg(
        *[F.count_if(F.col("raw_label") == v).alias(v) for v in labels]
    )


def top_tokens(df: DataFrame, text: str, group: str, n: int = 20) -> DataFrame:
    """The n most frequent whitespace tokens of each group, ties by token."""
    counts = (
        df.select(group, F.explode(split_words(F.col(text))).alias("token"))
        .groupBy(group, "token")
        .agg(F.count(F.lit(1)).alias("n_uses"))
    )
    # Spark limits each task's rows to n per group before this window's shuffle.
    ranked = Window.partitionBy(group).orderBy(F.desc("n_uses"), "token")
    return counts.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= n)


def marker_rate(df: DataFrame, flag: Column, group: str) -> DataFrame:
    """Percentage of rows with the flag per group."""
    rate = half_even(F.avg(flag.cast("double")) * 100, 2)
    return df.groupBy(group).agg(rate.alias("rate_pct"))


def top_matches(df: DataFrame, text: str, regex: str, n: int = 10) -> DataFrame:
    """Most frequent first-group matches of a regex over all texts, ties by match."""
    return (
        df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(regex), F.lit(1))).alias("variant"))
        .groupBy("variant")
        .agg(F.count(F.lit(1)).alias("n_uses"))
        .orderBy(F.desc("n_uses"), "variant")
        .limit(n)
    )


# Patterns whose presence is reported.
CONTENT_PATTERNS = {
    "html_tag": r"<[^>]+>",
    "url": r"https?://|www\.",
    "from_header": r"(?m)^From:",
    "subject_header": r"(?m)^Subject:",
}


def content_rates(df: DataFrame, text: str) -> DataFrame:
    return df.agg(*[share(F.col(text).rlike(p), 6).alias(n) for n, p in CONTENT_PATTERNS.items()])


def describe_length(df: DataFrame, text: str, group: list[str] = []) -> DataFrame:
    """Count, mean, sample deviation, extremes, exact quartiles and short/long shares of lengths."""
    lengths = df.select(*group, F.length(text).alias("_len"))
    n = F.col("_len")
    basics = lengths.groupBy(*group).agg(
        F.count("_len").alias("n_rows"),
        F.round(F.avg(n), 6).alias("mean"),
        F.round(F.stddev_samp(n), 6).alias("std"),
        F.min(n).alias("min"),
        F.max(n).alias("max"),
        share(n < 20, 6).alias("share_lt20"),
        share(n < 50, 6).alias("share_lt50"),
        share(n > 100_000, 6).alias("share_gt100k"),
    )
    quartiles = exact_quantiles(value_counts(lengths, "_len", group), "_len", [0.25, 0.5, 0.75], group)
    parts = [F.col("q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    if group:
        return basics.join(quartiles.select(*group, *parts), group)
    spread = quartiles.select(F.struct(*parts)).scalar()
    return basics.select("*", spread.alias("_q")).select(*basics.columns, "_q.*")


def monthly_rows(df: DataFrame, limit: int = 50) -> DataFrame:
    return df.groupBy("month_partition").agg(
        F.count(F.lit(1)).alias("n_rows"), share(F.col("char_count") < limit, 6).alias("short_share")
    )


def label_shares(df: DataFrame) -> DataFrame:
    """Share of each label overall (`all`) and per month."""
    counts = df.where(F.col("label").isNotNull()).groupBy("month_partition", "label").agg(
        F.count(F.lit(1)).alias("n")
    )
    overall = counts.groupBy("label").agg(F.sum("n").alias("n")).select(
        F.lit("all").alias("month_partition"), "label", "n"
    )
    total = F.sum("n").over(Window.partitionBy("month_partition"))
    return overall.unionByName(counts).select(
        "month_partition", "label", "n", (F.col("n") / total).alias("label_share")
    )


def _unpivoted(df: DataFrame, keep: list[str], features: list[str]) -> DataFrame:
    return df.unpivot(keep, [F.col(f).cast("double").alias(f) for f in features], "feature", "value")


def histograms(df: DataFrame, features: list[str], group: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the extremes of each feature and group; the last bin is closed.

    `group` is a class column: the extremes are one row per class and feature.
    """
    wide = df.groupBy(group).agg(
        *[F.struct(F.min(f).cast("double").alias("lo"), F.max(f).cast("double").alias("hi")).alias(f)
          for f in features]
    )
    extremes = wide.unpivot(group, features, "feature", "span").select(group, "feature", "span.*")
    width = F.col("hi") - F.col("lo")
    place = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / F.when(width != 0, width) * bins), F.lit(bins - 1))
    )
    return (
        _unpivoted(df, [group], features)
        .join(F.broadcast(extremes), [group, "feature"])
        .groupBy("feature", group, place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def correlation_pairs(df: DataFrame, features: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every feature pair, constant features left out."""
    means = df.select(F.struct(*[F.avg(f).alias(f) for f in features])).scalar()
    # Deviations from the means, then plain sums of products: one light buffer per pair, and no
    # loss of digits on large values.
    centred = df.select(*features, means.alias("_m")).selectExpr(
        *[f"`{f}` - _m.`{f}` AS x{i}" for i, f in enumerate(features)]
    )
    # SQL text for the many pairs: building each column from Python is slow to plan.
    places = list(combinations(range(len(features)), 2))
    squares = [F.expr(f"sum(x{i} * x{i}) AS s{i}") for i in range(len(features))]
    sums = centred.agg(*squares, *[F.expr(f"sum(x{i} * x{j}) AS c{i}_{j}") for i, j in places])
    rows = ", ".join(
        f"struct('{features[i]}' AS feature_1, '{features[j]}' AS feature_2, "
        f"round(try_divide(c{i}_{j}, sqrt(s{i}) * sqrt(s{j})), {digits}) AS correlation)"
        for i, j in places
    )
    return sums.select(F.expr(f"inline(array({rows}))")).where("correlation IS NOT NULL")


def high_correlation(df: DataFrame, features: list[str], limit: float = 0.9) -> DataFrame:
    pairs = correlation_pairs(df, features)
    return pairs.where(F.abs("correlation") > limit).orderBy(F.desc("correlation"))


def mutual_information(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mutual information in nats of two discrete columns."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    by_a, by_b = Window.partitionBy(a), Window.partitionBy(b)
    total = cells.agg(F.sum("n").alias("t")).scalar()
    # One row per value pair from here on.
    joint = cells.select(
        F.col("n").cast("double"),
        F.sum("n").over(by_a).cast("double").alias("na"),
        F.sum("n").over(by_b).cast("double").alias("nb"),
        total.cast("double").alias("t"),
    )
    term = F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("na") * F.col("nb")))
    return joint.agg(F.round(F.greatest(F.sum(term), F.lit(0.0)), 9).alias("mutual_information"))


def label_quantiles(df: DataFrame, features: list[str], shares: list[float], group: str = "label") -> DataFrame:
    """Exact quantiles of every feature per label."""
    counts = value_counts(_unpivoted(df, [group], features), "value", [group, "feature"])
    return exact_quantiles(counts, "value", shares, [group, "feature"])
