"""Mergeable sketches per month: quality and length reports over any range of months without texts.

A month is one row: exact additive counts, a HyperLogLog sketch of its distinct texts and KLL sketches of
its text lengths and of numeric columns. Rows of a range are merged; the texts are not read again. Counts,
sums and extremes are exact. Distinct counts are within `UNIQUE_ERROR` of the exact ones and quantiles
within `RANK_ERROR` of their rank (about three standard errors of the sketches' sizes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.fixed import PSI_BINS, PSI_FLOOR
from lakemill.functions.numbers import half_even

MONTH = "month_partition"
LOG_CELLS, KLL_SIZE = 14, 800
UNIQUE_ERROR, RANK_ERROR = 0.025, 0.01


def month_sketches(rows: DataFrame, text: str, numbers: list[str] = []) -> DataFrame:
    """One row per month. A missing text counts as the word None, as in the exact reports."""
    s = F.coalesce(F.col(text), F.lit("None"))
    length = F.length(s)
    kll = lambda c: F.kll_sketch_agg_double(c.cast("double"), F.lit(KLL_SIZE))
    return rows.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(text).isNull()).alias("n_null"),
        F.sum(length.cast("long")).alias("total_length"), F.sum((length.cast("decimal(20,0)") * length).cast("decimal(38,0)")).alias("total_square"),
        F.min(length).alias("min_length"), F.max(length).alias("max_length"),
        F.hll_sketch_agg(F.xxhash64(s), F.lit(LOG_CELLS)).alias("texts"), kll(length).alias("lengths"),
        *[kll(F.col(c)).alias(f"kll_{c}") for c in numbers],
    )


def merged(sketches: DataFrame, group: list[str] = []) -> DataFrame:
    """The rows of months as one row (per group) of the same shape."""
    numbers = [c for c in sketches.columns if c.startswith("kll_")]
    return sketches.groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "total_length", "total_square")],
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
        F.hll_union_agg("texts").alias("texts"), *[F.kll_merge_agg_double(c).alias(c) for c in ("lengths", *numbers)],
    )


def in_range(sketches: DataFrame, start: str, end: str) -> DataFrame:
    return sketches.where(F.col(MONTH).between(start, end))


def quantiles(sketch: str, shares: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(s)) for s in shares]))


def range_report(sketches: DataFrame, start: str, end: str) -> DataFrame:
    """Uniqueness and length description of a range of months."""
    n = F.col("n_rows")
    mean = F.col("total_length") / n
    spread = (F.col("total_square").cast("double") - n * mean * mean) / (n - 1)
    unique = F.least(F.hll_sketch_estimate("texts"), n)
    q = quantiles("lengths", [0.25, 0.5, 0.75])
    return merged(in_range(sketches, start, end)).where("n_rows > 0").select(
        "n_rows", "n_null", unique.alias("n_unique"), half_even(unique / n, 4).alias("unique_rate"),
        half_even((n - unique) / n, 4).alias("duplicate_rate"), "min_length", "max_length", half_even(mean, 2).alias("mean_length"),
        F.when(n > 1, F.round(F.sqrt(F.greatest(spread, F.lit(0.0))), 6)).alias("std_length"),
        *[q[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))],
    )


def range_psi(sketches: DataFrame, column: str, reference: tuple[str, str], current: tuple[str, str], bins: int = PSI_BINS) -> DataFrame:
    """Population stability index of a numeric column between two ranges of months.

    Bins are cut at the reference quantiles; the share of a bin is a difference of two ranks, so each
    share is within twice `RANK_ERROR`."""
    sketch = f"kll_{column}"

    def of(months: tuple[str, str], name: str) -> DataFrame:
        return in_range(sketches, *months).agg(F.kll_merge_agg_double(sketch).alias(name))

    # Ranks are taken at fixed places, so the cuts (at most bins - 1 numbers) pass through the driver.
    cuts = of(reference, "ref").select(quantiles("ref", [i / bins for i in range(1, bins)])).first()[0] or []
    places = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<double>")
    pair = of(reference, "ref").select("ref", of(current, "new").scalar().alias("new"))
    ranked = pair.select(*[
        F.concat(F.array(F.lit(0.0)), F.kll_sketch_get_rank_double(c, places), F.array(F.lit(1.0))).alias(c) for c in ("ref", "new")
    ])

    def shares(c: str) -> Column:
        cells = F.zip_with(F.slice(c, 2, F.size(c) - 1), F.slice(c, 1, F.size(c) - 1), lambda b, a: b - a)
        return F.transform(cells, lambda s: F.when(s <= 0, F.lit(PSI_FLOOR)).otherwise(s))

    terms = F.zip_with(shares("ref"), shares("new"), lambda r, n: (n - r) * F.log(n / r))
    return ranked.select(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t).alias("psi"))
