"""Feature selection, time hold-out, stratified split and leak check."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.fixed import DROPPED_FEATURES, NUMERIC_FEATURES, SEED, VAL_SHARE
from lakemill.functions.numbers import half_even, seeded_int

RANGE_BITS = 16


def null_features(df: DataFrame, features: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """(feature, n_null) of the kept numeric features."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_null")) for c in features])
    return counts.select(F.inline(pairs))


def select_features(
    df: DataFrame, dropped: list[str] = DROPPED_FEATURES, kept: list[str] = NUMERIC_FEATURES
) -> DataFrame:
    """Drop the unused features; a null in a kept one fails the job that reads it."""
    gated = {
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in numeric feature {c}")).cast(t))
        .otherwise(F.col(c))
        for c, t in df.dtypes
        if c in kept
    }
    return df.drop(*dropped).withColumns(gated)


@dataclass(frozen=True)
class StratifiedCut:
    """An exact, stratified share of rows: per label, the last (hash, key) that is picked.

    Rows are picked in the order of a seeded hash of their key, so once the cuts are known the
    choice is row-local and the same in every later plan.
    """

    key: str
    label: str
    seed: int
    cuts: tuple[tuple[int, int, str], ...]

    @classmethod
    def fit(cls, df: DataFrame, key: str, label: str, share: float, seed: int = SEED) -> StratifiedCut:
        """The total picked is the ceiling of share * n.

        Unpicked quotas per label follow the largest remainder and picked ones take the rest. One
        pass counts hash ranges, a second ranks the one range per label in which the quota ends.
        """
        hashed = df.select(
            F.col(label).alias("_label"), F.col(key).alias("_key"), seeded_int(F.col(key), seed, 1).alias("_h")
        ).withColumn("_range", F.shiftright("_h", 32 - RANGE_BITS))
        ranges = hashed.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("_in"))
        sizes = {r["_label"]: r["n"] for r in ranges.groupBy("_label").agg(F.sum("_in").alias("n")).collect()}
        quotas = _picked_quotas(sizes, share)
        quota = F.coalesce(*[F.when(F.col("_label") == y, F.lit(q)) for y, q in quotas.items()])
        # At most 2^RANGE_BITS short rows per label, whatever the table's size.
        earlier = Window.partitionBy("_label").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        left = quota - F.coalesce(F.sum("_in").over(earlier), F.lit(0))
        border = ranges.withColumn("_left", left).where((F.col("_left") > 0) & (F.col("_left") <= F.col("_in")))
        place = F.row_number().over(Window.partitionBy("_label", "_range").orderBy("_h", "_key"))
        last = (
            # One border range per label.
            hashed.join(F.broadcast(border), ["_label", "_range"])
            .withColumn("_place", place)
            .where(F.col("_place") == F.col("_left"))
            .select("_label", "_h", "_key")
        )
        return cls(key, label, seed, tuple((r["_label"], r["_h"], r["_key"]) for r in last.collect()))

    def picked(self) -> Column:
        hashed, key = seeded_int(F.col(self.key), self.seed, 1), F.col(self.key)
        within = [
            (F.col(self.label) == y) & ((hashed < h) | ((hashed == h) & (key <= k))) for y, h, k in self.cuts
        ]
        return reduce(lambda a, b: a | b, within, F.lit(False))


def _picked_quotas(sizes: dict[int, int], share: float) -> dict[int, int]:
    """Rows to pick per label, from a handful of label counts."""
    n = sum(sizes.values())
    rest = n - math.ceil(n * share)
    ideal = {y: size * rest / n for y, size in sizes.items()}
    extra = rest - sum(map(math.floor, ideal.values()))
    by_remainder = sorted(ideal, key=lambda y: (math.floor(ideal[y]) - ideal[y], y))
    unpicked = {y: math.floor(ideal[y]) + (place < extra) for place, y in enumerate(by_remainder)}
    return {y: size - unpicked[y] for y, size in sizes.items()}


def split(
    df: DataFrame, holdout: str, val_share: float = VAL_SHARE, seed: int = SEED
) -> DataFrame:
    """Add `split`: the hold-out month is test, the rest is train and a stratified val share."""
    held = F.col("month_partition") == holdout
    if df.where(~held).isEmpty():
        raise ValueError(f"no month but {holdout}: a hold-out split needs at least two")
    cut = StratifiedCut.fit(df.where(~held), "email_id", "label", val_share, seed)
    return df.withColumn("split", F.when(held, "test").when(cut.picked(), "val").otherwise("train"))


def split_by_hash(df: DataFrame, key: str, share: float, seed: int = SEED) -> DataFrame:
    """Row-local split: `test` with probability `share` by seeded hash, else `train`."""
    low = seeded_int(F.col(key), seed, 1) < F.lit(int(share * 2**32))
    return df.withColumn("split", F.when(low, "test").otherwise("train"))


def leaked_ids(df: DataFrame, key: str = "email_id") -> DataFrame:
    """Keys that occur in more than one split."""
    return (
        df.groupBy(key)
        .agg(F.collect_set("split").alias("splits"))
        .where(F.size("splits") > 1)
        .select(key, F.array_sort("splits").alias("splits"))
    )


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, share of all rows, spam share and the list of months per split."""
    everything = Window.partitionBy(F.lit(1))
    return (
        df.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            half_even(F.avg("label"), 4).alias("spam_share"),
            F.count_if(F.col("label").isNull()).alias("null_labels"),
            F.countDistinct("month_partition").alias("n_months"),
            F.min("month_partition").alias("first_month"),
            F.max("month_partition").alias("last_month"),
            F.array_sort(F.collect_set("month_partition")).alias("months"),
        )
        # Three rows from here on.
        .withColumn("row_share", F.col("n_rows") / F.sum("n_rows").over(everything))
    )
