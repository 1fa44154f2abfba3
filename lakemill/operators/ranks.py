"""Running totals, row numbers and exact quantiles without a single-task sort.

A window over a whole table, or over a group that may hold a third of it, would run in one
task. Here the order column is cut into value ranges first: totals per range give each range
its offset, and the remaining window runs per range. Range bounds come from an approximate
quantile sketch; they only balance the work, the results are exact for any bounds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: The sketches of all tasks meet in one; with so many bounds each stays under a few hundred kB.
MAX_RANGES = 1000


def _range_count(df: DataFrame) -> int:
    return min(MAX_RANGES, max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def add_ranges(df: DataFrame, order: str, n_ranges: int | None = None) -> DataFrame:
    """Add `_range`, the ordinal of the value range the row falls in.

    Bounds are over all rows, so a range (and any group's share of it) holds about 1/n of the
    table at most, however unequal the groups are.
    """
    n = n_ranges or _range_count(df)
    step = math.isqrt(n) + 1
    value = F.col(order).cast("double")
    # SQL text where many literals are needed: one call each is slow to plan from Python.
    shares = ", ".join(f"{i / n!r}D" for i in range(1, n))
    sketch = df.select(value.alias("v")).agg(
        F.expr(f"percentile_approx(v, array({shares}), {20 * n})").alias("fine")
    )
    # Every step-th bound narrows the search, then one stretch of `step` bounds is compared.
    coarse = F.filter("fine", lambda b, i: i % step == step - 1)
    bounds = sketch.select(F.struct("fine", coarse.alias("coarse")))
    skipped = F.size(F.filter("_bounds.coarse", lambda b: b <= value)) * step
    stretch = F.slice("_bounds.fine", F.col("_skipped") + 1, step)
    place = F.col("_skipped") + F.size(F.filter(stretch, lambda b: b <= value))
    return (
        df.select("*", bounds.scalar().alias("_bounds"))
        .withColumn("_skipped", skipped)
        # Never null: else a null check of this key would be pushed down and repeated per input row.
        .withColumn("_range", F.coalesce(place, F.lit(0)))
        .drop("_bounds", "_skipped")
    )


def _join_ranges(ranged: DataFrame, offsets: DataFrame, group: list[str]) -> DataFrame:
    """Bring the offsets of its range to each row; a null group is a group like any other."""
    renamed = offsets.withColumnsRenamed({c: f"_k_{c}" for c in [*group, "_range"]})
    same = F.col("_range") == F.col("_k__range")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return ranged.join(renamed, same).drop(*[f"_k_{c}" for c in [*group, "_range"]])


def _range_offsets(ranged: DataFrame, sums: list[str], group: list[str]) -> DataFrame:
    """Per group and range: `_t_<c>` in it, `_o_<c>` before it, `<c>_total` in the group."""
    per_range = ranged.groupBy(*group, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # One row per range and group: these windows see at most n_ranges rows per group.
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select(
        "*",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(whole).alias(f"{c}_total") for c in sums],
    )


def _add_before(placed: DataFrame, order: str, sums: list[str], group: list[str]) -> DataFrame:
    """Add `<c>_before` to rows that carry their range's offsets."""
    cell = Window.partitionBy(*group, "_range").orderBy(order)
    cell = cell.rowsBetween(Window.unboundedPreceding, -1)
    before = {
        f"{c}_before": F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(cell), F.lit(0)) for c in sums
    }
    return placed.withColumns(before).drop("_range", *[f"_{x}_{c}" for c in sums for x in "ot"])


def running_totals(
    df: DataFrame,
    order: str,
    sums: list[str],
    group: list[str] = [],
    n_ranges: int | None = None,
) -> DataFrame:
    """Add, per c in `sums`, `<c>_before` (total over rows of smaller `order`) and `<c>_total`.

    `order` must be unique within the group and castable to double.
    """
    ranged = add_ranges(df, order, n_ranges)
    placed = _join_ranges(ranged, _range_offsets(ranged, sums, group), group)
    return _add_before(placed, order, sums, group)


def row_index(df: DataFrame, order: str, name: str = "idx", n_ranges: int | None = None) -> DataFrame:
    """Add a dense 0-based row number by a unique order column, and the row count `n_total`."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_totals(counted, order, ["_one"], n_ranges=n_ranges)
    return numbered.withColumnsRenamed({"_one_before": name, "_one_total": "n_total"}).drop("_one")


def value_counts(
    df: DataFrame, value: str, group: list[str] = [], freq: Column | None = None
) -> DataFrame:
    """Distinct values with their frequencies, pre-aggregated in the map tasks."""
    n = F.sum(freq) if freq is not None else F.count(F.lit(1))
    return df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(n.alias("_n"))


def exact_quantiles(
    counts: DataFrame,
    value: str,
    shares: list[float],
    group: list[str] = [],
    out: str = "q",
    n_ranges: int | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles of a (group, value, _n) table.

    One array column `out` per group, in the order of `shares`, plus the row count `_rows`. Only
    the value ranges in which a wanted rank falls, two per share and group at most, are shuffled
    and sorted; groups are bounded lists (features, classes, terms), so that list is broadcast.
    """
    ranged = add_ranges(counts, value, n_ranges or max(128, _range_count(counts)))
    offsets = _range_offsets(ranged, ["_n"], group)
    places = [f"(_n_total - 1) * {float(share)!r}D" for share in shares]
    positions = F.expr(f"array({', '.join(f'floor({p}), ceil({p})' for p in places)})")
    end = F.col("_o__n") + F.col("_t__n")
    wanted = F.exists(positions, lambda k: (k >= F.col("_o__n")) & (k < end))
    placed = _join_ranges(ranged, F.broadcast(offsets.where(wanted)), group)
    ranked = _add_before(placed, value, ["_n"], group).withColumnRenamed("_n_total", "_rows")
    places = [f"(_rows - 1) * {float(share)!r}D" for share in shares]

    def at(position: str) -> str:
        inside = f"_n_before <= {position} AND {position} < _n_before + _n"
        return f"max(CASE WHEN {inside} THEN CAST(`{value}` AS DOUBLE) END)"

    picked = ranked.groupBy(*group).agg(
        F.max("_rows").alias("_rows"),
        F.expr(f"array({', '.join(at(f'floor({p})') for p in places)})").alias("_lo"),
        F.expr(f"array({', '.join(at(f'ceil({p})') for p in places)})").alias("_hi"),
    )
    spread = F.expr(f"array({', '.join(f'{p} - floor({p})' for p in places)})")
    bounds = F.arrays_zip(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), spread.alias("t"))

    def blend(b: Column) -> Column:
        lo, hi, t = b["lo"], b["hi"], b["t"]
        return F.when(t >= 0.5, hi - (hi - lo) * (1 - t)).otherwise(lo + (hi - lo) * t)

    return picked.withColumn("_b", bounds).select(*group, "_rows", F.transform("_b", blend).alias(out))
