"""Small numeric column builders."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round the scaled double half to even, as array libraries do (`round` is half up)."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def at_least_one(value: Column) -> Column:
    return F.greatest(value, F.lit(1))


def share(condition: Column, digits: int = 4) -> Column:
    """Aggregate: share of rows that satisfy `condition`; null counts as not satisfied."""
    return half_even(F.avg(F.coalesce(condition, F.lit(False)).cast("double")), digits)


def safe_div(a: Column, b: Column, default: float = 0.0) -> Column:
    """a / b, or `default` where b is zero."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(default))


def seeded_int(key: Column, seed: int, start: int) -> Column:
    """32-bit value from eight hex digits of md5(key|seed), the same on every engine and run."""
    digest = F.md5(F.concat(key, F.lit(f"|{seed}")).cast("binary"))
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def erfc(x: Column, terms: int = 120) -> Column:
    """Complementary error function of x >= 0 by the all-positive series of erf."""
    # erf(x) = 2/sqrt(pi) * exp(-x^2) * sum_n 2^n x^(2n+1) / (2n+1)!!
    x2 = x * x
    start = F.struct(x.alias("term"), x.alias("total"))

    def step(acc: Column, n: Column) -> Column:
        term = acc["term"] * 2.0 * x2 / (2.0 * n + 1.0)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), start, step, lambda acc: acc["total"])
    tail = F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-x2) * series
    return F.when(x > 6.0, F.lit(0.0)).otherwise(F.greatest(tail, F.lit(0.0)))


def kolmogorov_p(lam: Column, terms: int = 100) -> Column:
    """Two-sided tail of the Kolmogorov distribution, 2 * sum (-1)^(k-1) exp(-2 k^2 lam^2)."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * k * k * lam * lam),
    )
    p = F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0))
    # Below 0.2 the tail is 1 to twelve digits and the series converges too slowly.
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)
