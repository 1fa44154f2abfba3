"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 20


def about(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """About `bound` of the rows, or all if there are no more; the same ones on every run.

    A row is in or out by a hash of its key, so nothing is sorted or gathered to choose.
    """
    total = rows.count()
    if total <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(_PARTS)) < int(_PARTS * bound / total))


def evenly(rows: DataFrame, key: Column, group: str, bound: int) -> DataFrame:
    """About `bound` of the rows, or all if there are no more: small groups whole, of the others equally many.

    Groups are few, such as languages: one count of each comes to the driver. Rows without a group are left out.
    """
    sizes = {r[group]: r["count"] for r in rows.where(F.col(group).isNotNull()).groupBy(group).count().collect()}
    if sum(sizes.values()) <= bound:
        return rows.where(F.col(group).isNotNull())
    rates, left = {}, bound
    for k, (name, size) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        taken = min(size, left / (len(sizes) - k))
        rates[name], left = int(_PARTS * taken / size), left - taken
    rate = F.create_map(*(F.lit(x) for pair in rates.items() for x in pair))
    return rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(_PARTS)) < rate[F.col(group)])


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts
