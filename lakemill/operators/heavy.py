"""Exact top lists from bounded candidates.

Counting every distinct token to find the twenty most frequent shuffles a row per token and task. Here each
task keeps a bounded number of counters (space saving by subtraction): when there are more, the smallest
counts are taken off all of them, and the sum taken off is the most that any count can be short by. A token
can be among the first n only if its counted uses plus all that was taken off reach the n-th largest count;
these few are counted exactly in a second pass, which drops every other token before its shuffle.

A token that no task has kept was used at most as often as was taken off in total. While that is less than
the n-th count nothing can be missed; otherwise the list is made by counting everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.session import durable

#: Counters of a task and group.
CAPACITY = 20_000
#: Candidates that may be sent to every task; more of them are joined as a table.
BROADCAST = 100_000


class Counters:
    """At most `capacity` counters; `off` is what any count may be short by."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.off = capacity, 0
        self.counts: dict = {}

    def add(self, values: list, numbers: list[int]) -> None:
        counts = self.counts
        for value, n in zip(values, numbers):
            counts[value] = counts.get(value, 0) + n
        if len(counts) > self.capacity:
            least = sorted(counts.values(), reverse=True)[self.capacity]
            self.off += least
            self.counts = {v: n - least for v, n in counts.items() if n > least}


def _counter(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        kind = None
        for batch in batches:
            kind = batch.schema
            tokens, group = batch.column("tokens"), batch.column("grp")
            flat = tokens.flatten()
            owner = group.take(pc.list_parent_indices(tokens))
            for name in pc.unique(owner).to_pylist():
                own = flat.filter(pc.equal(owner, name) if name is not None else pc.is_null(owner))
                found = pc.value_counts(own)
                counters = held.setdefault(name, Counters(capacity))
                counters.add(found.field("values").to_pylist(), found.field("counts").to_pylist())
        for name, counters in held.items():
            values = [None, *counters.counts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(values), kind.field("grp").type), pa.array(values, kind.field("tokens").type.value_type),
                    pa.array([counters.off, *counters.counts.values()], pa.int64()),
                ],
                ["grp", "token", "n"],
            )

    return run


def top(rows: DataFrame, tokens: Column, n: int, group: Column | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(grp, token, n_uses, place): the n most frequent tokens of each group, ties by token; null tokens do
    not count. `rows` is read twice, so write it first if it is costly."""
    listed = rows.select((F.lit(0) if group is None else group).alias("grp"), F.filter(tokens, lambda t: t.isNotNull()).alias("tokens"))
    kinds = dict(listed.dtypes)
    token_kind = kinds["tokens"].removeprefix("array<").removesuffix(">")
    counted = (
        listed.where(F.size("tokens") > 0).mapInArrow(_counter(capacity), f"grp {kinds['grp']}, token {token_kind}, n long")
        .groupBy("grp", "token").agg(F.sum("n").alias("n"))
    )
    counted = durable(counted, "counters")
    whole = Window.partitionBy("grp")
    off = counted.where("token IS NULL").select("grp", F.col("n").alias("off"))
    ranked = counted.where("token IS NOT NULL").withColumn("_r", F.row_number().over(whole.orderBy(F.desc("n"))))
    # One row per group: the n-th largest of the counts that are certain, none with fewer counters.
    bounds = ranked.where(F.col("_r") == n).select(F.col("grp").alias("_b"), F.col("n").alias("nth"))
    bounds = off.join(bounds, F.col("grp").eqNullSafe(F.col("_b")), "left").select(F.col("grp").alias("_g"), "off", "nth")
    missed = bounds.where((F.col("off") > 0) & (F.coalesce("nth", F.lit(0)) <= F.col("off")))
    exploded = listed.select("grp", F.explode("tokens").alias("token"))
    if missed.isEmpty():
        near = counted.where("token IS NOT NULL").join(bounds, F.col("grp").eqNullSafe(F.col("_g")))
        near = near.where(F.col("n") + F.col("off") >= F.coalesce("nth", F.lit(0))).select(F.col("grp").alias("_g"), F.col("token").alias("_t"))
        few = near.limit(BROADCAST + 1).count() <= BROADCAST
        kept = F.broadcast(near) if few else near
        exploded = exploded.join(kept, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("token") == F.col("_t")), "left_semi")
    uses = exploded.groupBy("grp", "token").agg(F.count(F.lit(1)).alias("n_uses"))
    placed = uses.withColumn("place", F.row_number().over(whole.orderBy(F.desc("n_uses"), "token")))
    return placed.where(F.col("place") <= n)
