"""Merkle manifest of a table: leaf digests, sub-roots per group, a root, and a proof for every row.

Each row is a leaf. Per group, leaves ascend by key; while several nodes remain, each run of `fan`
consecutive ones becomes the digest of their digests. The nodes left over, one per group and in the order
of the groups, are combined to the root in the same way. A proof is the siblings of a leaf and of all
nodes above it, left to right and upwards.

The tree is worked on by time-forward processing. A node is labelled (level, index) in its group, and its
digest is a message to the label of its parent. Messages wait in a priority queue ordered by label; the
queue is external: the engine's sorted shuffle, which spills, brings the messages of a block of fan ** 3
labels together in order, and within a block a heap of at most that many messages delivers them, level
after level. A sweep sends one message per block to the next sweep, so three sweeps serve 10^10 leaves of
a group. The reversed sweep walks the same blocks from the root down and hands each node the proof suffix
of its parent, extended by its own siblings; at the leaves the proof is complete.

A group may hold any share of the rows: leaves are ranked by ranges of (group, key) with one offset per
range, and blocks have a fixed size.

Cases: a null value is `-` in its leaf; null groups are one group, the first; null keys come first; rows
of one key are ordered by leaf digest, and equal rows get equal leaves at places of their own; texts of any
length are digested by the engine; an empty table gives an empty result; other input columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm import batches
from lakemill.session import durable

FAN = 16
#: Levels of the tree that a block spans.
LEVELS = 3


def leaf(columns: dict[str, Column]) -> Column:
    """Digest of a row: byte count, colon and value of each column, `-` for null."""
    parts = []
    for column in columns.values():
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Block:
    """The messages of one block and the nodes they lead to.

    whole: the block's one root is a node of a larger tree, so exactly `LEVELS` levels are built;
    else the block is all that is left of its group, and levels are built until one node remains.
    """

    def __init__(self, messages: list[tuple[int, str]], base: int, fan: int, whole: bool) -> None:
        self.fan = fan
        self.runs: dict[tuple[int, int], list[str]] = {}
        queue = [(0, at - base, digest) for at, digest in messages]
        heapq.heapify(queue)
        top = LEVELS if whole else None
        while queue[0][0] != top and (top is not None or len(queue) > 1):
            level, at, digest = heapq.heappop(queue)
            run = [digest]
            while queue and queue[0][0] == level and queue[0][1] // fan == at // fan:
                run.append(heapq.heappop(queue)[2])
            self.runs[level + 1, at // fan] = run
            heapq.heappush(queue, (level + 1, at // fan, _digest(run)))
        self.level, _, self.digest = queue[0]

    def suffixes(self, above: list[tuple[str, str]]) -> Iterator[tuple[int, list[tuple[str, str]]]]:
        """(place, siblings upwards) of each message, by the reversed sweep: labels descend, and each node
        hands its children what it was handed itself."""
        waiting = {(self.level, 0): above}
        for label in sorted(self.runs, reverse=True):
            level, index = label
            run, suffix = self.runs[label], waiting.pop(label)
            for slot in range(len(run)):
                waiting[level - 1, index * self.fan + slot] = [("".join(run[:slot]), "".join(run[slot + 1 :])), *suffix]
        for (_, at), suffix in waiting.items():
            yield at, suffix


def folded(digest: str, suffix: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in suffix:
        digest = _digest([left, digest, right])
    return digest


def _text(suffix: list[tuple[str, str]]) -> str:
    return ";".join(f"{left}|{right}" for left, right in suffix)


def _pairs(text: str) -> list[tuple[str, str]]:
    return [tuple(level.split("|")) for level in text.split(";")] if text else []


def _blocks(rows: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """Rows of one block after the other; blocks follow each other in order."""
    held: list[tuple] = []
    for batch in rows:
        for row in zip(*(batch.column(n).to_pylist() for n in names)):
            if held and row[:2] != held[-1][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _up(fan: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = fan**LEVELS
        for held in _blocks(rows, ["g", "block", "at", "n", "digest"]):
            g, block, _, n, _ = held[0]
            root = Block([(r[2], r[4]) for r in held], block * size, fan, n > size).digest
            yield pa.RecordBatch.from_pylist([{"g": g, "at": block, "n": -(-n // size), "digest": root}], _NODE)

    return run


_NODE = pa.schema([("g", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_TOLD = pa.schema([("g", pa.int64()), ("at", pa.int64()), ("suffix", pa.string())])


def _down(fan: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _blocks(rows, ["g", "block", "at", "n", "digest", "suffix"]):
            base, block = held[0][1] * fan**LEVELS, _block_of(held, fan)
            out = [{"g": held[0][0], "at": base + at, "suffix": _text(s)} for at, s in block.suffixes(_pairs(held[0][5]))]
            yield pa.RecordBatch.from_pylist(out, _TOLD)

    return run


def _block_of(held: list[tuple], fan: int) -> Block:
    """held[0] is the suffix of the block, the rest its messages."""
    base, n = held[0][1] * fan**LEVELS, held[1][3]
    return Block([(r[2], r[4]) for r in held[1:]], base, fan, n > fan**LEVELS)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add `at`, the place of each row within its `g` by `order`, and `n`, the rows of `g`.

    Ranges of (g, order) are sorted apart; a row's place is its place in the range plus the rows of its
    group in the ranges before. Rows that agree in all of `order` are told apart by an arbitrary number,
    so that they can be split, too.
    """
    spark = rows.sparkSession
    sides = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = rows.columns
    told = rows.withColumn("_tie", F.monotonically_increasing_id())
    ordered = told.repartitionByRange(sides, "g", *order, "_tie").sortWithinPartitions("g", *order, "_tie").drop("_tie")
    def numbered(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, n = TaskContext.get().partitionId(), None, 0
        for batch in batches_:
            places = []
            for g in batch.column("g").to_pylist():
                n = n + 1 if g == before else 0
                before = g
                places.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())], [*columns, "part", "local"]
            )

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = durable(ordered.mapInArrow(numbered, f"{shape}, part int, local long"), "placed")
    counts = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("m"))
    # One row per group and range of it, so these windows see at most as many rows as there are ranges.
    whole = Window.partitionBy("g")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("g").alias("_g"), F.col("part").alias("_part"), F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("skip"),
        F.sum("m").over(whole).alias("n"),
    )
    placed = placed.join(offsets, (F.col("g") == F.col("_g")) & (F.col("part") == F.col("_part")))
    return durable(placed.select(*columns, (F.col("local") + F.col("skip")).alias("at"), "n"), "ranked")


def _with_block(rows: DataFrame, fan: int) -> DataFrame:
    return rows.withColumn("block", F.floor(F.col("at") / F.lit(fan**LEVELS)).cast("long"))


def _dealt(rows: DataFrame) -> DataFrame:
    """The external queue: messages of a block together, by label."""
    sides = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(sides, "g", "block").sortWithinPartitions("g", "block", F.col("at").asc_nulls_first())


def _risen(leaves: DataFrame, fan: int) -> list[DataFrame]:
    """The messages (g, at, n, digest) of each sweep; a group ends with the sweep in which it is one node."""
    sweeps = [leaves]
    while not (left := sweeps[-1].where("n > 1")).isEmpty():
        up = _dealt(_with_block(left, fan)).mapInArrow(_up(fan), "g long, at long, n long, digest string")
        sweeps.append(durable(up, "nodes"))
    return sweeps


def _tops(sweeps: list[DataFrame]) -> DataFrame:
    """(g, digest): the one node that is left of each group."""
    return reduce(DataFrame.unionByName, [s.where("n = 1").select("g", "digest") for s in sweeps])


def _asked(sweep: DataFrame, told: DataFrame, fan: int) -> DataFrame:
    """Messages of a sweep and, first in each block, what the node that the block leads to is told."""
    told = told.withColumnRenamed("at", "block")
    return _dealt(_with_block(sweep, fan).unionByName(told, allowMissingColumns=True))


def _fallen(sweeps: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """(g, at, suffix) for the blocks of the first sweep; `tops` has (g, suffix) of each group."""

    def own(sweep: DataFrame) -> DataFrame:
        return sweep.where("n = 1").select("g", "at").join(tops, "g").select("g", "at", "suffix")

    told = own(sweeps[-1])
    for k in range(len(sweeps) - 2, -1, -1):
        if k < len(sweeps) - 2:
            left = sweeps[k + 1].where("n > 1")
            told = _asked(left, told, fan).mapInArrow(_down(fan), "g long, at long, suffix string").unionByName(own(sweeps[k + 1]))
            told = durable(told, "suffixes")
    return told.unionByName(own(sweeps[0])) if len(sweeps) > 1 else told


def _prover(fan: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def kept(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches_:
                kind = batch.schema.field("id").type
                yield batch

        for held in _blocks(kept(rows), ["g", "block", "at", "n", "digest", "suffix", "shown", "subroot", "id"]):
            base, block = held[0][1] * fan**LEVELS, _block_of(held, fan)
            of = {r[2] - base: r for r in held[1:]}
            out = []
            for at, suffix in block.suffixes(_pairs(held[0][5])):
                proof = hashlib.sha256("".join(x for pair in suffix for x in pair).encode()).hexdigest()
                out.append((of[at][8], of[at][4], held[0][7], proof, folded(of[at][6], suffix)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind if i == 0 else pa.string()) for i, c in enumerate(zip(*out))],
                ["id", "leaf", "subroot", "proof_sha256", "folded_root"],
            )

    return run


def manifest(
    docs: DataFrame, columns: list[str], group: str = "source", key: str = "doc_id", shown: dict[str, Column] | None = None, fan: int = FAN,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    `shown` replaces columns of the rows as they are presented for checking; a presented row is verified
    if its leaf and the stored siblings lead to the root.
    """
    batches.small(docs.sparkSession)
    stored = {c: F.col(c) for c in columns}
    rows = durable(
        docs.select(
            F.col(key).alias("id"), F.col(group).cast("string").alias("name"), leaf(stored).alias("digest"),
            leaf(stored | (shown or {})).alias("shown"),
        ),
        "leaves",
    )
    # Groups get numbers in their order: null first, then by bytes.
    names = rows.select("name").distinct().select(F.lit(0).cast("long").alias("g"), "name")
    numbers = ranked(names, ["name"]).select(F.col("name").alias("_name"), F.col("at").alias("g"), "n")
    rows = rows.join(numbers, F.col("name").eqNullSafe(F.col("_name"))).select("g", "id", "digest", "shown")
    leaves = ranked(rows, ["id", "digest"])
    sweeps = _risen(leaves.select("g", "at", "n", "digest"), fan)
    tops = durable(_tops(sweeps), "subroots")
    forest = numbers.select("g", "n").join(tops, "g").select(F.lit(0).cast("long").alias("g"), F.col("g").alias("at"), "n", "digest")
    upper = _risen(durable(forest, "forest"), fan)
    root = _tops(upper).head()
    above = _fallen(upper, upper[-1].where("n = 1").select("g", F.lit("").alias("suffix")), fan)
    above = _asked(upper[0], above, fan).mapInArrow(_down(fan), "g long, at long, suffix string")
    tops = durable(above.select(F.col("at").alias("g"), "suffix").join(tops, "g"), "told").withColumnRenamed("digest", "subroot")
    told = _fallen(sweeps, tops.select("g", "suffix"), fan).join(tops.select("g", "subroot"), "g")
    proved = _asked(leaves, told, fan).mapInArrow(
        _prover(fan), f"id {docs.schema[key].dataType.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string"
    )
    rooted = proved.withColumn("root", F.lit(root[1] if root else None).cast("string"))
    return rooted.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", key)
