"""N-gram Jaccard join by MinHash banding.

Every distinct text is a node with the set of its word shingles (five words, lower-cased). Row and
band counts follow from the wanted recall at the threshold. Nodes meet in the buckets of their band
hashes, and every pair that meets is verified on the full shingle sets, once:

* A bucket of ordinary size is one unit of work. A pair belongs to the first band it shares, so no
  pair is looked at twice; buckets whose members all met in an earlier one are left out.
* Buckets above `hot` members that share nodes are merged into one group. A group is cut into
  blocks of about `block` nodes, and every pair of blocks is one unit, so that no task ever holds a
  whole group and each pair of the group is again looked at once.

Units return per node the number of its links and the smallest node it is linked with inside the
unit; links themselves are never written out. The classes are the components of those edges.
The work on a group of many different near copies is the number of its pairs, as a count of exact
links demands; its output stays one row per node and unit.

Cases: null texts and texts without a word have no shingles, so each such row is a class of its own
with no links; texts under five words have one shingle, all their words; equal texts are one node
and never count as links; repeated rows come back repeated; ties go to the smallest doc_id; a null
doc_id never names a class that has another one; other input columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm import batches
from lakemill.llm.columns import spare
from lakemill.llm.graph import components
from lakemill.llm.words import Words, mixed, release, shingle_sets, steps
from lakemill.session import durable

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99999


def banding(threshold: float = THRESHOLD, recall: float = RECALL, budget: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows for which enough bands for the recall fit into `budget` hashes."""
    best = (budget, 1)
    for rows in range(1, budget):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > budget:
            break
        best = (bands, rows)
    return best


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return (seeds[:n] | np.uint64(1)).astype(np.uint32) | np.uint32(1), seeds[n:].astype(np.uint32)


def minhashes(text: np.ndarray, shingle: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts with shingles, band hashes of each), from shingle rows sorted by text."""
    held, first = np.unique(text, return_index=True)
    out = np.zeros((len(held), bands), dtype=np.uint64)
    if not len(held):
        return held, out
    x = (shingle >> np.uint64(32)).astype(np.uint32)
    factor, shift = _factors(bands * rows)
    work = np.empty_like(x)
    for band in range(bands):
        total = np.full(len(held), band + 1, dtype=np.uint64)
        for row in range(rows):
            k = band * rows + row
            np.multiply(x, factor[k], out=work)
            work += shift[k]
            total = mixed(total) + np.minimum.reduceat(work, first)
        out[:, band] = mixed(total)
    return held, out


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _signature(bands: int, rows: int, size: int, with_set: bool):
    """UDF: band hashes of a text (empty without words) and, if asked for, its sorted shingle set."""
    kind = [T.StructField("bands", T.ArrayType(T.LongType()))]
    if with_set:
        kind.append(T.StructField("grams", T.ArrayType(T.LongType())))

    @F.arrow_udf(T.StructType(kind))
    def signature(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in column:
            parts = []
            for step in steps(array):
                text, shingle = shingle_sets(Words.of(step, lower="all"), size)
                held, hashes = minhashes(text, shingle, bands, rows)
                n = np.zeros(len(step), dtype=np.int64)
                n[held] = bands
                fields = [_lists(hashes.reshape(-1).view(np.int64), n)]
                if with_set:
                    fields.append(_lists(shingle.view(np.int64), np.bincount(text, minlength=len(step))))
                parts.append(pa.StructArray.from_arrays(fields, [f.name for f in kind]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(f.name, pa.list_(pa.int64())) for f in kind]))
        release()

    return signature


def _overlaps(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all sets with all others (with each other if None).

    Only shingles held twice or more can be shared; they become the columns of 0/1 matrices that
    are multiplied a slice at a time, so memory stays with the number of sets.
    """
    both = sets + (others or [])
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    column, owner = number[column[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    n, width = len(sets), 2048
    out = np.zeros((n, len(others) if others is not None else n), dtype=np.float32)
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        held = np.zeros((len(both), width), dtype=np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held[:n] @ (held[n:] if others is not None else held).T
    return out


def _similar(inter: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets of sizes a and b with these intersections are similar, some rows at a time."""
    out = np.zeros(inter.shape, dtype=bool)
    for low in range(0, len(a), 256):
        part = inter[low : low + 256].astype(np.float64)
        out[low : low + 256] = part >= threshold * (a[low : low + 256, None] + b[None, :] - part) - 1e-6
    return out


def _local_components(linked: np.ndarray) -> np.ndarray:
    label = np.arange(len(linked), dtype=np.int32)
    last = np.int32(len(label))
    while True:
        low = np.concatenate([np.where(linked[k : k + 256], label[None, :], last).min(axis=1) for k in range(0, len(label), 256)])
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Unit:
    """One unit of work: its nodes, in node order, without repeats."""

    def __init__(self, rows: list[tuple], threshold: float) -> None:
        seen: dict[tuple, tuple] = {(r[0], r[3]): r for r in rows}
        rows = [seen[k] for k in sorted(seen)]
        self.nodes = [r[0] for r in rows]
        self.sets = [r[1] for r in rows]
        self.rows = rows
        self.threshold = threshold

    def linked(self, band: int, left: int, right: int) -> np.ndarray:
        """Matrix of the links that this unit owns."""
        n = len(self.rows)
        size = np.array([len(s) for s in self.sets], dtype=np.float64)
        if band < 0 and left != right:
            side = np.array([r[3] for r in self.rows])
            a, b = np.flatnonzero(side == left), np.flatnonzero(side == right)
            out = np.zeros((n, n), dtype=bool)
            if len(a) and len(b):
                inter = _overlaps([self.sets[i] for i in a], [self.sets[i] for i in b])
                out[np.ix_(a, b)] = hit = _similar(inter, size[a], size[b], self.threshold)
                out[np.ix_(b, a)] = hit.T
            return out
        out = _similar(_overlaps(self.sets), size, size, self.threshold)
        if band >= 0:
            group = np.array([r[2] for r in self.rows], dtype=np.int64)
            met = (group[:, None] == group[None, :]) & (group != 0)[:, None]
            for earlier in range(band):
                values = np.array([r[4][earlier] for r in self.rows], dtype=np.int64)
                met |= values[:, None] == values[None, :]
            out &= ~met
        np.fill_diagonal(out, False)
        return out


def _verify(threshold: float):
    """Rows of a partition come sorted by unit; one output row per node with links in a unit."""
    schema = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def result(unit: tuple, rows: list[tuple]) -> pa.RecordBatch | None:
        work = _Unit(rows, threshold)
        if len(work.nodes) < 2:
            return None
        linked = work.linked(*unit[1:])
        links = linked.sum(axis=1)
        held = np.flatnonzero(links)
        if not len(held):
            return None
        label = _local_components(linked)
        return pa.record_batch(
            [
                pa.array([work.nodes[i] for i in held], pa.binary()),
                pa.array(links[held].astype(np.int64)),
                pa.array([work.nodes[label[i]] for i in held], pa.binary()),
            ],
            schema=schema,
        )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("key", "band", "left", "right")))
            grams = batch.column("grams")
            flat, at = grams.flatten().to_numpy(), np.concatenate([[0], np.cumsum(grams.value_lengths().to_numpy())])
            bands = batch.column("bands")
            wide = bands.flatten().to_numpy().reshape(len(batch), -1)
            extra = zip(batch.column("node").to_pylist(), batch.column("group").to_pylist(), batch.column("side").to_pylist())
            for i, (key, (node, group, side)) in enumerate(zip(keys, extra)):
                if key != unit:
                    if len(rows) > 1 and (found := result(unit, rows)):
                        yield found
                    unit, rows = key, []
                rows.append((node, flat[at[i] : at[i + 1]].copy(), group, side, wide[i].copy()))
        if len(rows) > 1 and (found := result(unit, rows)):
            yield found
        rows = []
        release()

    return verify


def _hot_groups(shared: DataFrame, hot: int, block: int) -> DataFrame:
    """(node, group, n_blocks) of the nodes in buckets above `hot` members."""
    edges = shared.where(F.col("n") > hot).select("node", F.col("bucket").alias("a"), F.xxhash64("node").alias("b"))
    labels = components(edges.select("a", "b"), "hot")
    nodes = edges.select("node", F.col("b").alias("id")).distinct().join(labels, "id").select("node", F.col("label").alias("group"))
    sizes = nodes.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("n_blocks"))
    return nodes.join(sizes, "group")


def _node(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
    size: int = SHINGLE, hot: int = 128, block: int = 2048, with_node: bool = False,
) -> DataFrame:
    """(key, class_id, n_links, chosen) per input row; with_node adds the digest of the text.

    class_id is the smallest key of the class; n_links counts the other texts whose shingle sets
    have a Jaccard similarity of at least `threshold` with this one's; chosen is true for the rows
    of one text and key of each class.
    """
    batches.small(docs.sparkSession)
    bands, rows = banding(threshold, recall)
    sign = _signature(bands, rows, size, with_set=False)
    given = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    signed = durable(
        given.select("id", _node(F.col("text")).alias("node"), sign("text").alias("s")).select("id", "node", "s.bands"),
        "signed",
    )
    filled = F.size("bands") > 0
    nodes = durable(
        signed.where(filled).groupBy("node").agg(F.min("id").alias("low"), F.first("bands").alias("bands")), "nodes"
    )
    slots = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    sizes = slots.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = durable(slots.join(sizes, "bucket"), "shared")

    grouped = durable(_hot_groups(shared, hot, block), "grouped")
    # Nodes with their ordinary buckets in band order; a bucket whose members all met before is left out.
    lists = (
        shared.where(F.col("n") <= hot).groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("band", "bucket", "n"))).alias("slots"))
        .join(grouped.select("node", "group"), "node", "left")
    )
    placed = lists.select(
        "node", "group", F.col("slots")[0]["bucket"].alias("head"), F.col("slots").alias("all"), F.posexplode("slots").alias("i", "slot")
    ).select(
        "node", "group", "head", F.col("slot.band").alias("band"), F.col("slot.bucket").alias("bucket"), F.col("slot.n").alias("n"),
        F.expr("IF(i > 0, all[i - 1].bucket, NULL)").alias("before"),
    )
    placed = durable(placed, "placed")
    met = placed.groupBy("bucket").agg(
        *[f(c).alias(f"{c}_{f.__name__}") for c in ("head", "before", "group") for f in (F.min, F.max)],
        F.count("before").alias("c_before"), F.count("group").alias("c_group"), F.max("n").alias("n"),
    )
    open_ = met.where(
        ~(
            ((F.col("head_min") == F.col("head_max")) & (F.col("head_min") != F.col("bucket")))
            | F.coalesce((F.col("before_min") == F.col("before_max")) & (F.col("c_before") == F.col("n")), F.lit(False))
            | F.coalesce((F.col("group_min") == F.col("group_max")) & (F.col("c_group") == F.col("n")), F.lit(False))
        )
    ).select("bucket")
    cold = placed.join(open_, "bucket").select(
        "node", F.col("bucket").alias("key"), "band", F.lit(0).alias("left"), F.lit(0).alias("right"),
        F.coalesce("group", F.lit(0)).alias("group"), F.lit(0).alias("side"),
    )
    side = F.pmod(F.xxhash64("node", F.lit("block")), F.col("n_blocks")).cast("int")
    heated = (
        grouped.withColumn("side", side)
        .withColumn("other", F.explode(F.expr("sequence(0, n_blocks - 1)")))
        .select(
            "node", F.col("group").alias("key"), F.lit(-1).alias("band"), F.least("side", "other").alias("left"),
            F.greatest("side", "other").alias("right"), "group", "side",
        )
    )
    units = durable(cold.unionByName(heated), "units")

    # The texts of the nodes that have company, once each, and their sets.
    wanted = units.select("node").distinct().join(nodes.select("node", "low"), "node")
    full = _signature(bands, rows, size, with_set=True)
    chosen = (
        given.withColumn("node", _node(F.col("text"))).alias("d")
        .join(wanted.alias("w"), (F.col("d.node") == F.col("w.node")) & F.col("d.id").eqNullSafe(F.col("w.low")), "left_semi")
    )
    sets = chosen.select("node", full("text").alias("s")).select("node", "s.bands", "s.grams")
    work = units.join(sets, "node").select("key", "band", "left", "right", "node", "group", "side", "bands", "grams")
    linked = durable(
        work.repartition("key", "band", "left", "right").sortWithinPartitions("key", "band", "left", "right")
        .mapInArrow(_verify(threshold), "node binary, links long, root binary"),
        "linked",
    )
    labels = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), "classes")
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        labels.withColumnRenamed("id", "node").join(nodes.select("node", "low"), "node").join(counts, "node")
    )
    best = known.groupBy("label").agg(F.min(F.struct(F.col("low").isNull().alias("none"), "low", "node")).alias("best"))
    known = known.join(best, "label").select("node", "links", "best.low", F.col("best.node").alias("first"))
    alone = nodes.select("node", F.col("low").alias("own"))
    found = alone.join(known, "node", "left").select(
        "node", F.coalesce("links", F.lit(0)).alias("links"),
        F.when(F.col("first").isNull(), F.col("own")).otherwise(F.col("low")).alias("low"),
        F.coalesce("first", "node").alias("first"),
    )
    out = signed.withColumn("linkable", filled).select("id", "node", "linkable").join(
        found.withColumnRenamed("node", "n"), F.col("linkable") & (F.col("node") == F.col("n")), "left"
    )
    return out.select(
        F.col("id").alias(key),
        F.when(F.col("linkable"), F.col("low")).otherwise(F.col("id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        (~F.col("linkable") | ((F.col("node") == F.col("first")) & F.col("id").eqNullSafe(F.col("low")))).alias("chosen"),
        *(["node"] if with_node else []),
    )


def one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The input rows without near duplicates: one of each class, all columns kept."""
    name = spare(docs, "_kept")
    kept = classes(docs, key, text, with_node=True, **options).where("chosen").select(F.struct(key, "node").alias(name))
    rows = docs.withColumn(name, F.struct(F.col(key), _node(F.col(text)).alias("node")))
    return rows.join(kept.distinct(), name, "left_semi").dropDuplicates([name]).select(*docs.columns)
