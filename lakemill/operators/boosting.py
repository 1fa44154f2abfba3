"""Gradient-boosted trees by second-order splits over feature histograms.

Values of each feature are cut into at most 128 bins at its quantiles; an absent cell of a sparse row
has no bin and follows a direction that each split learns. Rows lie in blocks, their cells by feature and
bin, so that sums over a node come out in order and nothing is sorted per pass. Per level of a tree, one job builds the histograms of gradients and second derivatives by (node, feature, bin), adds them
up per share of the features and finds each share's best split of every node; the driver compares one
candidate per share and node. Only the lighter child of a split is built, its sibling is the parent less
it. Blocks carry the margin of each row up to the last refresh; later trees are few and applied on the way.

Hundreds of jobs cost more than the work on a table of some million cells: up to `ALONE_CELLS` all trees grow in
one task, by the same steps. It also holds the cells by row, so that a light child costs its own cells only.

Gain of a split: GL^2 / (HL + l) + GR^2 / (HR + l) - G^2 / (H + l) for sums G of first and H of second
derivatives of the log loss; a leaf weighs -rate * G / (H + l). Gains that agree to seven decimals are
ties, so that the order of additions decides nothing; ties go to the lowest feature, then the lowest bin,
then absent cells on the right.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import blocks as packing
from lakemill.session import durable

BINS = 128
#: Trees between two refreshes of the stored margins.
REFRESH = 10
#: Least gain of a split.
LEAST = 1e-6
#: Cells of a block at most.
BLOCK_CELLS = 1 << 20
#: Cells, at eight bytes each, of a table whose trees all grow in one task.
ALONE_CELLS = 1 << 25
#: Cells of the rows of a node that are added up at a time, and slots that are searched at a time: what stays in
#: a core's cache takes a fraction of the time.
CHUNK_CELLS, CHUNK_SLOTS = 1 << 17, 1 << 15


@dataclass(frozen=True)
class Settings:
    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    ridge: float = 1.0
    least_weight: float = 1.0


@dataclass
class Tree:
    """Nodes in order of growth. `feature` is -1 in a leaf; a present cell of bin (or value) up to the cut
    goes left, others right, absent cells left where `absent` is set."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    absent: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    weight: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: float, absent: bool) -> tuple[int, int]:
        low = len(self.feature)
        self.feature[node], self.cut[node], self.absent[node], self.left[node] = feature, cut, absent, low
        for _ in range(2):
            for column, value in zip((self.feature, self.cut, self.absent, self.left, self.weight), (-1, 0.0, False, -1, 0.0)):
                column.append(value)
        return low, low + 1

    def nodes(self, columns: Columns | Cells) -> np.ndarray:
        """The leaf each row ends in. Children stand behind their parents, so one walk over the nodes does."""
        at, goes = np.zeros(columns.rows, np.int64), np.empty(columns.rows, bool)
        held = {0: np.arange(columns.rows)}
        for node, feature in enumerate(self.feature):
            if feature < 0:
                continue
            here = held.pop(node)
            goes[here] = self.absent[node]
            row, value = columns.of(feature)
            goes[row] = value <= self.cut[node]
            side, low = goes[here], self.left[node]
            held[low], held[low + 1] = here[side], here[~side]
        for node, rows in held.items():
            at[rows] = node
        return at

    def margins(self, columns: Columns | Cells) -> np.ndarray:
        return np.array(self.weight)[self.nodes(columns)]


@dataclass
class Columns:
    """Cells by column: `feature[k]` has the cells first[k]:first[k + 1]."""

    rows: int
    feature: np.ndarray
    first: np.ndarray
    row: np.ndarray
    value: np.ndarray

    @classmethod
    def of_rows(cls, rows: packing.Rows) -> Columns:
        order = np.argsort(rows.feature, kind="stable")
        feature, first = np.unique(rows.feature[order], return_index=True)
        return cls(len(rows), feature, np.append(first, len(order)), rows.owner()[order], rows.value[order])

    def of(self, feature: int) -> tuple[np.ndarray, np.ndarray]:
        k = int(np.searchsorted(self.feature, feature))
        if k == len(self.feature) or self.feature[k] != feature:
            return self.row[:0], self.value[:0]
        cut = slice(self.first[k], self.first[k + 1])
        return self.row[cut], self.value[cut]


@dataclass
class Cells:
    """Binned cells by (feature, bin): `slot[k]`, feature << 8 | bin, has the rows row[first[k]:first[k + 1]]."""

    rows: int
    slot: np.ndarray
    first: np.ndarray
    row: np.ndarray

    @classmethod
    def of_bins(cls, columns: Columns, bins: np.ndarray) -> Cells:
        key = np.repeat(columns.feature.astype(np.int64), np.diff(columns.first)) << 8 | bins
        order = np.argsort(key, kind="stable")
        slot, first = np.unique(key[order], return_index=True)
        return cls(columns.rows, slot, np.append(first, len(order)).astype(np.int32), columns.row[order].astype(np.int32))

    def of(self, feature: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.searchsorted(self.slot, [feature << 8, (feature + 1) << 8])
        bins = np.repeat(self.slot[low:high] & 0xFF, np.diff(self.first[low : high + 1]))
        return self.row[self.first[low] : self.first[high]], bins


def cut_points(df: DataFrame, features: str = "features", bins: int = BINS) -> dict[int, np.ndarray]:
    """Upper bounds of the bins of each feature, from its present values; the last bin has none.

    The driver holds at most bins - 1 numbers per feature of the model."""
    v = F.unwrap_udt(features)
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    cells = df.select(F.explode(F.arrays_zip(places.alias("i"), v["values"].alias("x"))).alias("c")).where("c.x <> 0")
    shares = ", ".join(f"{k / bins!r}D" for k in range(1, bins))
    rows = cells.groupBy("c.i").agg(F.expr(f"percentile_approx(c.x, array({shares}), {100 * bins})").alias("cuts"))
    return {r["i"]: np.unique(r["cuts"]) for r in rows.collect()}


_BINNED = "y binary, margin binary, slot binary, first binary, row binary"


def _binner(cuts, base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in packing.read(batch):
                columns = Columns.of_rows(rows)
                bins = np.empty(len(columns.value), np.uint8)
                for k, feature in enumerate(columns.feature.tolist()):
                    cut = slice(columns.first[k], columns.first[k + 1])
                    bins[cut] = np.searchsorted(cuts.value[feature], columns.value[cut]) if feature in cuts.value else 0
                yield _row(rows.y, np.full(len(rows), base), Cells.of_bins(columns, bins))

    return run


def _row(y: np.ndarray, margin: np.ndarray, cells: Cells) -> pa.RecordBatch:
    parts, names = [y, margin, cells.slot, cells.first, cells.row], ["y", "margin", "slot", "first", "row"]
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts], names)


def _binned(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, Cells]]:
    kinds = {"y": np.float64, "margin": np.float64, "slot": np.int64, "first": np.int32, "row": np.int32}
    for k in range(batch.num_rows):
        y, margin, slot, first, row = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in kinds.items())
        yield y, margin, Cells(len(y), slot, first, row)


def _refreshed(trees: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, margin, cells in _binned(batch):
                yield _row(y, margin + sum(t.margins(cells) for t in trees), cells)

    return run


#: A histogram: cells (node, feature, bin) packed into one number, and their sums.
_CELL = np.dtype([("key", "<i8"), ("g", "<f8"), ("h", "<f8")])
_TOTALS, _STORED, _BUILT = 0, 1, 2
_SENT = "kind int, part int, cells binary"


def _keyed(node: np.ndarray, feature: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return (node.astype(np.int64) << 40) | (feature.astype(np.int64) << 8) | bins


def _merged(key: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(key):
        return np.zeros(0, _CELL)
    # Mostly a few sorted runs, which a stable sort only merges.
    order = np.argsort(key, kind="stable")
    return _added(key[order], g[order], h[order])


def _added(key: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sums of the cells of equal key; keys ascend."""
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    out = np.empty(len(begin), _CELL)
    out["key"], out["g"], out["h"] = key[begin], np.add.reduceat(g, begin), np.add.reduceat(h, begin)
    return out


def _of_block(tree: Tree, built: list[int], y: np.ndarray, margin: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """The histograms of the nodes in `built`, and the totals of all rows."""
    p = 1 / (1 + np.exp(-margin))
    g, h = p - y, p * (1 - p)
    names = sorted(built)
    # Place of a row's node among the built ones; the others come last and are cut off.
    places = np.full(len(tree.feature), len(names), np.int16)
    places[names] = np.arange(len(names))
    place = places[tree.nodes(cells)][cells.row]
    held = np.flatnonzero(place < len(names))
    if len(names) > 1:
        held = held[np.argsort(place[held], kind="stable")]
    total = np.array([g.sum(), h.sum()])
    if not len(held):
        return np.zeros(0, _CELL), total
    row = cells.row[held]
    slot = np.repeat(cells.slot, np.diff(cells.first))[held]
    return _added(np.array(names, np.int64)[place[held]] << 40 | slot, g[row], h[row]), total


def _names(spark: SparkSession, parts: int) -> list[int]:
    """Names for the shares of the features, each of which goes to a partition of its own."""
    own = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts))
    return sorted(r["id"] for r in spark.range(100 * parts).groupBy(own.alias("own")).agg(F.min("id").alias("id")).collect())


def _histograms(trees: list[Tree], tree: Tree, built: list[int], parts: list[int]):
    """Histograms of the nodes in `built`, dealt to shares of the features; totals of the first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = [], np.zeros(2)
        for batch in batches:
            for y, margin, columns in _binned(batch):
                for t in trees:
                    margin = margin + t.margins(columns)
                cells, own = _of_block(tree, built, y, margin, columns)
                sums.append(cells)
                total += own
        # Every share needs the totals of the first level.
        yield pa.RecordBatch.from_pydict({"kind": [_TOTALS] * len(parts), "part": parts, "cells": [total.tobytes()] * len(parts)}, _sent)
        if sums:
            cells = np.concatenate(sums)
            cells = _merged(cells["key"], cells["g"], cells["h"]) if len(sums) > 1 else cells
            share = ((cells["key"] >> 8 & 0xFFFFFFFF) % len(parts)).astype(np.int16)
            cells, ends = cells[np.argsort(share, kind="stable")], np.cumsum(np.bincount(share, minlength=len(parts)))
            for k, own in zip(parts, np.split(cells, ends[:-1])):
                if len(own):
                    yield pa.RecordBatch.from_pydict({"kind": [_BUILT], "part": [k], "cells": [own.tobytes()]}, _sent)

    return run


_sent = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("cells", pa.binary())])
_best = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("cells", pa.binary()), ("best", pa.binary())])
_SPLIT = np.dtype([("node", "<i8"), ("gain", "<f8"), ("feature", "<i8"), ("bin", "<i8"), ("absent", "?"), ("gl", "<f8"), ("hl", "<f8")])


def live(cells: np.ndarray, settings: Settings) -> np.ndarray:
    """Without the cells of features too light to part a node: both sides of a split hold `least_weight`, and the
    present cells of a feature are no less than one side. What is too light in a node is so in all below it."""
    if not len(cells):
        return cells
    begin = np.flatnonzero(np.append(True, np.diff(cells["key"] >> 8) != 0))
    kept = np.add.reduceat(cells["h"], begin) >= settings.least_weight - 1e-6
    return cells if kept.all() else cells[np.repeat(kept, np.diff(np.append(begin, len(cells))))]


def best_splits(cells: np.ndarray, totals: dict[int, tuple[float, float]], settings: Settings) -> np.ndarray:
    """The best split of each node by its histogram; cells are in the order of their keys."""
    if not len(cells):
        return np.zeros(0, _SPLIT)
    key, own_g, own_h = (np.ascontiguousarray(cells[n]) for n in ("key", "g", "h"))
    begin = np.flatnonzero(np.append(True, np.diff(key >> 8) != 0))
    counts = np.diff(np.append(begin, len(key)))
    last = begin + counts - 1
    names = sorted(totals)
    node = key[begin] >> 40
    # What a feature of a node shares is worked out once and repeated for its cells.
    whole = np.array([totals[n] for n in names])[np.searchsorted(names, node)]
    first = begin[np.append(True, node[1:] != node[:-1])]
    ends = np.diff(np.append(first, len(key)))
    g, h = (np.repeat(whole[:, i], counts) for i in (0, 1))
    parent = np.repeat(whole[:, 0] ** 2 / (whole[:, 1] + settings.ridge), counts)
    cg, ch = np.cumsum(own_g), np.cumsum(own_h)
    before_g, before_h = cg[begin] - own_g[begin], ch[begin] - own_h[begin]
    gl, hl = cg - np.repeat(before_g, counts), ch - np.repeat(before_h, counts)
    rest_g, rest_h = whole[:, 0] - (cg[last] - before_g), whole[:, 1] - (ch[last] - before_h)
    out = []
    for absent in (False, True):
        a, b = (gl + np.repeat(rest_g, counts), hl + np.repeat(rest_h, counts)) if absent else (gl, hl)
        right = h - b
        gain = a**2 / (b + settings.ridge) + (g - a) ** 2 / (right + settings.ridge) - parent
        gain[(b < settings.least_weight) | (right < settings.least_weight)] = -np.inf
        # Only what ties for its node's best gain is compared further.
        best = np.maximum.reduceat(gain, first)
        near = np.flatnonzero(gain >= np.repeat(np.maximum(best - 1e-6, LEAST), ends))
        of = np.searchsorted(first, near, "right") - 1
        top = near[(gain[near] > LEAST) & (np.round(gain[near], 7) == np.round(best[of], 7))]
        found = np.zeros(len(top), _SPLIT)
        parts = (key[top] >> 40, gain[top], key[top] >> 8 & 0xFFFFFFFF, key[top] & 0xFF, absent, a[top], b[top])
        for name, value in zip(_SPLIT.names, parts):
            found[name] = value
        out.append(found)
    return strongest(np.concatenate(out))


def strongest(found: np.ndarray) -> np.ndarray:
    """One split per node."""
    order = np.lexsort((found["absent"], found["bin"], found["feature"], -np.round(found["gain"], 7), found["node"]))
    found = found[order]
    return found[np.append(True, found["node"][1:] != found["node"][:-1])] if len(found) else found


def _splitter(siblings: dict[int, tuple[int, int]], totals: dict[int, tuple[float, float]] | None, settings: Settings, last: bool):
    """Add the messages of a share up, take children from their parents, and look for splits.

    siblings: parent -> (built child, other child). totals: sums of each node, None in the first level,
    where they come with the messages. The last level has no children to take from its histograms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new: dict[int, list[bytes]] = {}
        old: dict[int, np.ndarray] = {}
        sums: dict[int, list[bytes]] = {}
        for batch in batches:
            for kind, part, cells in zip(*(batch.column(n).to_pylist() for n in ("kind", "part", "cells"))):
                if kind == _STORED:
                    old[part] = np.frombuffer(cells, _CELL)
                else:
                    (sums if kind == _TOTALS else new).setdefault(part, []).append(cells)
        known = totals
        for part in sorted(sums.keys() | new.keys() | old.keys()):
            # Messages arrive in any order; sums of doubles must not depend on it.
            if totals is None:
                whole = np.sum([np.frombuffer(x) for x in sorted(sums[part])], 0)
                known = {0: (float(whole[0]), float(whole[1]))}
                if part == min(sums):
                    yield pa.RecordBatch.from_pydict({"kind": [_TOTALS], "part": [part], "cells": [whole.tobytes()], "best": [b""]}, _best)
            cells = np.concatenate([np.zeros(0, _CELL), *(np.frombuffer(x, _CELL) for x in sorted(new.get(part, [])))])
            cells = _merged(cells["key"], cells["g"], cells["h"])
            if part in old and siblings:
                cells = _with_siblings(cells, old[part], siblings)
            cells = live(cells, settings)
            best = best_splits(cells, known, settings)
            held = b"" if last else cells.tobytes()
            yield pa.RecordBatch.from_pydict({"kind": [_STORED], "part": [part], "cells": [held], "best": [best.tobytes()]}, _best)

    return run


def _with_siblings(cells: np.ndarray, parents: np.ndarray, siblings: dict[int, tuple[int, int]]) -> np.ndarray:
    """Cells of the built children, and of the others as parent less built child."""
    low = (1 << 40) - 1

    def of(whole: np.ndarray, node: int) -> np.ndarray:
        return whole[slice(*np.searchsorted(whole["key"], [node << 40, (node + 1) << 40]))]

    out = {}
    for parent, (built, other) in siblings.items():
        own, rest = of(cells, built), of(parents, parent).copy()
        # Every cell of a child is one of its parent's, unless its feature has become too light there.
        slots, held = rest["key"] & low, own["key"] & low
        place = np.searchsorted(slots, held)
        known = place < len(slots)
        known[known] = slots[place[known]] == held[known]
        out[built], place = (own, place) if known.all() else (own[known], place[known])
        rest["g"][place] -= out[built]["g"]
        rest["h"][place] -= out[built]["h"]
        rest["key"] = rest["key"] & low | other << 40
        out[other] = rest
    whole = np.concatenate([np.zeros(0, _CELL), *(out[n] for n in sorted(out))])
    return whole[(whole["h"] > 1e-12) | (np.abs(whole["g"]) > 1e-12)]


def _totals(blocks: DataFrame) -> tuple[float, float]:
    """(rows, rows with label 1)."""
    return tuple(packing.summed(blocks, lambda r: np.array([len(r), r.y.sum()], float), 2))


@dataclass(frozen=True)
class BoostedTrees:
    base: float
    trees: tuple[Tree, ...]

    def probability(self, vectors: Column) -> Column:
        base, trees = self.base, self.trees

        def score(v: pa.Array) -> pa.Array:
            first, feature, value = packing.cells(v)
            columns = Columns.of_rows(packing.Rows(np.zeros(0), np.zeros(0), first, feature, value))
            margin = base + sum((t.margins(columns) for t in trees), np.zeros(columns.rows))
            return pa.array(1 / (1 + np.exp(-margin)))

        return F.arrow_udf(score, "double")(F.unwrap_udt(vectors))

    def save(self, path: str) -> None:
        rows = [(k, self.base, json.dumps(t.__dict__)) for k, t in enumerate(self.trees)] or [(-1, self.base, "")]
        SparkSession.getActiveSession().createDataFrame(rows, "k int, base double, tree string").coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, path: str) -> BoostedTrees:
        rows = sorted(SparkSession.getActiveSession().read.parquet(path).collect(), key=lambda r: r["k"])
        return cls(rows[0]["base"], tuple(Tree(**json.loads(r["tree"])) for r in rows if r["k"] >= 0))


def _grown(binned: DataFrame, trees: list[Tree], settings: Settings, parts: list[int]) -> Tree:
    """One tree, level by level, on bins; `trees` are those since the last refresh."""
    tree, built, stored, siblings = Tree(), [0], None, {}
    totals: dict[int, tuple[float, float]] = {}
    for depth in range(settings.depth):
        if not built:
            break
        sent = binned.mapInArrow(_histograms(trees, tree, built, parts), _SENT)
        if stored is not None:
            sent = sent.unionByName(stored.where(F.col("kind") == _STORED).select("kind", "part", "cells"))
        known = totals if depth else None
        found = sent.repartition(len(parts), "part").mapInArrow(_splitter(siblings, known, settings, depth == settings.depth - 1), f"{_SENT}, best binary")
        found = found.persist(StorageLevel.MEMORY_AND_DISK)
        rows = found.select("kind", F.when(F.col("kind") == _TOTALS, F.col("cells")).alias("total"), "best").collect()
        if not depth:
            totals[0] = next((tuple(np.frombuffer(bytes(r["total"])).tolist()) for r in rows if r["kind"] == _TOTALS), (0.0, 0.0))
        best = strongest(np.concatenate([np.frombuffer(bytes(r["best"]), _SPLIT) for r in rows if r["kind"] == _STORED] or [np.zeros(0, _SPLIT)]))
        if stored is not None:
            stored.unpersist()
        stored, siblings = found, _split(tree, best, totals)
        built = [light for light, _ in siblings.values()]
    if stored is not None:
        stored.unpersist()
    _weigh(tree, totals, settings)
    return tree


def _split(tree: Tree, best: np.ndarray, totals: dict[int, tuple[float, float]]) -> dict[int, tuple[int, int]]:
    """Split the nodes in the tree; (lighter, heavier) child of each."""
    siblings = {}
    for s in best:
        node = int(s["node"])
        low, high = tree.split(node, int(s["feature"]), float(s["bin"]), bool(s["absent"]))
        g, h = totals[node]
        totals[low], totals[high] = (float(s["gl"]), float(s["hl"])), (g - float(s["gl"]), h - float(s["hl"]))
        siblings[node] = (low, high) if totals[low][1] <= totals[high][1] else (high, low)
    return siblings


def _weigh(tree: Tree, totals: dict[int, tuple[float, float]], settings: Settings) -> None:
    for node, (g, h) in totals.items():
        if tree.feature[node] < 0:
            tree.weight[node] = -settings.rate * g / (h + settings.ridge)


class Table:
    """All blocks of a table, their cells by slot and by row: a small node costs the cells of its rows only."""

    def __init__(self, data: list[tuple[np.ndarray, np.ndarray, Cells]]):
        self.y, self.margin = (np.concatenate([np.zeros(0), *(block[k] for block in data)]) for k in (0, 1))
        self.blocks = [cells for _, _, cells in data]
        self.low = np.cumsum([0, *(cells.rows for cells in self.blocks)])
        slot = np.sort(np.concatenate([np.zeros(0, np.int64), *(cells.slot for cells in self.blocks)]), kind="stable")
        self.slot = slot[np.append(True, slot[1:] != slot[:-1])] if len(slot) else slot
        self.place = np.empty(sum(len(cells.row) for cells in self.blocks), np.int32)
        held, at = [np.zeros(1, np.int64)], 0
        for cells in self.blocks:
            place = np.repeat(np.searchsorted(self.slot, cells.slot).astype(np.int32), np.diff(cells.first))
            self.place[at : at + len(place)] = place[np.argsort(cells.row, kind="stable")]
            held.append(np.bincount(cells.row, minlength=cells.rows))
            at += len(place)
        self.first = np.cumsum(np.concatenate(held))
        # Features are not cut: a part begins at the first slot of one.
        begin = np.flatnonzero(np.append(True, np.diff(self.slot >> 8) != 0)) if len(self.slot) else np.zeros(1, np.int64)
        nth = begin // CHUNK_SLOTS
        self.parts = np.append(begin[np.append(True, nth[1:] != nth[:-1])], len(self.slot))

    def histogram(self, node: int, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        """Sums of a node by slot, for each part of the features; `rows` ascend."""
        counts = self.first[rows + 1] - self.first[rows]
        ends = np.cumsum(counts)
        n = int(ends[-1]) if len(ends) else 0
        small = n < len(self.slot) // 4
        sums = None if small else np.zeros((2, len(self.slot)))
        found, low = [np.zeros(0, _CELL)], 0
        while low < len(rows):
            before = ends[low] - counts[low]
            high = max(low + 1, int(np.searchsorted(ends, before + CHUNK_CELLS, "right")))
            part, held = rows[low:high], counts[low:high]
            if part[-1] - part[0] == len(part) - 1:
                place = self.place[self.first[part[0]] : self.first[part[-1] + 1]]
            else:
                place = self.place[np.repeat(self.first[part] - (ends[low:high] - held), held) + np.arange(before, ends[high - 1])]
            own_g, own_h = np.repeat(g[part], held), np.repeat(h[part], held)
            if small:
                found.append(_merged(place, own_g, own_h))
            else:
                sums[0] += np.bincount(place, own_g, len(self.slot))
                sums[1] += np.bincount(place, own_h, len(self.slot))
            low = high
        if small:
            cells = np.concatenate(found)
            cells = _merged(cells["key"], cells["g"], cells["h"])
            ends = np.searchsorted(np.ascontiguousarray(cells["key"]), self.parts[1:-1])
            cells["key"] = self.slot[cells["key"]] | node << 40
            return np.split(cells, ends)
        out = []
        for low, high in zip(self.parts, self.parts[1:]):
            own_g, own_h = sums[:, low:high]
            held = np.flatnonzero((own_h > 0) | (own_g != 0))
            cells = np.empty(len(held), _CELL)
            cells["key"], cells["g"], cells["h"] = self.slot[low:high][held] | node << 40, own_g[held], own_h[held]
            out.append(cells)
        return out

    def left(self, rows: np.ndarray, feature: int, cut: float, absent: bool) -> np.ndarray:
        """Which of the rows go left."""
        goes = np.zeros(len(self.y), bool)
        goes[rows] = absent
        for low, cells in zip(self.low, self.blocks):
            row, value = cells.of(feature)
            goes[low + row] = value <= cut
        return goes[rows]


def _grower(settings: Settings):
    """All trees of a table that is worth one task: the same steps without jobs between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table([block for batch in batches for block in _binned(batch)])
        for k in range(settings.rounds if len(table.y) else 0):
            p = 1 / (1 + np.exp(-table.margin))
            g, h = p - table.y, p * (1 - p)
            tree, built, siblings = Tree(), [0], {}
            cells: list[np.ndarray] = []
            totals, rows = {0: (float(g.sum()), float(h.sum()))}, {0: np.arange(len(table.y))}
            for _ in range(settings.depth):
                if not built:
                    break
                new = [np.concatenate(own) for own in zip(*(table.histogram(node, rows[node], g, h) for node in sorted(built)))]
                if siblings:
                    new = [_with_siblings(own, old, siblings) for own, old in zip(new, cells)]
                cells = [live(own, settings) for own in new]
                siblings = _split(tree, strongest(np.concatenate([best_splits(own, totals, settings) for own in cells])), totals)
                for node in siblings:
                    here, low = rows.pop(node), tree.left[node]
                    left = table.left(here, tree.feature[node], tree.cut[node], tree.absent[node])
                    rows[low], rows[low + 1] = here[left], here[~left]
                built = [light for light, _ in siblings.values()]
            _weigh(tree, totals, settings)
            for node, here in rows.items():
                table.margin[here] += tree.weight[node]
            yield pa.RecordBatch.from_pydict({"k": [k], "tree": [json.dumps(tree.__dict__)]})
            if len(tree.feature) == 1:
                break

    return run


def fit(
    df: DataFrame, features: str = "features", label: str = "label", settings: Settings = Settings(),
    block_rows: int = packing.ROWS, task_cells: int = ALONE_CELLS,
) -> BoostedTrees:
    """Learn from the labelled vectors of `df`.

    A table of up to `task_cells` cells is one task's work and is learned in one job; a larger one takes
    a job per level of a tree. Both take the same steps.
    """
    spark = df.sparkSession
    blocks = packing.packed(df, features, label, most_rows=block_rows, most_cells=BLOCK_CELLS)
    n, positive = _totals(blocks)
    share = min(max(positive / max(n, 1), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    cuts = cut_points(df, features)
    sent = spark.sparkContext.broadcast(cuts)
    made = blocks.mapInArrow(_binner(sent, base), _BINNED)
    alone, task_cells = task_cells, min(task_cells, packing.TASK_CELLS)
    binned = packing.kept(durable(made, "binned"), "row", 4, task_cells)
    n_tasks = packing.tasks(binned, "row", 4, task_cells)
    if packing.tasks(binned, "row", 4, alone) == 1:
        rows = binned.coalesce(1).mapInArrow(_grower(settings), "k long, tree string").collect()
        trees = [Tree(**json.loads(r["tree"])) for r in sorted(rows, key=lambda r: r["k"])]
    else:
        # Few tasks of full size would leave cores idle in hundreds of passes.
        fine = packing.tasks(binned, "row", 4, max(1, task_cells // packing.FINER))
        n_tasks = min(fine, max(spark.sparkContext.defaultParallelism, n_tasks))
        whole, binned = binned, _spread(binned, n_tasks)
        whole.unpersist()
        trees, binned = _boosted(binned, settings, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_tasks), n_tasks)
    for held in (binned, blocks, sent):
        held.unpersist()
    return BoostedTrees(base, tuple(_by_value(t, cuts) for t in trees))


def _spread(binned: DataFrame, n_tasks: int) -> DataFrame:
    """Blocks dealt evenly to tasks, and held by the executors."""
    held = binned.repartition(n_tasks).persist(StorageLevel.MEMORY_AND_DISK)
    held.count()
    return held


def _boosted(binned: DataFrame, settings: Settings, parts: int, n_tasks: int) -> tuple[list[Tree], DataFrame]:
    trees: list[Tree] = []
    fresh: list[Tree] = []
    names = _names(binned.sparkSession, parts)
    for _ in range(settings.rounds):
        tree = _grown(binned, fresh, settings, names)
        trees.append(tree)
        fresh.append(tree)
        if len(tree.feature) == 1:
            break  # no split gains: later rounds would only repeat this leaf
        if len(fresh) == REFRESH:
            later = _spread(durable(binned.mapInArrow(_refreshed(fresh), _BINNED), "binned"), n_tasks)
            binned.unpersist()
            binned, fresh = later, []
    return trees, binned


def _by_value(tree: Tree, cuts: dict[int, np.ndarray]) -> Tree:
    """The same tree with bounds in place of bins."""
    cut = [
        float(cuts[f][int(c)]) if f >= 0 and int(c) < len(cuts[f]) else (float("inf") if f >= 0 else 0.0)
        for f, c in zip(tree.feature, tree.cut)
    ]
    return Tree(tree.feature, cut, tree.absent, tree.left, tree.weight)
