"""Sparse rows packed into blocks, for solvers that pass over the same rows many times.

A block holds some hundred rows as flat arrays (compressed sparse rows). Blocks are written once and
kept by the executors; a pass sends the current weights out and brings sums of a fixed width back, so
its cost is one scan of the blocks whatever the number of rows. A lost executor reads its blocks again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.session import durable

#: Rows and cells of a block, whichever is reached first. Arrays of some MB are slow to hand to Python workers
#: in every pass; these have half a MB at most.
ROWS, CELLS = 4096, 1 << 16
#: Cells that are worth a task of their own.
TASK_CELLS = 1 << 22
#: So many tasks share the cells that are worth one, while cores are free.
FINER = 16
#: Doubles in one message of a sum.
SLICE = 1 << 13
#: Bytes of partial sums that may meet on the driver in a pass; beyond, they are added up by tasks first,
#: so what a pass sends there has a fixed limit whatever the number of tasks.
GATHERED = 2 << 20

SCHEMA = "y binary, fold binary, first binary, feature binary, value binary"


@dataclass
class Rows:
    """Row i has the cells first[i]:first[i + 1] of `feature` and `value`."""

    y: np.ndarray
    fold: np.ndarray
    first: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Product of every row with a weight vector."""
        out, held = np.zeros(len(self)), np.diff(self.first) > 0
        if held.any():
            out[held] = np.add.reduceat(self.value * weights.take(self.feature), self.first[:-1][held])
        return out

    def turned(self, residual: np.ndarray, width: int) -> np.ndarray:
        """Sum of the rows, each times its residual."""
        return np.bincount(self.feature, self.value * np.repeat(residual, np.diff(self.first)), width)[:width]


def cells(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, feature, value) of a column of vectors, dense or sparse; zeros are left out."""
    values, places = vectors.field("values"), vectors.field("indices")
    counts = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    value = values.flatten().to_numpy(zero_copy_only=False)
    dense = vectors.field("type").to_numpy(zero_copy_only=False) == 1
    feature = np.arange(len(value)) - np.repeat(np.cumsum(counts) - counts, counts)
    if not dense.all():
        feature[np.repeat(~dense, counts)] = places.flatten().to_numpy(zero_copy_only=False)
    held = value != 0
    kept = np.bincount(np.repeat(np.arange(len(counts)), counts)[held], minlength=len(counts))
    return np.concatenate([[0], np.cumsum(kept)]), feature[held].astype(np.int32), value[held].astype(np.float64)


def read(batch: pa.RecordBatch) -> Iterator[Rows]:
    """Features are widened once: each product of each weight vector would do it again."""
    for y, fold, first, feature, value in zip(*(batch.column(c).to_pylist() for c in ("y", "fold", "first", "feature", "value"))):
        yield Rows(np.frombuffer(y), np.frombuffer(fold, np.int32), np.frombuffer(first, np.int64), np.frombuffer(feature, np.int32).astype(np.intp), np.frombuffer(value))


def _packer(most_rows: int, most_cells: int):
    def block(held: list[tuple]) -> pa.RecordBatch:
        y, fold, counts, feature, value = (np.concatenate(x) for x in zip(*held))
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        row = [y.astype(np.float64), fold.astype(np.int32), first, feature, value]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], ["y", "fold", "first", "feature", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = size = 0
        for batch in batches:
            first, feature, value = cells(batch.column("v"))
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            low = 0
            while low < len(y):
                fits = int(np.searchsorted(first, first[low] + most_cells - size, "right")) - 1
                high = min(low + most_rows - n, max(low + 1, fits), len(y))
                cut = slice(first[low], first[high])
                held.append((y[low:high], fold[low:high], np.diff(first[low : high + 1]), feature[cut], value[cut]))
                n, size, low = n + high - low, size + int(first[high] - first[low]), high
                if n >= most_rows or size >= most_cells:
                    yield block(held)
                    held, n, size = [], 0, 0
        if held:
            yield block(held)

    return run


def packed(
    df: DataFrame, features: str = "features", label: str = "label", fold: Column | None = None,
    most_rows: int = ROWS, most_cells: int = CELLS,
) -> DataFrame:
    """Blocks of the labelled vectors of `df`, written once and kept by the executors."""
    rows = df.select(
        F.unwrap_udt(features).alias("v"), F.col(label).cast("double").alias("y"),
        (F.lit(0) if fold is None else fold).cast("int").alias("fold"),
    )
    return kept(durable(rows.mapInArrow(_packer(most_rows, most_cells), SCHEMA), "blocks"), "value", 8)


def tasks(blocks: DataFrame, column: str, width: int, task_cells: int = TASK_CELLS) -> int:
    """Tasks that the cells of the blocks are worth; `column` holds `width` bytes per cell."""
    size = blocks.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, -(-size // (width * task_cells)))


def kept(blocks: DataFrame, column: str, width: int, task_cells: int = TASK_CELLS) -> DataFrame:
    """Blocks held by the executors in as many partitions as they are worth, or as there are cores."""
    fine = tasks(blocks, column, width, max(1, task_cells // FINER))
    coarse = -(-fine // min(FINER, task_cells))
    n = min(fine, max(blocks.sparkSession.sparkContext.defaultParallelism, coarse))
    return (blocks.coalesce(n) if n < blocks.rdd.getNumPartitions() else blocks).persist(StorageLevel.MEMORY_AND_DISK)


def summed(blocks: DataFrame, partial: Callable[[Rows], np.ndarray], width: int) -> np.ndarray:
    """Sum of `partial`, a flat array of `width` doubles per block, over all blocks.

    Tasks add up their own blocks. Their sums are added in the order of the tasks, so that a pass gives
    the same result each time.
    """
    names = ["slice", "part", "sums"]

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for rows in read(batch):
                total += partial(rows)
        part = TaskContext.get().partitionId()
        for k, low in enumerate(range(0, width, SLICE)):
            yield pa.RecordBatch.from_pydict({"slice": [k], "part": [part], "sums": [total[low : low + SLICE].tobytes()]})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, sums in zip(batch.column("slice").to_pylist(), batch.column("sums").to_pylist()):
                totals[k] = totals.get(k, 0) + np.frombuffer(sums)
        for k, total in totals.items():
            yield pa.RecordBatch.from_pydict(dict(zip(names, ([k], [0], [total.tobytes()]))))

    kind = "slice long, part long, sums binary"
    parts = blocks.mapInArrow(sliced, kind)
    if blocks.rdd.getNumPartitions() * width * 8 > GATHERED:
        n = min(-(-width // SLICE), blocks.sparkSession.sparkContext.defaultParallelism)
        parts = parts.repartition(n, "slice").sortWithinPartitions("slice", "part").mapInArrow(added, kind)
    out: dict[int, np.ndarray] = {}
    for row in sorted(parts.collect(), key=lambda r: (r["slice"], r["part"])):
        out[row["slice"]] = out.get(row["slice"], 0) + np.frombuffer(bytes(row["sums"]))
    return np.concatenate([out[k] for k in sorted(out)]) if out else np.zeros(width)
