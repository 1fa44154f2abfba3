"""Linear classifiers over blocks: logistic regression and squared-hinge margins, several at a time.

All weight vectors of a job (one per fold, say) are worked on in the same passes, by limited-memory BFGS
on the mean loss. A vector stops when no entry of its gradient exceeds the tolerance, or after the
largest number of iterations.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import blocks as packing

TOLERANCE, ITERATIONS, MEMORY = 1e-4, 1000, 10


def _log(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and its derivative by the margin."""
    p = 1 / (1 + np.exp(-margin))
    return np.logaddexp(0, margin) - y * margin, p - y


def _squared_hinge(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sign = 2 * y - 1
    short = np.maximum(0, 1 - sign * margin)
    return short**2, -2 * sign * short


LOSSES = {"log": _log, "squared_hinge": _squared_hinge}


@dataclass(frozen=True)
class Fit:
    weights: np.ndarray
    iterations: tuple[int, ...]
    passes: int


def minimised(
    evaluate: Callable[[np.ndarray, list[int]], tuple[np.ndarray, np.ndarray]], start: np.ndarray,
    tolerance: float = TOLERANCE, iterations: int = ITERATIONS, memory: int = MEMORY,
) -> Fit:
    """Minimise several functions side by side.

    `evaluate(points, which)` returns the values and gradients of the functions `which` at their points.
    """
    w = start.copy()
    value, gradient = evaluate(w, list(range(len(w))))
    past: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in w]
    direction, step = [None] * len(w), [1.0] * len(w)
    done, passes = [0] * len(w), 1
    stuck = set()

    def towards(m: int) -> np.ndarray:
        d = -gradient[m]
        used = []
        for s, y in reversed(past[m]):
            a = (s @ d) / (s @ y)
            used.append(a)
            d = d - a * y
        if past[m]:
            s, y = past[m][-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(past[m], reversed(used)):
            d = d + (a - (y @ d) / (s @ y)) * s
        return d

    while True:
        live = [m for m in range(len(w)) if m not in stuck and done[m] < iterations and np.abs(gradient[m]).max() > tolerance]
        if not live:
            return Fit(w, tuple(done), passes)
        for m in live:
            if direction[m] is None:
                direction[m] = towards(m)
                step[m] = 1.0 if past[m] else min(1.0, 1 / np.abs(gradient[m]).sum())
        trial = np.stack([w[m] + step[m] * direction[m] for m in live])
        found, slope = evaluate(trial, live)
        passes += 1
        for k, m in enumerate(live):
            down = gradient[m] @ direction[m]
            if found[k] <= value[m] + 1e-4 * step[m] * down:
                s, y = trial[k] - w[m], slope[k] - gradient[m]
                if s @ y > 1e-12 * (y @ y):
                    past[m] = [*past[m], (s, y)][-memory:]
                w[m], value[m], gradient[m] = trial[k], found[k], slope[k]
                direction[m] = None
                done[m] += 1
            else:
                step[m] *= 0.5
                if step[m] < 1e-12:
                    stuck.add(m)


def fit(
    blocks: DataFrame, width: int, loss: str = "log", folds: int = 0, penalty_on_bias: bool = False,
    tolerance: float = TOLERANCE, iterations: int = ITERATIONS,
) -> Fit:
    """Weights (bias last) at C = 1: mean loss plus |w|^2 / 2n.

    With folds, vector k learns from the rows of all folds but k; without, there is one vector of all rows.
    """
    of, count = LOSSES[loss], max(1, folds)
    sizes = packing.summed(blocks, lambda r: np.bincount(r.fold, minlength=count).astype(float)[:count], count)
    n = np.maximum(sizes.sum() - sizes if folds else sizes, 1)

    def evaluate(points: np.ndarray, which: list[int]) -> tuple[np.ndarray, np.ndarray]:
        def partial(rows: packing.Rows) -> np.ndarray:
            out = []
            for w, k in zip(points, which):
                own = rows.fold != k if folds else np.ones(len(rows), bool)
                value, slope = of(rows.times(w[:-1]) + w[-1], rows.y)
                slope = np.where(own, slope, 0)
                out += [[value[own].sum()], rows.turned(slope, width), [slope.sum()]]
            return np.concatenate(out)

        sums = packing.summed(blocks, partial, len(which) * (width + 2)).reshape(len(which), width + 2)
        free = points.copy()
        if not penalty_on_bias:
            free[:, -1] = 0
        m = n[which]
        return sums[:, 0] / m + (free**2).sum(1) / (2 * m), (sums[:, 1:] + free) / m[:, None]

    return minimised(evaluate, np.zeros((count, width + 1)), tolerance, iterations)


def sigmoids(blocks: DataFrame, weights: np.ndarray, steps: int = 100) -> np.ndarray:
    """(slope, offset) per fold that turn margins of vector k on the rows of fold k into probabilities.

    Newton steps for all folds at once; the targets are drawn in a little by the number of rows of
    either label, so that separable folds stay finite.
    """
    folds = len(weights)
    counts = packing.summed(
        blocks, lambda r: np.bincount(2 * r.fold + r.y.astype(int), minlength=2 * folds).astype(float), 2 * folds
    ).reshape(folds, 2)
    high, low = (counts[:, 1] + 1) / (counts[:, 1] + 2), 1 / (counts[:, 0] + 2)
    ab = np.stack([np.ones(folds), np.log((counts[:, 1] + 1) / (counts[:, 0] + 1))], 1)

    def sums(at: np.ndarray) -> np.ndarray:
        def partial(rows: packing.Rows) -> np.ndarray:
            out = np.zeros((folds, 6))
            for k in np.unique(rows.fold):
                own = rows.fold == k
                m = (rows.times(weights[k, :-1]) + weights[k, -1])[own]
                t = np.where(rows.y[own] == 1, high[k], low[k])
                z = at[k, 0] * m + at[k, 1]
                p = 1 / (1 + np.exp(-z))
                h = p * (1 - p)
                out[k] = [(np.logaddexp(0, z) - t * z).sum(), (m * (p - t)).sum(), (p - t).sum(), (m * m * h).sum(), (m * h).sum(), h.sum()]
            return out.ravel()

        return packing.summed(blocks, partial, folds * 6).reshape(folds, 6)

    now, step, live = sums(ab), np.ones(folds), np.ones(folds, bool)
    for _ in range(steps):
        move = np.zeros_like(ab)
        for k in np.flatnonzero(live):
            _, ga, gb, aa, ax, bb = now[k]
            move[k] = -step[k] * np.linalg.solve([[aa + 1e-12, ax], [ax, bb + 1e-12]], [ga, gb])
        later = sums(ab + move)
        better = later[:, 0] <= now[:, 0]
        ab, now = np.where(better[:, None], ab + move, ab), np.where(better[:, None], later, now)
        step = np.where(better, 1.0, step / 2)
        live &= (np.abs(now[:, 1:3]).max(1) > 1e-9 * np.maximum(1, counts.sum(1))) & (step > 1e-8)
        if not live.any():
            break
    return ab


@dataclass(frozen=True)
class LinearModel:
    """Mean of the probabilities of one or several weight vectors (bias last), each with a sigmoid."""

    weights: np.ndarray
    sigmoids: np.ndarray

    def probability(self, vectors: Column) -> Column:
        weights, sigmoids = self.weights, self.sigmoids

        def score(v: pa.Array) -> pa.Array:
            first, feature, value = packing.cells(v)
            rows = packing.Rows(np.zeros(0), np.zeros(0), first, feature, value)
            p = np.zeros(len(rows))
            for w, (a, b) in zip(weights, sigmoids):
                p += 1 / (1 + np.exp(-(a * (rows.times(w[:-1]) + w[-1]) + b)))
            return pa.array(p / len(weights))

        return F.arrow_udf(score, "double")(F.unwrap_udt(vectors))

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        rows = [(k, json.dumps(w.tolist()), *map(float, s)) for k, (w, s) in enumerate(zip(self.weights, self.sigmoids))]
        spark.createDataFrame(rows, "k int, weights string, slope double, offset double").coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, path: str) -> LinearModel:
        rows = sorted(SparkSession.getActiveSession().read.parquet(path).collect(), key=lambda r: r["k"])
        return cls(np.array([json.loads(r["weights"]) for r in rows]), np.array([(r["slope"], r["offset"]) for r in rows]))


def logistic(blocks: DataFrame, width: int, **limits) -> tuple[LinearModel, Fit]:
    found = fit(blocks, width, **limits)
    return LinearModel(found.weights, np.array([[1.0, 0.0]])), found


def calibrated_svm(blocks: DataFrame, width: int, folds: int, **limits) -> tuple[LinearModel, Fit]:
    """Margins of each fold learned on the others and calibrated on the fold itself."""
    found = fit(blocks, width, "squared_hinge", folds, penalty_on_bias=True, **limits)
    return LinearModel(found.weights, sigmoids(blocks, found.weights)), found


def fold_moments(blocks: DataFrame, width: int, folds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, means, deviations) of the columns over all folds but each: sums per fold, taken away from the whole."""

    def partial(rows: packing.Rows) -> np.ndarray:
        out = np.zeros((folds, 2 * width + 1))
        for k in range(folds):
            own = (rows.fold == k).astype(float)
            out[k] = np.concatenate([[own.sum()], rows.turned(own, width), _squares(rows).turned(own, width)])
        return out.ravel()

    sums = packing.summed(blocks, partial, folds * (2 * width + 1)).reshape(folds, -1)
    rest = sums.sum(0) - sums
    n = np.maximum(rest[:, :1], 1)
    mean = rest[:, 1 : width + 1] / n
    spread = np.sqrt(np.maximum(rest[:, width + 1 :] / n - mean**2, 0))
    return n[:, 0], mean, np.where(spread <= 1e-12 * np.maximum(1, np.abs(mean)), 1.0, spread)


def _squares(rows: packing.Rows) -> packing.Rows:
    return packing.Rows(rows.y, rows.fold, rows.first, rows.feature, rows.value**2)


def fold_f1(blocks: DataFrame, width: int, folds: int, tolerance: float = 1e-9, steps: int = 100) -> list[float]:
    """F1 of each fold under a logistic regression of the others, on standardised columns.

    Newton's method: one pass brings the gradient and the Gram matrix of every fold's model, weighted by
    its own predictions, so all folds take a step at once. Meant for few columns.
    """
    n, mean, spread = fold_moments(blocks, width, folds)
    side = width + 1

    def dense(rows: packing.Rows, k: int) -> np.ndarray:
        x = np.zeros((len(rows), side))
        x[rows.owner(), rows.feature] = rows.value
        x[:, :width] = (x[:, :width] - mean[k]) / spread[k]
        x[:, width] = 1
        return x

    def gram(at: np.ndarray):
        def partial(rows: packing.Rows) -> np.ndarray:
            out = np.zeros((folds, 1 + side + side * side))
            for k in range(folds):
                own = rows.fold != k
                x, y = dense(rows, k)[own], rows.y[own]
                margin = x @ at[k]
                value, slope = _log(margin, y)
                p = slope + y
                out[k] = np.concatenate([[value.sum()], x.T @ slope, (x.T @ (x * (p * (1 - p))[:, None])).ravel()])
            return out.ravel()

        return packing.summed(blocks, partial, folds * (1 + side + side * side)).reshape(folds, -1)

    ridge = np.ones(side)
    ridge[width] = 0
    at, step = np.zeros((folds, side)), np.ones(folds)
    sums = gram(at)
    for _ in range(steps):
        cost = sums[:, 0] + (at**2 * ridge).sum(1) / 2
        slope = sums[:, 1 : 1 + side] + at * ridge
        if np.abs(slope / n[:, None]).max() <= tolerance or step.min() < 1e-8:
            break
        bend = sums[:, 1 + side :].reshape(folds, side, side) + np.diag(ridge + 1e-12)
        trial = at - step[:, None] * np.stack([np.linalg.solve(b, s) for b, s in zip(bend, slope)])
        later = gram(trial)
        better = later[:, 0] + (trial**2 * ridge).sum(1) / 2 <= cost * (1 + 1e-14)
        at, sums = np.where(better[:, None], trial, at), np.where(better[:, None], later, sums)
        step = np.where(better, 1.0, step / 2)

    def confusion(rows: packing.Rows) -> np.ndarray:
        out = np.zeros((folds, 3))
        for k in range(folds):
            own = rows.fold == k
            said, y = dense(rows, k)[own] @ at[k] >= 0, rows.y[own] == 1
            out[k] = [(said & y).sum(), (said & ~y).sum(), (~said & y).sum()]
        return out.ravel()

    tp, fp, fn = packing.summed(blocks, confusion, folds * 3).reshape(folds, 3).T
    return [float(2 * a / (2 * a + b + c)) if a else 0.0 for a, b, c in zip(tp, fp, fn)]
