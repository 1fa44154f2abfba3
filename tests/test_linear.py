import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakemill.operators import blocks, linear
from lakemill.session import durable

FOLDS = 3


@pytest.fixture(scope="module")
def table(spark):
    """Dense and sparse vectors, an empty one among them, with noisy labels and three folds."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 6)) * (rng.random((150, 6)) < 0.6)
    x[7] = 0
    y = (x @ [2, -1, 0.5, 0, 0, 1] + rng.normal(size=150) * 0.7 > 0.1).astype(int)
    fold = np.arange(150) % FOLDS
    rows = [
        (int(a), int(f), Vectors.dense(v) if i % 4 == 0 else Vectors.sparse(6, {j: c for j, c in enumerate(v) if c}))
        for i, (a, f, v) in enumerate(zip(y, fold, x))
    ]
    return durable(spark.createDataFrame(rows, ["label", "fold", "features"]), "linear"), x, y, fold


@pytest.fixture(scope="module")
def held(table):
    return blocks.packed(table[0].repartition(3), fold=F.col("fold"))


def newton(x, y, steps=60):
    """Logistic regression at C = 1 with a free bias, by plain Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 0
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (p - y) + w * ridge)
    return w


def test_blocks_hold_every_cell(held, table, monkeypatch):
    _, x, y, fold = table
    sums = blocks.summed(held, lambda r: np.concatenate([r.turned(np.ones(len(r)), 6), [len(r), r.y.sum(), r.fold.sum()]]), 9)
    assert np.allclose(sums, [*x.sum(0), len(y), y.sum(), fold.sum()])
    monkeypatch.setattr(blocks, "GATHERED", 0)  # partial sums meet in tasks first
    assert np.allclose(blocks.summed(held, lambda r: np.array([float(len(r))]), 1), [len(y)])
    small = blocks.packed(table[0].repartition(2), most_rows=7, most_cells=15)
    assert small.count() >= 150 // 7 and blocks.summed(small, lambda r: r.turned(r.y, 6), 6) == pytest.approx(x.T @ y)


def test_logistic_regression_reaches_its_minimum(held, table):
    _, x, y, _ = table
    model, found = linear.logistic(held, 6, tolerance=1e-8)
    assert model.weights[0] == pytest.approx(newton(x, y), abs=1e-5)
    assert found.iterations[0] < 200 and found.passes < 300
    _, loose = linear.logistic(held, 6)
    assert loose.iterations[0] < found.iterations[0]


def test_all_folds_learn_in_the_same_passes(held, table):
    _, x, y, fold = table
    found = linear.fit(held, 6, folds=FOLDS, tolerance=1e-8)
    for k in range(FOLDS):
        assert found.weights[k] == pytest.approx(newton(x[fold != k], y[fold != k]), abs=1e-4)
    assert found.passes < sum(found.iterations)


def test_calibrated_margins(held, table):
    df, x, y, fold = table
    model, _ = linear.calibrated_svm(held, 6, FOLDS, tolerance=1e-7)
    one = np.hstack([x, np.ones((len(x), 1))])
    for k, (w, (a, b)) in enumerate(zip(model.weights, model.sigmoids)):
        inner, outer = fold == k, fold != k
        sign = 2 * y[outer] - 1
        short = np.maximum(0, 1 - sign * (one[outer] @ w))
        assert np.abs(w - 2 * one[outer].T @ (sign * short)).max() < 1e-3  # gradient of |w|^2 / 2 + sum of squares
        m, t = one[inner] @ w, y[inner]
        target = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / (len(t) - t.sum() + 2))
        p = 1 / (1 + np.exp(-(a * m + b)))
        assert abs(((p - target) * m).sum()) < 1e-5 and abs((p - target).sum()) < 1e-5
    want = np.mean([1 / (1 + np.exp(-(a * (one @ w) + b))) for w, (a, b) in zip(model.weights, model.sigmoids)], 0)
    got = [r["p"] for r in df.withColumn("p", model.probability(F.col("features"))).select("p").collect()]
    assert sorted(got) == pytest.approx(sorted(want))


def test_saved_models_score_alike(spark, held, table, folder):
    model, _ = linear.logistic(held, 6)
    model.save(f"{folder}/lr")
    again = linear.LinearModel.load(f"{folder}/lr")
    assert (again.weights == model.weights).all() and (again.sigmoids == model.sigmoids).all()


def test_f1_of_folds(held, table):
    _, x, y, fold = table
    got = linear.fold_f1(held, 6, FOLDS)
    for k in range(FOLDS):
        rest = x[fold != k]
        z = (x - rest.mean(0)) / rest.std(0)
        w = newton(z[fold != k], y[fold != k])
        said, true = z[fold == k] @ w[:-1] + w[-1] >= 0, y[fold == k] == 1
        tp = (said & true).sum()
        assert got[k] == pytest.approx(2 * tp / (2 * tp + (said & ~true).sum() + (~said & true).sum()))


def test_no_rows(spark, table):
    none = blocks.packed(table[0].limit(0))
    assert linear.fit(none, 6).weights.tolist() == [[0.0] * 7]


def test_a_pass_sends_the_driver_a_fixed_amount(spark, monkeypatch):
    """Sums of many tasks are added up by tasks; one width of doubles reaches the driver."""
    width = 30_000
    many = spark.range(12).repartition(12).selectExpr("cast(id as double) AS label", "id")
    rows = many.rdd.map(lambda r: (r["label"], Vectors.sparse(width, {int(r["id"]): 1.0}))).toDF(["label", "features"])
    spread = blocks.packed(rows).repartition(12)
    sent = []
    collect = type(spread).collect
    monkeypatch.setattr(type(spread), "collect", lambda self: sent.append(out := collect(self)) or out)
    total = blocks.summed(spread, lambda r: r.turned(np.ones(len(r)), width), width)
    assert total.sum() == 12
    assert sum(len(r["sums"]) for r in sent[-1]) == width * 8


def test_products_of_rows_without_cells():
    rows = blocks.Rows(np.zeros(4), np.zeros(4), np.array([0, 0, 2, 2, 2]), np.array([1, 2], np.int32), np.array([3.0, 4.0]))
    assert rows.times(np.array([1.0, 10.0, 100.0])).tolist() == [0, 430, 0, 0]


def test_arrays_of_a_block_are_small(spark):
    """Workers get the blocks anew in every pass, and arrays of some MB are slow to hand over."""
    rows = spark.range(0, 600, 1, 1).select((F.col("id") % 2).alias("label"), F.sequence(F.lit(1), F.lit(500)).cast("array<double>").alias("v"))
    held = blocks.packed(rows.select("label", array_to_vector("v").alias("features")))
    sizes = held.agg(F.max(F.octet_length("value")).alias("most"), F.sum(F.octet_length("value")).alias("all")).first()
    assert sizes["most"] <= (512 << 10) + 500 * 8 and sizes["all"] == 600 * 500 * 8  # the last row may pass the limit


def test_features_of_a_block_are_widened_once_for_all_products():
    """Products of a block, and sums over it, take places as wide as the machine's own; a pass has many of them."""
    import pyarrow as pa

    first, feature, value = np.array([0, 2, 2, 3]), np.array([1, 3, 0], np.int32), np.array([2.0, 0.5, 4.0])
    row = [np.array([1.0, 0.0, 1.0]), np.zeros(3, np.int32), first, feature, value]
    batch = pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], ["y", "fold", "first", "feature", "value"])
    (rows,) = blocks.read(batch)
    assert rows.feature.dtype == np.intp and rows.feature.tolist() == [1, 3, 0]
    assert rows.times(np.array([1.0, 10.0, 0.0, 4.0])).tolist() == [22.0, 0.0, 4.0]
    assert rows.turned(np.array([1.0, 5.0, 2.0]), 4).tolist() == [8.0, 2.0, 0.0, 0.5]


def test_sums_are_added_up_by_no_more_tasks_than_there_are_cores(spark, held, table, monkeypatch):
    monkeypatch.setattr(blocks, "GATHERED", 0)
    monkeypatch.setattr(blocks, "SLICE", 2)
    dealt, repartition = [], type(held).repartition
    monkeypatch.setattr(type(held), "repartition", lambda df, n, *by: dealt.append(n) or repartition(df, n, *by))
    sums = blocks.summed(held, lambda rows: np.full(40, float(len(rows))), 40)
    assert dealt == [min(20, spark.sparkContext.defaultParallelism)] and (sums == len(table[2])).all()
