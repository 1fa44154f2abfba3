import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakemill.operators import blocks, boosting
from lakemill.operators.boosting import BoostedTrees, Settings, Tree


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(220, 5)), 1) * (rng.random((220, 5)) < 0.7)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0) | (rng.random(220) < 0.1)).astype(float)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(int(t), Vectors.sparse(5, {j: float(c) for j, c in enumerate(v) if c})) for v, t in zip(x, y)]
    return spark.createDataFrame(rows, ["label", "features"]).repartition(3).cache()


def all_splits(x, g, h, cuts, settings):
    """Gain of every feature, cut and direction of the absent cells (zeros), by plain sums."""
    out = []
    score = lambda a, b: a**2 / (b + settings.ridge)
    for f in range(x.shape[1]):
        present = x[:, f] != 0
        for cut in [*cuts[f], np.inf]:
            for absent in (False, True):
                left = np.where(present, x[:, f] <= cut, absent)
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
                if min(hl, hr) >= settings.least_weight:
                    out.append((score(gl, hl) + score(gr, hr) - score(g.sum(), h.sum()), f, cut, absent))
    return out


def plain_tree(x, g, h, cuts, settings):
    """Grown greedily from the gains of all splits; the margin of each row."""
    margin = np.zeros(len(x))

    def grow(rows, depth):
        found = all_splits(x[rows], g[rows], h[rows], cuts, settings) if depth < settings.depth else []
        found = [s for s in found if s[0] > boosting.LEAST]
        if not found:
            margin[rows] = -settings.rate * g[rows].sum() / (h[rows].sum() + settings.ridge)
            return
        best = round(max(s[0] for s in found), 7)
        _, f, cut, absent = next(s for s in found if round(s[0], 7) == best)
        value = x[rows, f]
        left = np.where(value != 0, value <= cut, absent)
        grow(rows[left], depth + 1)
        grow(rows[~left], depth + 1)

    grow(np.arange(len(x)), 0)
    return margin


@pytest.mark.parametrize("settings", [Settings(rounds=1, depth=1), Settings(rounds=3, depth=3), Settings(rounds=12, depth=2, rate=0.5)])
@pytest.mark.parametrize("task_cells", [blocks.TASK_CELLS, 200])
def test_equals_plain_boosting(spark, data, table, settings, task_cells, monkeypatch):
    """In one job, and in a job per level with the cells dealt to several tasks."""
    monkeypatch.setattr(boosting, "REFRESH", 5)
    x, y = data
    cuts = boosting.cut_points(table)
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(settings.rounds):
        p = 1 / (1 + np.exp(-margin))
        margin = margin + plain_tree(x, p - y, p * (1 - p), cuts, settings)
    model = boosting.fit(table, settings=settings, block_rows=50, task_cells=task_cells)
    rows = blocks.Rows(y, y, np.append(0, np.cumsum((x != 0).sum(1))), np.nonzero(x)[1].astype(np.int32), x[x != 0])
    columns = boosting.Columns.of_rows(rows)
    got = model.base + sum(t.margins(columns) for t in model.trees)
    assert got == pytest.approx(margin, abs=1e-9)


def test_best_split_equals_brute_force(data):
    x, y = data
    settings = Settings()
    g, h = 0.4 - y, np.full(len(y), 0.24)
    cuts = {f: np.unique(np.quantile(x[x[:, f] != 0, f], np.arange(1, 8) / 8, method="lower")) for f in range(5)}
    row, f = np.nonzero(x)
    bins = np.array([np.searchsorted(cuts[b], x[a, b]) for a, b in zip(row, f)])
    cells = boosting._merged(boosting._keyed(np.zeros(len(row)), f, bins), g[row], h[row])
    best = boosting.best_splits(cells, {0: (g.sum(), h.sum())}, settings)
    assert len(best) == 1 and best[0]["gain"] == pytest.approx(max(s[0] for s in all_splits(x, g, h, cuts, settings)))
    assert len(boosting.best_splits(cells[:0], {0: (0.0, 0.0)}, settings)) == 0


def test_siblings_by_subtraction():
    rng = np.random.default_rng(3)
    node, feature, bins = rng.integers(1, 3, 500), rng.integers(0, 6, 500), rng.integers(0, 9, 500)
    g, h = rng.normal(size=500), rng.random(500)
    key = lambda n: boosting._keyed(n, feature, bins)
    parent = boosting._merged(key(np.zeros(500)), g, h)
    light = boosting._merged(key(node)[node == 1], g[node == 1], h[node == 1])
    both = boosting._with_siblings(light, parent, {0: (1, 2)})
    want = boosting._merged(key(node), g, h)
    assert (both["key"] == want["key"]).all() and both["g"] == pytest.approx(want["g"]) and both["h"] == pytest.approx(want["h"])


def test_scores_saved_and_loaded(spark, table, folder):
    model = boosting.fit(table, settings=Settings(rounds=4, depth=3))
    model.save(f"{folder}/trees")
    again = BoostedTrees.load(f"{folder}/trees")
    p = [[r["p"] for r in table.select(m.probability(F.col("features")).alias("p")).collect()] for m in (model, again)]
    assert p[0] == p[1] and all(0 < v < 1 for v in p[0])
    right = sum((r["p"] >= 0.5) == (r["label"] == 1) for r in table.withColumn("p", model.probability(F.col("features"))).collect())
    assert right > 150


def test_nothing_to_split(spark):
    one = spark.createDataFrame([(1, Vectors.dense([1.0])), (1, Vectors.dense([2.0]))], ["label", "features"])
    model = boosting.fit(one, settings=Settings(rounds=3))
    assert len(model.trees) == 1 and model.trees[0].feature == [-1]
    assert Tree().margins(boosting.Columns(3, np.zeros(0, int), np.zeros(1, int), np.zeros(0, int), np.zeros(0))).tolist() == [0, 0, 0]


def test_cells_over_one_task_use_the_free_cores(spark, table, monkeypatch):
    """A little more than one task's cells: in each of the hundreds of passes every core has blocks, and
    every share of the features a partition of its own."""
    seen = {}
    grown = boosting._grown

    def watched(binned, trees, settings, parts):
        seen.update(tasks=binned.rdd.getNumPartitions(), parts=parts)
        return grown(binned, trees, settings, parts)

    monkeypatch.setattr(boosting, "_grown", watched)
    boosting.fit(table, settings=Settings(rounds=1, depth=2), block_rows=20, task_cells=700)
    assert seen["tasks"] >= spark.sparkContext.defaultParallelism
    n = len(seen["parts"])
    rows = spark.createDataFrame([(k,) for k in seen["parts"]], "part int").repartition(n, "part")
    assert n == 4 and rows.select(F.spark_partition_id().alias("p")).distinct().count() == n


def test_sums_of_a_block_in_order():
    """Cells lie by feature and bin, so the sums of several nodes come out by key."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(40, 6)), 1) * (rng.random((40, 6)) < 0.6)
    rows = blocks.Rows(np.zeros(40), np.zeros(40), np.append(0, np.cumsum((x != 0).sum(1))), np.nonzero(x)[1].astype(np.int32), x[x != 0])
    columns = boosting.Columns.of_rows(rows)
    bins = rng.integers(0, 5, len(columns.value)).astype(np.uint8)
    cells = boosting.Cells.of_bins(columns, bins)
    tree = Tree()
    low, high = tree.split(0, 2, 1.0, True)
    y, margin = rng.integers(0, 2, 40).astype(float), rng.normal(size=40)
    got, total = boosting._of_block(tree, [high, low], y, margin, cells)
    p = 1 / (1 + np.exp(-margin))
    node = tree.nodes(cells)
    feature = np.repeat(columns.feature, np.diff(columns.first))
    want = boosting._merged(boosting._keyed(node[columns.row], feature, bins), (p - y)[columns.row], (p * (1 - p))[columns.row])
    assert (got["key"] == want["key"]).all() and got["g"] == pytest.approx(want["g"]) and got["h"] == pytest.approx(want["h"])
    assert total == pytest.approx([(p - y).sum(), (p * (1 - p)).sum()])
    assert len(boosting._of_block(tree, [], y, margin, cells)[0]) == 0


def test_light_features_are_left_out_and_no_split_is_lost(spark, data, table):
    """Both sides of a split hold the least weight, so a feature whose present cells are lighter cannot part a
    node nor any below it; some million cells still grow in one task."""
    x, y = data
    settings = Settings(least_weight=18.0)
    g, h = 0.4 - y, np.full(len(y), 0.24)
    x = x * (np.arange(5) != 4) + x * (np.arange(5) == 4) * (np.arange(len(x)) < 60)[:, None]
    row, f = np.nonzero(x)
    bins = np.clip(np.round(x[row, f] * 10) + 30, 0, 100).astype(int)
    cells = boosting._merged(boosting._keyed(np.zeros(len(row)), f, bins), g[row], h[row])
    kept = boosting.live(cells, settings)
    assert set(np.unique(kept["key"] >> 8).tolist()) == {0, 1, 2, 3} and len(boosting.live(cells[:0], settings)) == 0
    whole, less = (boosting.best_splits(c, {0: (g.sum(), h.sum())}, settings) for c in (cells, kept))
    assert len(whole) == 1 and (whole[["feature", "bin", "absent"]] == less[["feature", "bin", "absent"]]).all()
    light = boosting._merged(boosting._keyed(np.ones(len(row)), f, bins)[row < 50], g[row][row < 50], h[row][row < 50])
    both = boosting._with_siblings(light, kept, {0: (1, 2)})
    assert set(np.unique(both["key"] >> 8 & 0xFFFFFFFF).tolist()) == {0, 1, 2, 3}
    assert boosting.ALONE_CELLS > blocks.TASK_CELLS


def test_table_of_blocks_adds_up_nodes_like_single_blocks(monkeypatch):
    """Nodes of many and of few cells, over several blocks, parts of the features and chunks of rows."""
    monkeypatch.setattr(boosting, "CHUNK_CELLS", 16)
    monkeypatch.setattr(boosting, "CHUNK_SLOTS", 4)
    rng = np.random.default_rng(5)
    data, xs = [], []
    for n in (30, 1, 25):
        x = np.round(rng.normal(size=(n, 6)), 1) * (rng.random((n, 6)) < 0.6)
        rows = blocks.Rows(np.zeros(n), np.zeros(n), np.append(0, np.cumsum((x != 0).sum(1))), np.nonzero(x)[1].astype(np.int32), x[x != 0])
        columns = boosting.Columns.of_rows(rows)
        bins = (np.round(columns.value * 10) + 60).astype(np.uint8)
        data.append((rng.integers(0, 2, n).astype(float), rng.normal(size=n), boosting.Cells.of_bins(columns, bins)))
        xs.append(x)
    x, table = np.concatenate(xs), boosting.Table(data)
    assert len(table.parts) > 3
    g, h = rng.normal(size=len(x)), rng.random(len(x))
    for some in (np.arange(len(x)), np.array([3, 30, 41]), np.arange(0, len(x), 2), np.zeros(0, int)):
        row, f = np.nonzero(x[some])
        want = boosting._merged(boosting._keyed(np.full(len(row), 7), f, (np.round(x[some][row, f] * 10) + 60).astype(int)), g[some][row], h[some][row])
        got = np.concatenate(table.histogram(7, some, g, h))
        assert (got["key"] == want["key"]).all() and got["g"] == pytest.approx(want["g"]) and got["h"] == pytest.approx(want["h"])
        value = x[some, 2]
        left = np.where(value != 0, np.round(value * 10) + 60 <= 58, True)
        assert (table.left(some, 2, 58.0, True) == left).all()
