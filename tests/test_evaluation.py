import random
import threading

import pytest
from pyspark.sql import functions as F

from lakemill.functions.numbers import seeded_int
from lakemill.operators import evaluation, training
from lakemill.operators.ranks import exact_quantiles, running_totals, value_counts


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "y int, p double")


FOUR = [(0, 0.1), (0, 0.4), (1, 0.8), (1, 0.9)]


def test_threshold_hits_target(spark):
    got = evaluation.pick_threshold(scored(spark, FOUR), target=0.9).first()
    assert (got["threshold"], got["precision"], got["recall"], got["hit_target"]) == (0.8, 1.0, 1.0, True)


def test_unreachable_target(spark):
    pairs = [(1, 0.1), (0, 0.4), (1, 0.35), (0, 0.8)]
    got = evaluation.pick_threshold(scored(spark, pairs), target=1.1).first()
    assert (got["threshold"], got["precision"], got["recall"], got["hit_target"]) == (1.0, 1.0, 0.0, False)


def test_metrics_at_fixed_threshold(spark):
    got = evaluation.evaluate(scored(spark, FOUR), F.lit(0.75)).first()
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (2, 0, 0, 2)
    assert got["precision"] == got["recall"] == got["f1"] == got["average_precision"] == got["roc_auc"] == 1.0


def test_zero_division_is_zero(spark):
    got = evaluation.evaluate(scored(spark, FOUR), F.lit(0.95)).first()
    assert got["precision"] == got["recall"] == got["f1"] == 0.0


def test_ranking_metrics_with_ties_match_brute_force(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(0, 1), rng.randint(0, 20) / 20) for _ in range(300)]
    got = evaluation.ranking_metrics(scored(spark, pairs)).first()
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted({p for _, p in pairs}, reverse=True):
        tp = sum(p >= t for p in pos)
        recall = tp / len(pos)
        ap += (recall - last) * tp / (tp + sum(p >= t for p in neg))
        last = recall
    assert got["roc_auc"] == pytest.approx(auc) and got["average_precision"] == pytest.approx(ap)


def test_running_totals_with_one_hot_group(spark):
    rng = random.Random(3)
    rows = [("hot", float(i), rng.randint(1, 5)) for i in range(400)] + [("cold", 1.5, 2), (None, 2.5, 3), (None, 3.5, 4)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = {(r["g"], r["v"]): (r["n_before"], r["n_total"]) for r in running_totals(df, "v", ["n"], ["g"], 7).collect()}
    assert len(got) == len(rows)
    for g, v, _ in rows:
        same = [(a, n) for h, a, n in rows if h == g]
        assert got[(g, v)] == (sum(n for a, n in same if a < v), sum(n for _, n in same))


def test_exact_quantiles_interpolate(spark):
    rng = random.Random(8)
    data = [round(rng.lognormvariate(0, 2), 2) for _ in range(501)] + [0.0] * 200
    df = spark.createDataFrame([(x,) for x in data], "v double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 0.995, 1.0]
    got = exact_quantiles(value_counts(df, "v"), "v", shares, n_ranges=16).first()
    s = sorted(data)
    for share, q in zip(shares, got["q"]):
        h = (len(s) - 1) * share
        lo = int(h)
        hi = min(lo + 1, len(s) - 1)
        assert q == pytest.approx(s[lo] + (s[hi] - s[lo]) * (h - lo))


def candidates(spark, rows):
    return spark.createDataFrame(rows, "name string, hit_target boolean, recall double, average_precision double")


def test_winner_has_best_recall_among_hits(spark):
    rows = [("lr", True, 0.7, 0.99), ("nb", False, 0.95, 0.9), ("rf", True, 0.8, 0.9)]
    assert evaluation.pick_winner(candidates(spark, rows)).first()["name"] == "rf"


def test_winner_falls_back_to_average_precision(spark):
    rows = [("lr", False, 0.9, 0.7), ("nb", False, 0.1, 0.9), ("rf", False, 0.5, 0.8)]
    assert evaluation.pick_winner(candidates(spark, rows)).first()["name"] == "nb"


def test_winner_tie_goes_to_the_first_listed(spark):
    rows = [("rf", True, 0.8, 0.9), ("lr", True, 0.8, 0.8)]
    assert evaluation.pick_winner(candidates(spark, rows)).first()["name"] == "lr"


def test_promotion_rules(spark):
    f1 = lambda x: spark.createDataFrame([(x,)], "f1 double")
    none = f1(0.0).where("false")
    assert evaluation.promotion(none, f1(0.1), "m").first()["promoted"]
    assert evaluation.promotion(f1(0.5), f1(0.5), "m").first()["promoted"]
    assert not evaluation.promotion(f1(0.5), f1(0.5), "m", 0.01).first()["promoted"]


def test_version_numbers_start_at_one(spark):
    empty = spark.createDataFrame([], "version int")
    assert evaluation.next_version(empty).first()["version"] == 1
    assert evaluation.next_version(spark.createDataFrame([(3,), (7,)], "version int")).first()["version"] == 8


def test_forests_of_all_folds_grow_at_once_and_keep_the_nodes_of_their_rows(spark, monkeypatch):
    rows = spark.range(400).selectExpr("cast(id AS string) AS email_id", "cast(id % 2 AS int) AS label", "id % 2 + rand(3) AS a", "rand(4) AS b")
    waiting, fit, models = threading.Barrier(3, timeout=60), training.fitted, []

    def fitted(*args, **kwargs):
        waiting.wait()  # passes only if every fold has begun
        models.append(fit(*args, **kwargs))
        return models[-1]

    monkeypatch.setattr(training, "fitted", fitted)
    got = {r["model"]: r for r in training.cross_validated_f1(rows, features=["a", "b"], folds=3, trees=5, depth=4).collect()}
    assert len(models) == 3 and all(m.getCacheNodeIds() for m in models)
    monkeypatch.undo()
    tagged = training.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        rows.withColumn("_fold", seeded_int(F.col("email_id"), training.SEED, 17) % 3)
    )
    alone = [fit("rf", tagged.where(F.col("_fold") != k), "features", trees=5, depth=4) for k in range(3)]
    assert sorted(m.toDebugString.partition("\n")[2] for m in models) == sorted(m.toDebugString.partition("\n")[2] for m in alone)
    assert 0.8 < got["rf"]["mean_f1"] <= 1
