"""Ranking metrics, threshold choice and model selection over scored rows (y, p).

Scores are collapsed to distinct values first; running totals over them come from the ranged
prefix sums, so no metric sorts a whole table in one task. `by` lists the columns that name a
model; all frames carry them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.fixed import CANDIDATES, TARGET_PRECISION
from lakemill.functions.numbers import safe_div
from lakemill.operators.ranks import running_totals

METRICS = ["precision", "recall", "f1", "average_precision", "roc_auc"]


def score_points(scored: DataFrame, by: list[str] = [], y: str = "y", p: str = "p") -> DataFrame:
    """Per distinct score: rows at it, below it and in total, by class."""
    points = scored.groupBy(*by, p).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    return running_totals(points, p, ["pos", "neg"], by).withColumnRenamed(p, "threshold")


def _at_or_above(c: str) -> Column:
    return F.col(f"{c}_total") - F.col(f"{c}_before")


def pr_points(points: DataFrame, by: list[str] = []) -> DataFrame:
    """Precision and recall when predicting `score >= threshold`, one row per distinct score."""
    tp, fp = _at_or_above("pos"), _at_or_above("neg")
    return points.select(
        *by,
        "threshold",
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, F.col("pos_total"), 1.0).alias("recall"),
    )


def pr_curve(scored: DataFrame, by: list[str] = [], y: str = "y", p: str = "p") -> DataFrame:
    """The curve's points plus its end (precision 1, recall 0), whose threshold is 1."""
    curve = pr_points(score_points(scored, by, y, p), by).withColumn("is_end", F.lit(False))
    ends = scored.groupBy(*by).agg(
        F.lit(1.0).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(True).alias("is_end"),
    )
    return curve.unionByName(ends)


def pick_threshold(
    scored: DataFrame, by: list[str] = [], target: float = TARGET_PRECISION, y: str = "y", p: str = "p"
) -> DataFrame:
    """Smallest threshold with precision >= target, with its precision and recall.

    When no point reaches the target, the first point of highest precision and hit_target false.
    """
    curve = pr_curve(scored, by, y, p)
    point = F.struct("threshold", "is_end", "precision", "recall")
    hit = F.min(F.when(F.col("precision") >= target, point))
    fallback = F.min_by(point, F.struct(-F.col("precision"), F.col("threshold"), F.col("is_end")))
    return (
        curve.groupBy(*by)
        .agg(hit.alias("_hit"), fallback.alias("_fallback"))
        .select(*by, F.coalesce("_hit", "_fallback").alias("_pick"), F.col("_hit").isNotNull().alias("hit_target"))
        .select(*by, "_pick.threshold", "_pick.precision", "_pick.recall", "hit_target")
    )


def confusion(scored: DataFrame, threshold: Column, by: list[str] = [], y: str = "y", p: str = "p") -> DataFrame:
    """tn, fp, fn, tp when predicting `p >= threshold`."""
    spam, predicted = F.col(y) == 1, F.col(p) >= threshold
    return scored.groupBy(*by).agg(
        F.count_if(~spam & ~predicted).alias("tn"),
        F.count_if(~spam & predicted).alias("fp"),
        F.count_if(spam & ~predicted).alias("fn"),
        F.count_if(spam & predicted).alias("tp"),
    )


def rates() -> dict[str, Column]:
    """precision, recall, f1 and accuracy of confusion counts; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "precision": safe_div(tp, tp + fp),
        "recall": safe_div(tp, tp + fn),
        "f1": safe_div(2 * tp, 2 * tp + fp + fn),
        "accuracy": safe_div(tp + tn, tn + fp + fn + tp),
    }


def ranking_metrics(scored: DataFrame, by: list[str] = [], y: str = "y", p: str = "p") -> DataFrame:
    """Step-wise average precision and tie-averaged ROC area."""
    tp, fp, pos, neg = _at_or_above("pos"), _at_or_above("neg"), F.col("pos"), F.col("neg")
    precision = safe_div(tp, tp + fp)
    step = safe_div(pos, F.col("pos_total")) * precision
    wins = pos * (F.col("neg_before") + neg / 2.0)
    return (
        score_points(scored, by, y, p)
        .groupBy(*by)
        .agg(
            F.sum(step).alias("average_precision"),
            safe_div(
                F.sum(wins), F.max("pos_total").cast("double") * F.max("neg_total"), float("nan")
            ).alias("roc_auc"),
        )
    )


def evaluate(
    scored: DataFrame, threshold: Column, by: list[str] = [], y: str = "y", p: str = "p"
) -> DataFrame:
    """All metrics at a threshold, one row per model."""
    counts = confusion(scored, threshold, by, y, p).withColumns(rates())
    ranking = ranking_metrics(scored, by, y, p)
    if by:
        return counts.join(ranking, by)
    one = F.struct(*ranking.columns)
    return counts.select("*", ranking.select(one).scalar().alias("_r")).select(*counts.columns, "_r.*")


def pick_winner(candidates: DataFrame, order: list[str] = CANDIDATES) -> DataFrame:
    """The winning candidate row (name, hit_target, recall, average_precision).

    Highest recall among those that hit the target, else highest average precision; ties go to
    the first in `order`.
    """
    place = F.coalesce(F.array_position(F.lit(order), F.col("name")), F.lit(0))
    place = F.when(place == 0, F.lit(len(order) + 1)).otherwise(place)
    quality = F.when(F.col("hit_target"), F.col("recall")).otherwise(F.col("average_precision"))
    rule = F.when(F.col("hit_target"), "highest recall at target precision").otherwise(
        "no candidate hit the target; highest average precision"
    )
    return (
        candidates.withColumn("reason", rule)
        .orderBy(F.desc("hit_target"), quality.desc(), place)
        .limit(1)
    )


def model_comparison(scored: DataFrame, by: list[str] = ["model"], threshold: float = 0.5) -> DataFrame:
    """Models side by side, best average precision first."""
    table = evaluate(scored, F.lit(threshold), by)
    return table.select(*by, "precision", "recall", "f1", "average_precision", "accuracy").orderBy(
        F.desc("average_precision")
    )


def promotion(
    champion: DataFrame, challenger: DataFrame, month: str, delta: float = 0.0
) -> DataFrame:
    """Decision row from one-row metric frames (f1); an empty champion frame means auto-promotion."""
    held = champion.select(F.col("f1").alias("champion_f1")).agg(F.max("champion_f1")).scalar()
    rows = challenger.select(F.lit(month).alias("month"), F.col("f1").alias("challenger_f1"), held.alias("champion_f1"))
    first = F.col("champion_f1").isNull()
    wins = first | (F.col("challenger_f1") - F.col("champion_f1") >= F.lit(delta))
    reason = (
        F.when(first, "no champion yet")
        .when(wins, F.format_string("challenger f1 %.4f >= champion f1 %.4f + %.4f", "challenger_f1", "champion_f1", F.lit(float(delta))))
        .otherwise(F.format_string("challenger f1 %.4f < champion f1 %.4f + %.4f", "challenger_f1", "champion_f1", F.lit(float(delta))))
    )
    return rows.withColumn("promoted", wins).withColumn("reason", reason)


def next_version(registry: DataFrame) -> DataFrame:
    return registry.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("version"))
