"""Classifier candidates, training with threshold choice, and whole-pipeline models."""

from __future__ import annotations

import json
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    NaiveBayes,
    NaiveBayesModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.fixed import BASELINE_FEATURES, SEED, TARGET_PRECISION
from lakemill.functions.numbers import seeded_int
from lakemill.operators import blocks, boosting, linear
from lakemill.operators.boosting import BoostedTrees
from lakemill.operators.evaluation import confusion, evaluate, pick_threshold, rates
from lakemill.operators.linear import LinearModel
from lakemill.operators.scaling import ScalerModel
from lakemill.operators.terms import TermModel, add_terms
from lakemill.session import durable

# Naive Bayes needs non-negative input, so it sees the text block only.
TEXT_ONLY = {"nb"}
MODEL_CLASSES = {
    "lr": LinearModel,
    "nb": NaiveBayesModel,
    "rf": RandomForestClassificationModel,
    "hgb": BoostedTrees,
}
#: Bytes of dense rows in a partition of a forest's input.
DENSE_BYTES = 128 << 20
#: Other names a candidate may be asked for by.
ALIASES = {"xgb": "hgb", "gbt": "hgb"}
Classifier = Model | LinearModel | BoostedTrees


def features_column(name: str) -> str:
    return "tfidf" if name in TEXT_ONLY else "features"


def vector_size(df: DataFrame, column: str) -> int:
    v = F.unwrap_udt(column)
    row = df.select(F.coalesce(v["size"], F.size(v["values"])).alias("n")).first()
    if row is None:
        raise ValueError("no rows to learn from")
    return row["n"]


def spread(train: DataFrame, width: int) -> DataFrame:
    """Rows in so many partitions that none is large when its vectors lie dense, as the forest keeps them:
    four bytes per feature, zeros included."""
    n = -(-train.count() * 4 * width // DENSE_BYTES)
    return train.repartition(n) if n > train.rdd.getNumPartitions() else train


def fitted(
    name: str, train: DataFrame, column: str | None = None, trees: int = 100, depth: int = 20, rounds: int = 100, seed: int = SEED,
) -> Classifier:
    """Candidate by name, learned from `label` and a vector column."""
    column = column or features_column(name)
    if name == "lr":
        held = blocks.packed(train, column)
        model, _ = linear.logistic(held, vector_size(train, column))
        held.unpersist()
        return model
    if name == "hgb":
        return boosting.fit(train, column, settings=boosting.Settings(rounds=rounds))
    common = {"featuresCol": column, "labelCol": "label"}
    if name == "nb":
        return NaiveBayes(modelType="multinomial", smoothing=1.0, **common).fit(train)
    if name == "rf":
        # Rows keep the node they are in, else every level walks all trees again from their roots.
        forest = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True, **common
        )
        return forest.fit(spread(train, vector_size(train, column)))
    raise ValueError(f"unknown candidate {name}")


def scored(model: Classifier, df: DataFrame, column: str = "features") -> DataFrame:
    """Add `p`, the probability of spam."""
    if not isinstance(model, Model):
        return df.withColumn("p", model.probability(F.col(column)))
    out = model.transform(df).withColumn("p", vector_to_array(F.col("probability"))[1])
    return out.drop("rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class Preparation:
    """Fitted text and numeric features; the same for every candidate of a snapshot."""

    terms: TermModel
    scaler: ScalerModel
    grams: tuple[int, int] = (1, 2)

    @classmethod
    def fit(cls, train: DataFrame, grams: tuple[int, int] = (1, 2), **limits) -> Preparation:
        terms = TermModel.fit(add_terms(train, "body_clean", grams), **limits)
        return cls(terms, ScalerModel.fit(train), grams)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `tfidf` and `features`; expects body_clean and the numeric features."""
        rows = self.terms.vectors(add_terms(df, "body_clean", self.grams)).drop("terms")
        return self.scaler.vectors(rows)


@dataclass(frozen=True)
class SpamModel:
    """Preparation, classifier and threshold: scores cleaned text with its own vocabulary."""

    name: str
    preparation: Preparation
    classifier: Classifier
    threshold: float

    def score(self, df: DataFrame) -> DataFrame:
        return scored(self.classifier, self.preparation.transform(df)).drop("tfidf", "features")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write to a new path; nothing is ever replaced in place."""
        if isinstance(self.classifier, Model):
            self.classifier.write().save(f"{path}/classifier")
        else:
            self.classifier.save(f"{path}/classifier")
        meta = {
            "name": self.name,
            "threshold": self.threshold,
            "grams": list(self.preparation.grams),
            "features": list(self.preparation.scaler.features),
            "mean": list(self.preparation.scaler.mean),
            "scale": list(self.preparation.scaler.scale),
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.parquet(f"{path}/meta")
        terms = self.preparation.terms
        rows = list(zip(range(len(terms.terms)), terms.terms, terms.idf))
        spark.createDataFrame(rows, "idx int, term string, idf double").coalesce(1).write.parquet(f"{path}/terms")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SpamModel:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        rows = spark.read.parquet(f"{path}/terms").orderBy("idx").collect()
        terms = TermModel(tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows))
        scaler = ScalerModel(tuple(meta["features"]), tuple(meta["mean"]), tuple(meta["scale"]))
        return cls(
            meta["name"],
            Preparation(terms, scaler, tuple(meta["grams"])),
            MODEL_CLASSES[meta["name"]].load(f"{path}/classifier"),
            meta["threshold"],
        )


def evaluate_months(model: SpamModel, rows: DataFrame, start: str, threshold: float | None = None) -> DataFrame:
    """Metrics of a model on the silver months from `start` on, at its own threshold or at a given one."""
    recent = model.score(rows.where(F.col("month_partition") >= start)).select(F.col("label").alias("y"), "p")
    return evaluate(recent, F.lit(float(model.threshold if threshold is None else threshold)))


@dataclass(frozen=True)
class Candidate:
    name: str
    classifier: Classifier
    threshold: float
    hit_target: bool
    val: dict
    test: dict

    def row(self, snapshot: str) -> dict:
        metrics = ["precision", "recall", "f1", "average_precision", "roc_auc"]
        return {
            "snapshot": snapshot,
            "name": self.name,
            "feature_subset": "tfidf_only" if self.name in TEXT_ONLY else "full",
            "threshold": float(self.threshold),
            "hit_target": bool(self.hit_target),
            "recall": float(self.val["recall"]),
            "average_precision": float(self.val["average_precision"]),
            **{f"val_{m}": float(self.val[m]) for m in metrics},
            **{f"test_{m}": float(self.test[m]) for m in metrics},
        }


def train_one(name: str, gold: DataFrame, target: float = TARGET_PRECISION, **sizes) -> Candidate:
    """Fit on train, choose the threshold on val, measure on val and test.

    `gold` carries split, label, tfidf and features; write or cache it once for all candidates.
    """
    name = ALIASES.get(name, name)
    model = fitted(name, gold.where(F.col("split") == "train"), **sizes)
    # Threshold and metrics pass over the scores several times; the model runs once.
    rows = durable(
        scored(model, gold.where(F.col("split") != "train")).select("split", F.col("label").cast("int").alias("y"), "p"), "scores"
    )
    pick = pick_threshold(rows.where(F.col("split") == "val").drop("split"), target=target).first()
    metrics = {r["split"]: r.asDict() for r in evaluate(rows, F.lit(pick["threshold"]), ["split"]).collect()}
    return Candidate(name, model, pick["threshold"], pick["hit_target"], metrics["val"], metrics["test"])


def calibrated_svm(train: DataFrame, key: str, folds: int = 5, seed: int = SEED) -> LinearModel:
    """Squared-hinge margins of each fold's complement, calibrated on the fold; their mean probability.

    All folds learn in the same passes."""
    held = blocks.packed(train, fold=seeded_int(F.col(key), seed, 9) % folds)
    model, _ = linear.calibrated_svm(held, vector_size(train, "features"), folds)
    held.unpersist()
    return model


def cross_validated_f1(
    rows: DataFrame,
    key: str = "email_id",
    features: list[str] = BASELINE_FEATURES,
    folds: int = 5,
    trees: int = 100,
    depth: int = 20,
    seed: int = SEED,
) -> DataFrame:
    """(model, mean_f1, std_f1) of logistic regression and a forest on the numeric features.

    The folds' forests grow side by side: the levels of one alone leave cores idle."""
    tagged = rows.withColumn("_fold", (seeded_int(F.col(key), seed, 17) % folds).cast("int"))
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(tagged).select("_fold", "label", "features")
    held = blocks.packed(assembled, fold=F.col("_fold"))
    results = [("lr", f) for f in linear.fold_f1(held, len(features), folds)]
    held.unpersist()

    def forest_f1(fold: int) -> float:
        model = fitted("rf", assembled.where(F.col("_fold") != fold), "features", trees=trees, depth=depth, seed=seed)
        out = scored(model, assembled.where(F.col("_fold") == fold)).withColumn("y", F.col("label"))
        return confusion(out, F.lit(0.5)).withColumns(rates()).first()["f1"]

    with ThreadPool(folds) as pool:
        results += [("rf", f) for f in pool.map(inheritable_thread_target(rows.sparkSession)(forest_f1), range(folds))]
    made = rows.sparkSession.createDataFrame(results, "model string, f1 double")
    return made.groupBy("model").agg(F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"))
