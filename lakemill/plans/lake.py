"""The monthly jobs: raw to bronze to silver, gold, training, drift, promotion.

Every stage is one job over all its months and writes its table once; the driver only ever sees
reports, vocabularies and single decision rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.functions.fixed import (
    CANDIDATES,
    DRIFT_GATE,
    DRIFT_MIN_DF,
    DRIFT_TERMS,
    NUMERIC_FEATURES,
    ROWS_PER_PERIOD,
    TARGET_PRECISION,
)
from lakemill.operators import drift, evaluation, ingest, ledger, quality, silver, splits
from lakemill.operators.ledger import Ledger
from lakemill.operators.training import Preparation, SpamModel, train_one
from lakemill.session import durable
from lakemill.sources import files
from lakemill.sources.commits import CommitLog, Generations


@dataclass(frozen=True)
class Lake:
    """Paths of one lake."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def to_bronze(mails: DataFrame, lake: Lake, order: str, rows_per_period: int = ROWS_PER_PERIOD) -> list[str]:
    """Append the months that bronze lacks, with one log row each."""
    spark = mails.sparkSession
    rows = ingest.bronze(mails, order, rows_per_period)
    new = files.append_new_months(rows, lake.path("bronze"))
    if new:
        written = files.read_table(spark, lake.path("bronze")).where(F.col("month_partition").isin(new))
        log = ingest.ingestion_log(written).withColumn("ingested_at", F.current_timestamp())
        log.write.mode("append").parquet(lake.path("ingestion_log"))
    return new


def to_silver(spark: SparkSession, lake: Lake) -> list[str]:
    """Clean and gate the bronze months that silver lacks; one quality report per month."""
    bronze = files.required(files.read_table(spark, lake.path("bronze")), "bronze")
    done = files.read_table(spark, lake.path("silver"))
    if done is not None:
        bronze = ingest.pending(bronze, done)
    # Texts are cleaned once; the table, the gate and the report all read what was written.
    cleaned = durable(silver.truncated(silver.featured(bronze)).drop("body"), "cleaned")
    new = files.append_new_months(silver.stored(silver.gated(cleaned)), lake.path("silver"))
    if new:
        fresh = cleaned.where(F.col("month_partition").isin(new))
        report = quality.quality_report(fresh, silver.gate_counts_of(fresh))
        files.write_reports(durable(report, "reports"), lake.path("quality"))
    return new


#: What the gold job relies on in silver.
CONTRACT = {
    "email_id": "string", "body_clean": "string", "label": "tinyint", "month_partition": "string",
    **dict.fromkeys(("log_chars", "avg_word_length", "unique_word_ratio"), "float"), "exclaim_count": "int",
}


def to_gold(spark: SparkSession, lake: Lake, month: str, **limits) -> tuple[DataFrame, Preparation]:
    """Split months up to `month` (held out), fit features on train, replace the snapshot whole.

    Stops if silver breaks the contract or if a mail is in more than one split.
    """
    rows = files.required(files.read_table(spark, lake.path("silver")), "silver")
    if broken := files.check_contract(rows, CONTRACT):
        raise ValueError(f"silver breaks its contract: {'; '.join(broken)}")
    known = files.months(rows, end=month)
    if month not in known:
        raise ValueError(f"silver has no month {month}")
    if len(known) < 2:
        raise ValueError("a hold-out split needs at least two silver months")
    # A stored month is a partition: this filter prunes files.
    selected = splits.select_features(rows.where(F.col("month_partition") <= month))
    parts = splits.split(selected, month)
    if not splits.leaked_ids(parts.select("email_id", "split")).isEmpty():
        raise ValueError(f"mails of snapshot {month} are in more than one split")
    preparation = Preparation.fit(parts.where(F.col("split") == "train"), **limits)
    keep = ["email_id", "label", "month_partition", *NUMERIC_FEATURES, "tfidf", "features", "split"]
    gold = preparation.transform(parts).select(*keep)
    store = snapshot(lake, month)
    path = store.staged()
    gold.write.partitionBy("split").parquet(path)
    stored = spark.read.parquet(path)
    summary = [r.asDict() for r in splits.split_summary(stored).collect()]  # one row per split
    scaler = preparation.scaler
    store.publish(spark, path, {
        "snapshot": month, "splits": summary, "vocab_size": len(preparation.terms.terms),
        "scaler": [{"feature": f, "mean": float(m), "scale": float(s)} for f, m, s in zip(scaler.features, scaler.mean, scaler.scale)],
    })
    return stored.withColumn("snapshot", F.lit(month)), preparation


def snapshot(lake: Lake, month: str) -> Generations:
    """The generations of one gold snapshot."""
    return Generations(f"{lake.path('gold')}/snapshot={month}")


def read_gold(spark: SparkSession, lake: Lake, month: str, entry: dict | None = None) -> DataFrame:
    """The current generation of a snapshot, or a pinned one; later builds do not change it."""
    return files.required(snapshot(lake, month).read(spark, entry), f"gold snapshot {month}")


BUILD = (
    "snapshot string, generation string, built_at timestamp, vocab_size long, "
    "scaler array<struct<feature: string, mean: double, scale: double>>"
)


def gold_log(spark: SparkSession, lake: Lake, month: str) -> DataFrame:
    """One row per split of every build of a snapshot, from the entries that published them."""
    entries = snapshot(lake, month).log.entries(spark)
    summary = splits.split_summary(read_gold(spark, lake, month)).schema if entries else None
    if summary is None:
        return spark.createDataFrame([], BUILD)
    rows = [
        (e["snapshot"], e["generation"], datetime.fromtimestamp(e["at"]), e["vocab_size"],
         [(s["feature"], s["mean"], s["scale"]) for s in e["scaler"]], *[part[f] for f in summary.names])
        for e in entries for part in e["splits"]
    ]
    build = spark.createDataFrame([], BUILD).schema
    return spark.createDataFrame(rows, StructType([*build.fields, *summary.fields]))


def train(
    spark: SparkSession, lake: Lake, month: str, names: list[str] = CANDIDATES,
    target: float = TARGET_PRECISION, limits: dict | None = None, **sizes,
) -> SpamModel:
    """Train candidates one after the other over one stored feature table; return the winner.

    Every candidate is saved with its model, so that a later run can promote it without training.
    """
    gold, preparation = to_gold(spark, lake, month, **(limits or {}))
    rows = []
    for name in names:
        trained = train_one(name, gold, target, **sizes)
        path = f"{lake.path('candidate_models')}/{month}-{name}-{uuid.uuid4().hex}"
        SpamModel(trained.name, preparation, trained.classifier, trained.threshold).save(spark, path)
        rows.append(trained.row(month) | {"path": path})
    table = durable(spark.createDataFrame(rows).withColumn("trained_at", F.current_timestamp()), "candidates")
    table.write.mode("append").parquet(lake.path("candidates"))
    return SpamModel.load(spark, evaluation.pick_winner(table).first()["path"])


def stored_winner(spark: SparkSession, lake: Lake, month: str) -> DataFrame:
    """Winner among the stored candidates of one snapshot, the newest of each name."""
    rows = files.required(files.read_table(spark, lake.path("candidates")), "candidates")
    rows = rows.where(F.col("snapshot") == month)
    if rows.isEmpty():
        raise ValueError(f"no candidates for snapshot {month}")
    newest = rows.groupBy("name").agg(F.max_by(F.struct(*rows.columns), "trained_at").alias("_r")).select("_r.*")
    return evaluation.pick_winner(newest)


def promote_stored(spark: SparkSession, lake: Lake, month: str, delta: float = 0.0) -> DataFrame:
    """Compare the stored winner of a snapshot with the champion and promote it if it wins; no training."""
    path = stored_winner(spark, lake, month).first()["path"]
    return compare_and_promote(spark, lake, month, SpamModel.load(spark, path), delta)


def drift_report(
    spark: SparkSession, lake: Lake, month: str, ref_start: str, ref_end: str, top_k: int = DRIFT_TERMS
) -> DataFrame:
    """Compare a month with a reference range and append the report row."""
    silver_ = files.required(files.read_table(spark, lake.path("silver")), "silver")
    window = files.months(silver_, ref_start, ref_end)
    files.months(silver_, month, month)
    # Texts are read for the months that the ledger lacks; the report itself reads counted terms only.
    book = Ledger(lake.path("ledger"))
    book.update(silver_)
    tagged = drift.tag_windows(book.documents(spark), ref_start, ref_end, month)
    model = ledger.vocabulary(ledger.window_totals(book.totals(spark), window), DRIFT_MIN_DF, top_k)
    counts = durable(ledger.drift_counts(tagged, model), "term-counts")
    report = drift.drift_report(drift.label_drift(tagged), drift.term_drift(counts)).withColumns(
        {"month": F.lit(month), "first_ref": F.lit(ref_start), "last_ref": F.lit(ref_end),
         "computed_at": F.current_timestamp()}
    )
    report.write.mode("append").parquet(lake.path("drift_reports"))
    stored = spark.read.parquet(lake.path("drift_reports")).where(F.col("month") == month)
    return stored.orderBy(F.desc("computed_at")).limit(1)


REGISTRY = "version int, month string, name string, path string, threshold double"
DECISIONS = "month string, challenger_f1 double, champion_f1 double, promoted boolean, reason string, drift_score double"


def decision_log(lake: Lake) -> CommitLog:
    """Decisions and promotions in one log: a promoted decision and its version are one entry."""
    return CommitLog(lake.path("registry"))


def _promoted(entries: list[dict]) -> list[dict]:
    return [e for e in entries if e.get("version")]


def registry(spark: SparkSession, lake: Lake) -> DataFrame:
    rows = [(e["version"], e["month"], e["name"], e["path"], e["threshold"]) for e in _promoted(decision_log(lake).entries(spark))]
    return spark.createDataFrame(rows, REGISTRY)


def decisions(spark: SparkSession, lake: Lake) -> DataFrame:
    """All decisions in the order they were taken, skipped runs included."""
    names = [f.split()[0] for f in DECISIONS.split(", ")]
    rows = [(e["n"], *[e[c] for c in names]) for e in decision_log(lake).entries(spark) if e.get("reason")]
    return spark.createDataFrame(rows, f"n int, {DECISIONS}")


def saved_model(spark: SparkSession, lake: Lake, month: str, model: SpamModel) -> dict:
    """Save a model under a path of its own; an entry of the log makes it a version."""
    path = f"{lake.path('models')}/{month}-{model.name}-{uuid.uuid4().hex}"
    model.save(spark, path)
    return {"month": month, "name": model.name, "path": path, "threshold": float(model.threshold)}


def next_in(entries: list[dict]) -> int:
    """The version after those of the entries."""
    return 1 + max((e["version"] for e in _promoted(entries)), default=0)


def register(spark: SparkSession, lake: Lake, month: str, model: SpamModel) -> int:
    """Save a model under the next version; it is the champion from then on."""
    saved = saved_model(spark, lake, month, model)
    return decision_log(lake).commit(spark, lambda entries: saved | {"version": next_in(entries)})["version"]


def champion(spark: SparkSession, lake: Lake) -> tuple[SpamModel, float] | None:
    """The model of the latest promotion, with its threshold; None before the first."""
    held = _promoted(decision_log(lake).entries(spark))
    return (SpamModel.load(spark, held[-1]["path"]), held[-1]["threshold"]) if held else None


def current_model(spark: SparkSession, lake: Lake) -> tuple[SpamModel, int]:
    """The champion and its version."""
    held = _promoted(decision_log(lake).entries(spark))
    if not held:
        raise FileNotFoundError("missing input: a promoted model")
    return SpamModel.load(spark, held[-1]["path"]), held[-1]["version"]


def compare_and_promote(
    spark: SparkSession, lake: Lake, month: str, challenger: SpamModel, delta: float = 0.0, drift_score: float | None = None,
) -> DataFrame:
    """Score champion and challenger on the held-out month, each with its own vocabulary.

    Promotion writes a new versioned path and a registry row; otherwise nothing changes.
    """
    test = files.read_table(spark, lake.path("silver")).where(F.col("month_partition") == month)

    def measured(model: SpamModel, threshold: float, role: str) -> DataFrame:
        rows = model.score(test).select(F.col("label").alias("y"), "p")
        return evaluation.evaluate(rows, F.lit(threshold)).withColumns(
            {"role": F.lit(role), "name": F.lit(model.name), "threshold": F.lit(threshold), "month": F.lit(month)}
        )

    own = durable(measured(challenger, challenger.threshold, "challenger"), "comparison")
    saved: dict = {}

    def decided(entries: list[dict]) -> dict:
        """Compare with the champion of these entries; after a lost race there may be another one."""
        held = _promoted(entries)
        metrics = own
        if held:
            metrics = own.unionByName(measured(SpamModel.load(spark, held[-1]["path"]), held[-1]["threshold"], "champion"))
        metrics = durable(metrics, "comparison")
        metrics.write.mode("append").parquet(lake.path("comparisons"))
        verdict = evaluation.promotion(
            metrics.where(F.col("role") == "champion"), metrics.where(F.col("role") == "challenger"), month, delta
        ).first()
        entry = {c: verdict[c] for c in ("month", "challenger_f1", "champion_f1", "promoted", "reason")} | {"drift_score": drift_score}
        if not verdict["promoted"]:
            return entry
        if not saved:
            saved.update(saved_model(spark, lake, month, challenger))
        return entry | saved | {"version": next_in(entries)}

    return _row(spark, decision_log(lake).commit(spark, decided))


def _row(spark: SparkSession, entry: dict) -> DataFrame:
    return spark.createDataFrame([tuple(entry[f.split()[0]] for f in DECISIONS.split(", "))], DECISIONS)


def monthly_run(
    spark: SparkSession, lake: Lake, month: str, ref_start: str, ref_end: str,
    gate: float = DRIFT_GATE, delta: float = 0.0, names: list[str] = CANDIDATES,
    limits: dict | None = None, **sizes,
) -> DataFrame:
    """Silver, drift, gate, then training and promotion; a decision row is written either way."""
    to_silver(spark, lake)
    report = drift.retrain_gate(drift_report(spark, lake, month, ref_start, ref_end), gate).first()
    if report["retrain"]:
        challenger = train(spark, lake, month, names, limits=limits, **sizes)
        decision = compare_and_promote(spark, lake, month, challenger, delta, float(report["drift_score"]))
        return decision.select("month", "promoted", "reason", "drift_score")
    skipped = {
        "month": month, "challenger_f1": None, "champion_f1": None, "promoted": False,
        "reason": "drift below threshold, training skipped", "drift_score": float(report["drift_score"]),
    }
    entry = decision_log(lake).commit(spark, lambda _: skipped)
    return _row(spark, entry).select("month", "promoted", "reason", "drift_score")


def first_load(
    spark: SparkSession, lake: Lake, holdout: str | None = None, names: list[str] = CANDIDATES,
    limits: dict | None = None, **sizes,
) -> DataFrame:
    """Bootstrap: all months to silver, then the first champion; the latest month is held out."""
    to_silver(spark, lake)
    known = files.months(files.required(files.read_table(spark, lake.path("silver")), "silver"))
    month = holdout or known[-1]
    return compare_and_promote(spark, lake, month, train(spark, lake, month, names, limits=limits, **sizes))
