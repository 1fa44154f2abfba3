import pytest
from pyspark.sql import functions as F

from lakemill.plans import lake as jobs
from lakemill.sources import files

WORDS = {
    1: "free cash prize offer winner lottery casino urgent deal claim your money today",
    0: "meeting agenda project report schedule review team budget notes friday lunch plan",
}


def mails(spark, n=240):
    spam = (F.col("id") * 7) % 5 < 2
    base = F.when(spam, WORDS[1]).otherwise(WORDS[0])
    text = F.concat_ws(" ", base, F.format_string("topic%d number%d", F.col("id") % 11, F.col("id") % 17), F.when(F.col("id") % 13 == 0, "free report"))
    return spark.range(n).select(
        F.col("id").alias("doc_id"), text.alias("body"), F.when(spam, "spam").otherwise("ham").alias("raw_label")
    )


LIMITS = {"min_df": 2, "max_terms": 200}


def test_monthly_cycle(spark, folder):
    lake = jobs.Lake(folder)
    assert jobs.to_bronze(mails(spark), lake, "doc_id", 60) == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert jobs.to_bronze(mails(spark), lake, "doc_id", 60) == []
    assert jobs.to_silver(spark, lake) == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert jobs.to_silver(spark, lake) == []
    assert spark.read.parquet(lake.path("ingestion_log")).count() == 4
    report = spark.read.json(f"{lake.path('quality')}/report")
    assert report.count() == 4 and "quality_metrics" in report.columns
    assert "quality_metrics" not in spark.read.json(f"{lake.path('quality')}/log").columns

    with pytest.raises(ValueError):
        jobs.to_gold(spark, lake, "2030-01")
    with pytest.raises(ValueError):
        jobs.to_gold(spark, lake, "2024-11")

    first = jobs.first_load(spark, lake, "2025-01", ["lr", "nb"], LIMITS).first()
    assert first["promoted"] and first["champion_f1"] is None
    model, threshold = jobs.champion(spark, lake)
    assert model.threshold == threshold and 0 < threshold <= 1
    winner = jobs.stored_winner(spark, lake, "2025-01").first()
    assert winner["name"] == model.name
    with pytest.raises(ValueError):
        jobs.stored_winner(spark, lake, "2020-01")

    closed = jobs.monthly_run(spark, lake, "2025-02", "2024-11", "2025-01", gate=2.0).first()
    assert not closed["promoted"] and "skipped" in closed["reason"]
    assert jobs.registry(spark, lake).count() == 1

    opened = jobs.monthly_run(spark, lake, "2025-02", "2024-11", "2025-01", gate=0.0, names=["lr"], limits=LIMITS, delta=2.0).first()
    assert not opened["promoted"]
    assert jobs.registry(spark, lake).count() == 1
    promoted = jobs.monthly_run(spark, lake, "2025-02", "2024-11", "2025-01", gate=0.0, names=["lr"], limits=LIMITS, delta=-2.0).first()
    assert promoted["promoted"]
    assert [r["version"] for r in jobs.registry(spark, lake).orderBy("version").collect()] == [1, 2]
    roles = {r["role"] for r in spark.read.parquet(lake.path("comparisons")).where("month = '2025-02'").collect()}
    assert roles == {"champion", "challenger"}


def test_drift_report_refuses_overlap_and_gaps(spark, folder):
    lake = jobs.Lake(folder)
    jobs.to_bronze(mails(spark, 120), lake, "doc_id", 60)
    jobs.to_silver(spark, lake)
    with pytest.raises(ValueError, match="overlaps"):
        jobs.drift_report(spark, lake, "2024-11", "2024-11", "2024-12")
    with pytest.raises(FileNotFoundError):
        jobs.drift_report(spark, lake, "2024-12", "2020-01", "2020-02")


def test_silver_types(spark, folder):
    lake = jobs.Lake(folder)
    jobs.to_bronze(mails(spark, 60), lake, "doc_id", 60)
    jobs.to_silver(spark, lake)
    contract = {"email_id": "string", "label": "tinyint", "char_count": "int", "log_chars": "float", "month_partition": "string", "received_at": "timestamp_ntz"}
    assert files.check_contract(files.read_table(spark, lake.path("silver")), contract) == []


def test_gold_job_guards_and_replaces_its_snapshot(spark, folder, monkeypatch):
    lake = jobs.Lake(folder)
    jobs.to_bronze(mails(spark, 180), lake, "doc_id", 60)
    jobs.to_silver(spark, lake)
    gold, _ = jobs.to_gold(spark, lake, "2025-01", **LIMITS)
    assert {r["split"] for r in gold.select("split").distinct().collect()} == {"train", "val", "test"}
    log = jobs.gold_log(spark, lake, "2025-01").first()
    assert [s["feature"] for s in log["scaler"]] == jobs.NUMERIC_FEATURES and len(log["months"]) >= 1
    monkeypatch.setitem(jobs.CONTRACT, "label", "string")
    with pytest.raises(ValueError, match="contract"):
        jobs.to_gold(spark, lake, "2025-01", **LIMITS)
    monkeypatch.setitem(jobs.CONTRACT, "label", "tinyint")
    monkeypatch.setattr(jobs.splits, "leaked_ids", lambda df: df)
    with pytest.raises(ValueError, match="more than one split"):
        jobs.to_gold(spark, lake, "2025-01", **LIMITS)


def test_promotion_from_stored_candidates_and_one_table_of_decisions(spark, folder):
    lake = jobs.Lake(folder)
    jobs.to_bronze(mails(spark, 180), lake, "doc_id", 60)
    jobs.first_load(spark, lake, "2024-12", ["lr"], LIMITS)
    jobs.train(spark, lake, "2025-01", ["lr", "nb"], limits=LIMITS)
    jobs.train(spark, lake, "2025-01", ["lr", "nb"], limits=LIMITS)
    stored = spark.read.parquet(lake.path("candidates")).where("snapshot = '2025-01'")
    assert stored.count() == 4 and stored.select("path").distinct().count() == 4
    newest = stored.groupBy("name").agg(F.max_by("path", "trained_at").alias("path"))
    assert jobs.stored_winner(spark, lake, "2025-01").first()["path"] in {r["path"] for r in newest.collect()}
    assert jobs.promote_stored(spark, lake, "2025-01", delta=-2.0).first()["promoted"]
    assert jobs.registry(spark, lake).count() == 2
    jobs.monthly_run(spark, lake, "2025-01", "2024-11", "2024-12", gate=2.0)
    rows = jobs.decisions(spark, lake).orderBy("n").collect()
    assert [r["promoted"] for r in rows] == [True, True, False] and "skipped" in rows[2]["reason"]


def test_threshold_can_be_given(spark, folder):
    from lakemill.operators.training import evaluate_months

    lake = jobs.Lake(folder)
    jobs.to_bronze(mails(spark, 180), lake, "doc_id", 60)
    jobs.first_load(spark, lake, "2025-01", ["lr"], LIMITS)
    model, _ = jobs.champion(spark, lake)
    silver = files.read_table(spark, lake.path("silver"))
    none = evaluate_months(model, silver, "2025-01", threshold=1.1).first()
    assert (none["tp"], none["fp"]) == (0, 0) and evaluate_months(model, silver, "2025-01").first()["tp"] > 0


def test_written_frames_can_be_released(spark, monkeypatch, tmp_path):
    from lakemill import session

    monkeypatch.setattr(session, "_MADE", [])
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    df = session.durable(spark.range(5), "released")
    assert df.count() == 5 and session.release(spark) == 1
    assert not list((tmp_path / "lakemill").glob("released-*"))
