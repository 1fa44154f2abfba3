import datetime

import pytest
from pyspark.sql import functions as F

from lakemill.operators import ingest
from lakemill.operators.ranks import row_index
from lakemill.sources import files


def chunk_sizes(spark, n, size=10_000):
    rows = ingest.assign_periods(spark.range(n), "id", size)
    return {r[0]: r[1] for r in rows.groupBy("month_partition").count().collect()}


@pytest.mark.parametrize(
    "header", [(" text ", " Label "), ("message", "category")], ids=["text/label", "message/category"]
)
def test_known_headers(spark, header):
    df = ingest.normalize_columns(spark.createDataFrame([("hi", "ham")], list(header)))
    assert df.columns == ["body", "raw_label"]
    assert df.first() == ("hi", "ham")


def test_unknown_header(spark):
    with pytest.raises(ValueError, match="Unknown columns"):
        ingest.normalize_columns(spark.createDataFrame([("a", "b")], ["subject", "kind"]))


def test_month_labels(spark):
    rows = spark.createDataFrame([(0,), (2,), (14,)], "k int").select(ingest.month_label(F.col("k")))
    assert [r[0] for r in rows.collect()] == ["2024-11", "2025-01", "2026-01"]


def test_short_tail_merges(spark):
    assert chunk_sizes(spark, 14_999) == {"2024-11": 14_999}


def test_half_tail_stays(spark):
    assert chunk_sizes(spark, 15_000) == {"2024-11": 10_000, "2024-12": 5_000}


def test_lone_short_chunk_and_full_chunks(spark):
    assert chunk_sizes(spark, 3, 10) == {"2024-11": 3}
    assert chunk_sizes(spark, 20, 10) == {"2024-11": 10, "2024-12": 10}
    assert chunk_sizes(spark, 24, 10) == {"2024-11": 10, "2024-12": 14}


def test_row_index_is_dense_for_uneven_keys(spark):
    keys = [0, 1, 2, 3, 1_000_000, 1_000_001, 5_000_000_000, 5_000_000_007]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k long")
    got = {r["k"]: r["idx"] for r in row_index(df, "k", n_ranges=3).collect()}
    assert got == {k: i for i, k in enumerate(keys)}


def test_bronze_rows(spark):
    raw = spark.createDataFrame([(1, "b", " Spam "), (0, "a", "ham"), (2, "c", "other")], "doc_id long, body string, raw_label string")
    rows = {r["email_id"]: r for r in ingest.bronze(raw, rows_per_period=10, base="2025-02").collect()}
    assert sorted(rows) == ["email_202502_00000", "email_202502_00001", "email_202502_00002"]
    assert [rows[k]["label"] for k in sorted(rows)] == [0, 1, None]
    for r in rows.values():
        assert datetime.datetime(2025, 2, 1) <= r["received_at"] < datetime.datetime(2025, 3, 1)
    again = {r["email_id"]: r for r in ingest.bronze(raw.repartition(3), rows_per_period=10, base="2025-02").collect()}
    assert again == rows


def test_append_skips_existing_months(spark, folder):
    first = spark.createDataFrame([("a", "2025-01"), ("b", "2025-02")], "v string, month_partition string")
    second = spark.createDataFrame([("x", "2025-02"), ("c", "2025-03")], "v string, month_partition string")
    assert files.append_new_months(first, f"{folder}/t") == ["2025-01", "2025-02"]
    assert files.append_new_months(second, f"{folder}/t") == ["2025-03"]
    table = files.read_table(spark, f"{folder}/t")
    assert sorted(r["v"] for r in table.collect()) == ["a", "b", "c"]
    assert files.months(table, "2025-02") == ["2025-02", "2025-03"]
    with pytest.raises(FileNotFoundError):
        files.months(table, "2030-01")


def test_missing_input(spark, folder):
    assert files.read_table(spark, f"{folder}/nothing") is None
    with pytest.raises(FileNotFoundError):
        files.required(None, "bronze")


def test_digit_like_months_stay_strings(spark, folder):
    df = spark.createDataFrame([("a", "202501")], "v string, month_partition string")
    files.write_months(df, f"{folder}/t")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        table = files.read_table(spark, f"{folder}/t")
        assert dict(table.dtypes)["month_partition"] == "string"
        assert table.first()["month_partition"] == "202501"
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def test_month_filter_prunes_files(spark, folder):
    df = spark.createDataFrame([("a", "2025-01"), ("b", "2025-02")], "v string, month_partition string")
    files.write_months(df, f"{folder}/t")
    plan = files.read_table(spark, f"{folder}/t").where("month_partition <= '2025-01'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_partition" in text
    assert len(plan.inputFiles()) >= 1 and plan.count() == 1


def test_csv_round_trip_keeps_line_breaks(spark, folder):
    rows = spark.createDataFrame([('one\ntwo, "three"', "ham", "2025-01")], "text string, label string, month_partition string")
    files.write_csv(rows, f"{folder}/csv", "month_partition")
    back = files.read_monthly_csv(spark, f"{folder}/csv").collect()
    assert [(r["body"], r["raw_label"], r["month_partition"]) for r in back] == [('one\ntwo, "three"', "ham", "2025-01")]


def test_planted_marker(spark):
    rows = spark.range(2000).select(
        F.format_string("email_%d", "id").alias("email_id"), F.lit("x").alias("body"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") < 1000, "2025-01").otherwise("2025-02").alias("month_partition"),
    )
    hit = ingest.inject_marker(rows, "zzdrift", "2025-02", 0.2).where(F.col("body").contains("zzdrift"))
    assert hit.where("label = 0 or month_partition < '2025-02'").count() == 0
    assert 60 < hit.count() < 140


def test_contract(spark):
    df = spark.createDataFrame([("a", 1)], "email_id string, label int")
    assert files.check_contract(df, {"email_id": "string", "label": "int"}) == []
    assert len(files.check_contract(df, {"email_id": "bigint", "log_chars": "double"})) == 2


def test_labels_with_any_white_space(spark):
    raw = ["spam\t", "ham\n", " spam", " SPAM ", " Ham\r\n", "sp am", "", None]
    rows = spark.createDataFrame([(r,) for r in raw], "r string").select(ingest.label_code(F.col("r")).alias("l")).collect()
    assert [r["l"] for r in rows] == [1, 0, 1, 1, 0, None, None, None]


def test_periods_end_with_the_calendar(spark):
    def label(k):
        return spark.createDataFrame([(k,)], "k int").select(ingest.month_label(F.col("k"))).first()[0]

    assert label(95_701) == "9999-12"
    with pytest.raises(Exception, match="9999-12"):
        label(95_702)


def test_files_of_both_layouts_in_one_folder(spark, folder):
    spark.createDataFrame([("buy now", "spam")], "text string, label string").coalesce(1).write.csv(f"{folder}/a", header=True)
    spark.createDataFrame([("ham", "hello")], "label string, text string").coalesce(1).write.csv(f"{folder}/b", header=True)
    spark.createDataFrame([("ham", "hi")], "Category string, ` Message` string").coalesce(1).write.csv(f"{folder}/c", header=True)
    rows = files.read_raw_csv(spark, f"{folder}/*").collect()
    assert sorted(tuple(r) for r in rows) == [("buy now", "spam"), ("hello", "ham"), ("hi", "ham")]


def test_ranks_with_very_many_shuffle_partitions(spark):
    keys = [(k * 37) % 1009 for k in range(1009)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        plan = row_index(df, "k")
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert {r["k"]: r["idx"] for r in plan.collect()} == {k: k for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_month_of_raw_csv_is_one_file_however_many_tasks_hold_it(spark, folder):
    rows = spark.range(300, numPartitions=6).select(
        F.concat(F.lit("text "), "id").alias("Text"), F.lit("ham").alias("Label"), F.format_string("2025-%02d", F.col("id") % 3 + 1).alias("month_partition"),
    )
    files.write_csv(rows, f"{folder}/csv", "month_partition")
    assert len(spark.read.text(f"{folder}/csv").inputFiles()) == 3
    assert files.read_monthly_csv(spark, f"{folder}/csv").distinct().count() == 300
