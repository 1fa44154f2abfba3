from pyspark.sql import functions as F

from lakemill.functions.cleaning import UNICODE_SPACE, has_symbol
from lakemill.operators import quality, silver


def row(df):
    return df.first().asDict()


def test_mixed_profile(spark):
    texts = ["free money now", "free money now", "hello there", "win!!", None]
    df = spark.createDataFrame(list(zip(range(5), texts, [1, 1, 0, 1, 0])), "id int, t string, label int")
    assert row(quality.profile(df, quality.completeness("t")))["null_count"] == 1
    assert row(quality.uniqueness(df, "t"))["duplicate_rate"] == 0.2
    assert row(quality.profile(df, quality.pattern("t")))["special_char_rate"] == 0.2
    assert row(quality.profile(df, quality.label_distribution("label")))["spam_count"] == 3
    top = {r["value"]: r["n_rows"] for r in quality.top_values(df, "t", "id").collect()}
    assert top["free money now"] == 2 and top["None"] == 1


def test_blanks(spark):
    df = spark.createDataFrame([("",), ("   ",), ("unknown",), (None,)], "t string")
    got = row(quality.profile(df, quality.completeness("t")))
    assert got["empty_string_rate"] == 0.25
    assert got["whitespace_rate"] == 0.5
    assert got["placeholder_rate"] == 0.5


def test_one_class_raises_the_flag(spark):
    df = spark.createDataFrame([("x", 1)] * 10, "t string, label int")
    got = row(quality.profile(df, quality.label_distribution("label")))
    assert got["spam_ratio"] == 1.0 and got["drift_flag"]


def test_summary_leaves_out_nested_values(spark):
    df = spark.createDataFrame([("a b", 1), ("c", 0)], "t string, label int")
    rows = quality.summary(df, "t").collect()
    assert "top_duplicates" not in {r["metric"] for r in rows}
    assert {r["category"] for r in rows} == {
        "completeness", "consistency", "uniqueness", "length", "pattern", "semantic", "label_distribution"
    }
    assert "label_distribution" not in {r["category"] for r in quality.summary(df.drop("label"), "t").collect()}


def test_quality_gate(spark):
    bodies = ["word " * 6, "tiny", "word " * 6]
    df = spark.createDataFrame(
        list(zip(["a", "b", "c"], bodies, [1, 0, None], ["m"] * 3)),
        "email_id string, body string, label int, month_partition string",
    )
    got = row(silver.gate_counts(df, min_chars=10, max_chars=20))
    assert (got["final_rows"], got["truncated_rows"], got["dropped_short_body"], got["dropped_null_label"]) == (1, 2, 1, 1)
    kept = silver.silver(df.withColumn("received_at", F.lit(None).cast("timestamp_ntz")), min_chars=10, max_chars=20).collect()
    assert [r["email_id"] for r in kept] == ["a"]
    assert len(kept[0]["body_clean"]) == 20 and kept[0]["char_count"] == 29


def test_drop_reasons_reconcile(spark):
    long = "several words that make this text long enough to pass the gate"
    data = [("a", long, 1), ("b", long, 1), ("c", long + " more", None), ("d", "!!", 0), ("e", "short text", 0), ("f", None, 1)]
    df = spark.createDataFrame([(*d, "m") for d in data], "email_id string, body string, label int, month_partition string")
    got = {r["reason"]: r["n_rows"] for r in silver.drop_reasons(df).collect()}
    assert got == {"kept": 1, "duplicate_text": 1, "invalid_label": 1, "empty_after_clean": 1, "short_text": 1, "null_text": 1}


def test_top_duplicates_per_month(spark):
    rows = [(f"e{i}", "m1", "x" if i < 5 else "y" if i < 8 else f"u{i}") for i in range(10)] + [("f1", "m2", "only")]
    df = spark.createDataFrame(rows, "email_id string, month_partition string, t string")
    got = {r["month_partition"]: [(e["value"], e["n_rows"]) for e in r["top_duplicates"]] for r in quality.top_duplicates(df, "t", "email_id", ["month_partition"]).collect()}
    assert got == {"m1": [("x", 5), ("y", 3)]}


def test_sketched_distinct_counts_of_many_groups_are_within_a_tenth(spark):
    rows = spark.range(1200 * 430).select((F.col("id") % 1200).alias("month"), F.md5(F.col("id").cast("string")).alias("text"))
    found = quality.approx_unique(rows, "text", ["month"])
    assert found.count() == 1200
    assert found.where(F.abs(F.col("n_unique_approx") - 430) > 43).isEmpty()


def test_symbols_are_found_without_a_negated_class(spark):
    codes = spark.range(1, 0x110000).where("id < 55296 OR id > 57343").selectExpr("concat('aZ0 ', decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')) AS t")
    wrong = codes.where(has_symbol(F.col("t")) != F.col("t").rlike(rf"[^a-zA-Z0-9{UNICODE_SPACE}]"))
    assert wrong.isEmpty()
    plan = quality.profile(codes, quality.pattern("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "[^a-zA-Z0-9" not in plan
