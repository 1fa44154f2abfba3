import base64

import pytest
from pyspark.sql import functions as F

from lakemill.functions.messages import header, input_text, log_probability, one_line
from lakemill.operators import messages


def b64(text):
    return base64.urlsafe_b64encode(text.encode()).decode()


@pytest.mark.parametrize(
    "subject, body, want",
    [("Hi", "there", "Hi there"), (None, "body", "body"), ("subject", "", "subject"), ("", None, ""), (" ", "\t", "")],
)
def test_input_text(spark, subject, body, want):
    df = spark.createDataFrame([(subject, body)], "s string, b string")
    assert df.select(input_text(F.col("s"), F.col("b"))).first()[0] == want


def parts(spark, *rows):
    return spark.createDataFrame(list(rows), "message_id string, part_no int, mime string, data string")


def test_plain_is_preferred_over_html(spark):
    df = parts(spark, ("m", 0, "multipart/alternative", None), ("m", 1, "text/html", b64("<p>h</p>")), ("m", 2, "text/plain", b64("plain ~~??>>")))
    assert messages.bodies(df).first()["body"] == "plain ~~??>>"


def test_nested_html_and_missing_body(spark):
    df = parts(spark, ("a", 0, "multipart/mixed", None), ("a", 3, "text/html", b64("<i>x</i>")), ("b", 0, "multipart/mixed", None))
    assert {r["message_id"]: r["body"] for r in messages.bodies(df).collect()} == {"a": "<i>x</i>", "b": ""}


def test_own_data_wins_and_bad_data_is_empty(spark):
    df = parts(spark, ("a", 0, "text/plain", b64("own")), ("a", 1, "text/plain", b64("other")), ("b", 0, "text/plain", "%%%"), ("c", 1, "text/plain", "!"), ("c", 2, "text/plain", b64("second")))
    assert {r["message_id"]: r["body"] for r in messages.bodies(df).collect()} == {"a": "own", "b": "", "c": "second"}


def test_header_lookup(spark):
    df = spark.createDataFrame([([("FROM", "a"), ("suBJect", "one"), ("Subject", "two")],), ([],)], "h array<struct<name:string,value:string>>")
    assert [r[0] for r in df.select(header(F.col("h"), "Subject")).collect()] == ["two", ""]


def test_first_occurrence_of_a_hot_id(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("message_id"),
        (1000 - F.col("id")).alias("at"), F.col("id").alias("payload"),
    )
    rows = {r["message_id"]: r for r in messages.first_occurrences(df, "at").collect()}
    assert len(rows) == 667 and rows["hot"]["payload"] == 999


def decided(spark):
    df = spark.createDataFrame(
        [("1", "S\nx", "win cash now\r", 0.987654321), ("2", "", "!!!", 0.9), ("3", None, "hello there", 0.2), ("4", " ", None, 0.5)],
        "message_id string, subject string, body string, p double",
    )
    return messages.blank(df), messages.decided(messages.prepared(df), F.lit(0.8))


def test_decisions(spark):
    rejected, rows = decided(spark)
    assert [r["message_id"] for r in rejected.collect()] == ["4"]
    got = {r["message_id"]: r for r in rows.collect()}
    assert got["1"]["label"] == "spam"
    assert (got["2"]["label"], got["2"]["spam_probability"], got["2"]["threshold"]) == ("not_spam", 0.0, 0.8)
    assert "no usable tokens" in got["2"]["note"]
    assert got["3"]["label"] == "not_spam" and got["3"]["note"] is None


def test_logs(spark):
    _, rows = decided(spark)
    at = F.lit("2025-01-01 10:00:00").cast("timestamp_ntz")
    log = {r["prediction"]: r for r in messages.prediction_log(rows, at).collect()}
    assert log["spam"]["subject"] == "S x" and log["spam"]["body"] == "win cash now "
    assert log["spam"]["spam_probability"] == "0.987654"
    mail = messages.mail_log(rows.withColumn("snippet", F.repeat(F.lit("ab"), F.lit(150))), at, F.col("message_id") == "3")
    assert mail.columns == ["timestamp", "message_id", "subject", "snippet", "prediction", "spam_probability", "applied_label"]
    got = {r["message_id"]: r for r in mail.collect()}
    assert len(got["1"]["snippet"]) == 200
    assert [got[k]["applied_label"] for k in "123"] == ["AI_SPAM", "AI_HAM", "ERROR"]
    summary = messages.feed_summary(mail, F.lit("2025-01-01").cast("date")).first()
    assert tuple(summary) == (3, 1, 2, 3)
    assert messages.recent_feed(mail, 2).count() == 2


def test_small_columns(spark):
    row = spark.range(1).select(one_line(F.lit("a\r\nb")), log_probability(F.lit(0.1234567))).first()
    assert tuple(row) == ("a  b", "0.123457")


def test_nested_parts_in_depth_first_order(spark):
    code = lambda t: base64.urlsafe_b64encode(t.encode()).decode()
    rows = [
        ("a", "r", None, 0, "multipart/mixed", None), ("a", "1", "r", 1, "text/plain", code("late")),
        ("a", "0", "r", 0, "multipart/alternative", ""), ("a", "0.0", "0", 0, "text/html", code("<p>")), ("a", "0.1", "0", 1, "text/plain", code("deep")),
        ("b", "r", None, 0, "text/plain", code("own")), ("b", "0", "r", 0, "text/plain", code("other")),
        ("c", "r", None, 0, "multipart/mixed", None), ("c", "0", "r", 0, "text/html", code("only html")),
        ("d", "r", None, 0, "multipart/mixed", None), ("d", "x", "gone", 0, "text/plain", code("lost")),
    ]
    rows += [("e", "0", None, 0, "multipart/mixed", None)]
    rows += [("e", str(k + 1), str(k), 0, "text/plain" if k == 11 else "multipart/mixed", code("bottom") if k == 11 else None) for k in range(12)]
    parts = spark.createDataFrame(rows, "message_id string, part_id string, parent_id string, place int, mime string, data string")
    got = {r["message_id"]: r["body"] for r in messages.tree_bodies(parts).collect()}
    assert got == {"a": "deep", "b": "own", "c": "only html", "d": "", "e": "bottom"}
    paths = {(r["message_id"], r["part_id"]): r["path"] for r in messages.part_paths(parts).collect()}
    assert paths["a", "0.1"] == [0, 1] and paths["a", "r"] == [] and len(paths["e", "12"]) == 12 and ("d", "x") not in paths
    assert messages.tree_bodies(parts.limit(0)).count() == 0
