import datetime

from pyspark.sql import functions as F

from lakemill.streaming import feed

SCHEMA = "message_id string, ts timestamp, prediction string"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def at(day, hour=0):
    return datetime.datetime(2025, 3, day, hour)


def stream(spark, folder):
    from pyspark.sql.types import _parse_datatype_string

    return feed.file_feed(spark, f"{folder}/in", _parse_datatype_string(SCHEMA))


def test_duplicates_across_files_and_restarts(spark, folder):
    def run():
        ids = feed.deduplicated(stream(spark, folder)).select("message_id")
        feed.append_to(ids, f"{folder}/out", f"{folder}/cp", once=True).awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(f"{folder}/out").collect())

    arrive(spark, folder, [("a", at(1), "spam"), ("b", at(1), "spam"), ("a", at(1, 1), "spam")])
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    arrive(spark, folder, [("b", at(1, 2), "spam"), ("c", at(1, 3), "spam")])
    assert run() == ["a", "b", "c"]


def test_late_rows_stay_out_of_closed_days(spark, folder):
    def run():
        log = stream(spark, folder).withColumnRenamed("ts", "timestamp")
        feed.updates_to(feed.daily_counts(log), f"{folder}/out", f"{folder}/cp", once=True).awaitTermination()
        rows = feed.latest_updates(spark, f"{folder}/out", "day").collect()
        return {r["day"].day: (r["n_total"], r["n_spam"]) for r in rows}

    arrive(spark, folder, [("a", at(1), "spam"), ("b", at(1, 5), "not_spam")])
    assert run() == {1: (2, 1)}
    arrive(spark, folder, [("c", at(1, 6), "spam"), ("d", at(9), "spam")])
    assert run() == {1: (3, 2), 9: (1, 1)}
    # Day 1 closed when day 9 moved the watermark past it.
    arrive(spark, folder, [("e", at(1, 7), "spam"), ("f", at(9, 1), "spam")])
    assert run() == {1: (3, 2), 9: (2, 2)}


def test_no_backfill(spark, folder):
    arrive(spark, folder, [("old", at(1), "spam"), ("new", at(5), "spam")])
    rows = feed.since(stream(spark, folder), "2025-03-02").select("message_id")
    feed.append_to(rows, f"{folder}/out", f"{folder}/cp", once=True).awaitTermination()
    assert [r[0] for r in spark.read.parquet(f"{folder}/out").collect()] == ["new"]


def test_each_batch_uses_the_current_model(spark, folder):
    from lakemill.operators.scaling import ScalerModel
    from lakemill.operators.terms import TermModel
    from lakemill.operators.training import Preparation, SpamModel

    schema = "message_id string, subject string, body string, snippet string, ts timestamp"
    from pyspark.sql.types import _parse_datatype_string

    class Constant:
        """A classifier whose probability is fixed."""

        def __init__(self, p):
            self.p = p

        def probability(self, vectors):
            return F.lit(self.p)

    preparation = Preparation(TermModel(("hello",), (1.0,)), ScalerModel(("log_chars",), (0.0,), (1.0,)))
    current = {"p": 0.9, "version": 1}

    def model(_):
        return SpamModel("lr", preparation, Constant(current["p"]), 0.5), current["version"]

    def run():
        rows = feed.file_feed(spark, f"{folder}/in", _parse_datatype_string(schema))
        feed.refreshed_log(rows, model, f"{folder}/out", f"{folder}/cp", once=True).awaitTermination()
        out = spark.read.parquet(f"{folder}/out").collect()
        return {r["message_id"]: (r["prediction"], r["spam_probability"], r["model_version"]) for r in out}

    def put(key):
        spark.createDataFrame([(key, "s", "hello world", "sn", at(1))], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    put("a")
    assert run() == {"a": ("spam", "0.900000", 1)}
    current.update(p=0.1, version=2)
    put("b")
    assert run() == {"a": ("spam", "0.900000", 1), "b": ("not_spam", "0.100000", 2)}


def test_compaction_keeps_the_current_values(spark, folder):
    def run():
        log = stream(spark, folder).withColumnRenamed("ts", "timestamp")
        feed.updates_to(feed.daily_counts(log), f"{folder}/out", f"{folder}/cp", once=True).awaitTermination()
        return {r["day"].day: r["n_total"] for r in feed.latest_updates(spark, f"{folder}/out", "day").collect()}

    arrive(spark, folder, [("a", at(1), "spam"), ("b", at(2), "spam")])
    run()
    arrive(spark, folder, [("c", at(2, 1), "spam")])
    assert run() == {1: 1, 2: 2}
    feed.compact_updates(spark, f"{folder}/out", "day")
    assert spark.read.parquet(f"{folder}/out").select("batch").distinct().count() == 1
    arrive(spark, folder, [("d", at(2, 2), "spam"), ("e", at(3), "spam")])
    assert run() == {1: 1, 2: 3, 3: 1}


def test_an_id_that_arrives_very_often_is_kept_once(spark, folder):
    arrive(spark, folder, [("hot", at(1, k % 20), f"p{k}") for k in range(300)] + [("cold", at(1), "p")])
    ids = feed.deduplicated(stream(spark, folder)).select("message_id")
    feed.append_to(ids, f"{folder}/out", f"{folder}/cp", once=True).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/out").collect()) == ["cold", "hot"]
