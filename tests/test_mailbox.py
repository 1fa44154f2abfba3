import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakemill.streaming.mailbox import deliver, mailbox_feed, trim

SCHEMA = "message_id string, history_id long, subject string"


def add(spark, box, numbers):
    rows = spark.createDataFrame([(f"m{n}", n, f"subject {n}") for n in numbers], SCHEMA)
    deliver(rows.coalesce(1), box)


def run(spark, box, out, **options):
    """Start the stream, read what is there, stop it."""
    query = (
        mailbox_feed(spark, box, SCHEMA, **options).writeStream.format("parquet").option("checkpointLocation", f"{out}/cp").start(f"{out}/rows")
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.schema(SCHEMA).parquet(f"{out}/rows").collect()
    return sorted(int(r["message_id"][1:]) for r in rows)


def test_stop_and_restart_without_loss_or_repetition(spark, folder):
    box, out = f"{folder}/box", f"{folder}/out"
    add(spark, box, range(1, 6))
    assert run(spark, box, out) == []  # what was there before the first start is not read
    add(spark, box, range(6, 9))
    add(spark, box, range(9, 11))
    assert run(spark, box, out) == [6, 7, 8, 9, 10] and run(spark, box, out) == [6, 7, 8, 9, 10]
    add(spark, box, range(11, 13))
    add(spark, box, range(13, 15))
    trim(box, 14)  # the cursor, 10, is older than the history
    assert run(spark, box, out) == list(range(6, 15))
    add(spark, box, [15])
    assert run(spark, box, out) == list(range(6, 16))


def test_an_expired_cursor_may_stop_the_stream(spark, folder):
    box, out = f"{folder}/box", f"{folder}/out"
    add(spark, box, [1, 2])
    assert run(spark, box, out, start="0") == [1, 2]
    add(spark, box, [3, 4])
    trim(box, 4)
    with pytest.raises(StreamingQueryException, match="expired"):
        run(spark, box, out, onExpired="fail")


def test_deleted_messages_hold_nothing_up(spark, folder):
    box, out = f"{folder}/box", f"{folder}/out"
    add(spark, box, [1])
    assert run(spark, box, out, start="0") == [1]
    rows = spark.createDataFrame([("m2", 2, "there"), ("m3", 3, "gone")], SCHEMA)
    rows.where("history_id = 2").write.mode("append").parquet(f"{box}/messages")
    rows.select("message_id", F.col("history_id")).write.mode("append").parquet(f"{box}/history")
    assert run(spark, box, out) == [1, 2]
