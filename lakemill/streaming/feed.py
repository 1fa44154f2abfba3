"""The message feed as a stream: dedupe, score, log, daily counts, model refresh.

The checkpoint is the cursor: a restart goes on after the last finished batch. The only state
kept is for duplicates and open days, both bounded by the watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakemill.operators import messages
from lakemill.operators.training import SpamModel
from lakemill.session import durable

TICK = "30 seconds"
SLICES = 16


def file_feed(spark: SparkSession, path: str, schema: StructType, pattern: str | None = None, files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def since(feed: DataFrame, start: str, time: str = "ts") -> DataFrame:
    """Only messages after the start of the feed: no backfill of an older mailbox."""
    return feed.where(F.col(time) > F.lit(start).cast(feed.schema[time].dataType))


def deduplicated(feed: DataFrame, key: str = "message_id", time: str = "ts", late: str = "1 day") -> DataFrame:
    """One row per message id; ids are remembered for as long as rows may be late.

    Repeats are dropped per slice of an id first, so an id that arrives again and again reaches the
    task of its key at most SLICES times per state lifetime.
    """
    others = [c for c in feed.columns if c != key]
    slice_ = F.pmod(F.xxhash64(*others, F.lit("slice")), F.lit(SLICES))
    rows = feed.withWatermark(time, late).withColumn("_slice", slice_)
    return rows.dropDuplicatesWithinWatermark([key, "_slice"]).drop("_slice").dropDuplicatesWithinWatermark([key])


def scored_log(feed: DataFrame, model: SpamModel, threshold: float | None = None) -> DataFrame:
    """Mailbox log rows of a (static or streaming) message frame."""
    limit = F.lit(float(model.threshold if threshold is None else threshold))
    rows = messages.decided(model.score(messages.prepared(feed)), limit)
    # A message that cannot be labelled (no id, no time, no score) is marked; the others go on.
    failed = F.col("message_id").isNull() | F.col("ts").isNull() | F.col("spam_probability").isNull()
    return messages.mail_log(rows, F.col("ts"), failed)


def daily_counts(log: DataFrame, time: str = "timestamp", late: str = "1 day") -> DataFrame:
    """Scored, spam and ham messages per tumbling day."""
    spam = F.col("prediction") == "spam"
    if log.isStreaming:
        log = log.withWatermark(time, late)
    return (
        log.groupBy(F.window(time, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_total"), F.count_if(spam).alias("n_spam"), F.count_if(~spam).alias("n_ham"))
        .select(F.to_date("w.start").alias("day"), "n_total", "n_spam", "n_ham")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str, once: bool = False, tick: str = TICK) -> StreamingQuery:
    """Append rows to a Parquet folder, exactly once per row."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=tick)
    return writer.start(path)


def updates_to(stream: DataFrame, path: str, checkpoint: str, once: bool = False, tick: str = TICK) -> StreamingQuery:
    """Write each batch's changed aggregate rows under its batch number; a re-run replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=tick)
    return writer.start()


def latest_updates(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Current value per key of what `updates_to` wrote."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("batch").cast("long")).alias("_last")).select(key, "_last.*")


def compact_updates(spark: SparkSession, path: str, key: str) -> None:
    """Replace all finished batches by one that holds the current value per key.

    Run it between two runs of the stream. The last batch gets the values first, and values of
    earlier batches never win over it, so an interrupted run loses nothing and can be repeated.
    """
    last = spark.read.parquet(path).agg(F.max(F.col("batch").cast("long"))).first()[0]
    current = durable(latest_updates(spark, path, key), "updates")
    current.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={last}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in system.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("batch=") and int(name[6:]) < last:
            system.delete(entry.getPath(), True)


def refreshed_log(
    feed: DataFrame, current: Callable[[SparkSession], tuple[SpamModel, int]], path: str, checkpoint: str,
    once: bool = False, tick: str = TICK,
) -> StreamingQuery:
    """Score each batch with the model that is current when the batch starts; rows carry its version."""

    def write(batch: DataFrame, number: int) -> None:
        model, version = current(batch.sparkSession)
        log = scored_log(batch, model).withColumn("model_version", F.lit(version).cast("int"))
        log.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = feed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=tick)
    return writer.start()
