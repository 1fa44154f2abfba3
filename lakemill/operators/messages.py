"""Message tables: body assembly, duplicates, rejects, scoring, logs, feed summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.features import add_clean, add_scoring_features
from lakemill.functions.fixed import EMPTY_NOTE
from lakemill.functions.messages import (
    applied_label,
    decoded,
    input_text,
    log_probability,
    one_line,
    verdict,
)
from lakemill.session import durable


def bodies(parts: DataFrame, order: str = "part_no", root: Column | None = None) -> DataFrame:
    """(message_id, body) from parts (message_id, part_no, mime, data).

    The root part, number 0, is the message itself: its own data wins. Else the first plain part that
    decodes to text, else the first such html part, else ''. Parts are in depth-first order.
    """
    root = F.col("part_no") == 0 if root is None else root
    has = F.coalesce(F.length("data") > 0, F.lit(False))
    some = has & (decoded(F.col("data")) != "")

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.col(order)))

    # Choose by places alone, then fetch the chosen part: no text is held in an aggregate,
    # and (message_id, place) is unique, so a message of very many parts stays spread out.
    own = first(root & has)
    plain = first((F.col("mime") == "text/plain") & some)
    html = first((F.col("mime") == "text/html") & some)
    chosen = parts.groupBy("message_id").agg(F.coalesce(own, plain, html).alias(order))
    data = parts.where(has).select("message_id", order, "data")
    return chosen.join(data, ["message_id", order], "left").select(
        "message_id", F.coalesce(decoded(F.col("data")), F.lit("")).alias("body")
    )


def part_paths(parts: DataFrame) -> DataFrame:
    """(message_id, part_id, path) of every part that its message's root leads to.

    Parts name their parent and their place among its children; the root has no parent and an empty path.
    Paths compare as depth-first order does. Each round adds one level to the paths, for all messages at
    once, so there are as many rounds as the deepest message has levels; parts under a missing parent or
    in a ring are never reached. Only ids travel.
    """
    ids = parts.select("message_id", "part_id", "parent_id", "place")
    level = durable(ids.where("parent_id IS NULL").select("message_id", "part_id", F.array().cast("array<int>").alias("path")), "paths")
    found = level
    while not level.isEmpty():
        above = level.select("message_id", F.col("part_id").alias("parent_id"), F.col("path").alias("_above"))
        below = ids.join(above, ["message_id", "parent_id"])
        level = durable(below.select("message_id", "part_id", F.array_append("_above", F.col("place").cast("int")).alias("path")), "paths")
        found = found.unionByName(level)
    return found


def tree_bodies(parts: DataFrame) -> DataFrame:
    """(message_id, body) from nested parts (message_id, part_id, parent_id, place, mime, data)."""
    placed = parts.join(part_paths(parts), ["message_id", "part_id"])
    return bodies(placed, "path", F.size("path") == 0)


def first_occurrences(messages: DataFrame, order: str, key: str = "message_id") -> DataFrame:
    """One row per message id, the first by `order` (unique within the id).

    Only ids and order are aggregated; rows are then kept by the unique (id, order), so an id
    that arrives again and again is not gathered in one task.
    """
    firsts = messages.groupBy(key).agg(F.min(order).alias(order))
    return messages.join(firsts, [key, order], "left_semi").select(*messages.columns)


def with_input(messages: DataFrame) -> DataFrame:
    return messages.withColumn("input_text", input_text(F.col("subject"), F.col("body")))


def blank(messages: DataFrame) -> DataFrame:
    """Messages rejected because subject and body are both blank."""
    return with_input(messages).where(F.col("input_text") == "").withColumn(
        "error", F.lit("Subject or body must not be empty.")
    )


def prepared(messages: DataFrame) -> DataFrame:
    """Non-blank messages with cleaned text and the numeric model features."""
    rows = with_input(messages).where(F.col("input_text") != "")
    return add_scoring_features(add_clean(rows, "input_text"), "input_text")


def decided(scored: DataFrame, threshold: Column, p: str = "p") -> DataFrame:
    """Label, probability, threshold and note; text with no usable token is not spam."""
    empty = F.col("body_clean") == ""
    probability = F.when(empty, F.lit(0.0)).otherwise(F.col(p))
    return (
        scored.withColumn("spam_probability", probability)
        .withColumn("threshold", threshold)
        .withColumn("label", F.when(empty, "not_spam").otherwise(verdict(F.col(p), F.col("threshold"))))
        .withColumn("note", F.when(empty, EMPTY_NOTE))
    )


def prediction_log(rows: DataFrame, at: Column) -> DataFrame:
    return rows.select(
        at.alias("timestamp"),
        one_line(F.col("subject")).alias("subject"),
        one_line(F.col("body")).alias("body"),
        F.col("label").alias("prediction"),
        log_probability(F.col("spam_probability")).alias("spam_probability"),
    )


def mail_log(rows: DataFrame, at: Column, failed: Column) -> DataFrame:
    """Mailbox log row; a failed label marks its own row and nothing else."""
    return rows.select(
        at.alias("timestamp"),
        "message_id",
        F.left(F.coalesce("subject", F.lit("")), F.lit(200)).alias("subject"),
        F.left(F.coalesce("snippet", F.lit("")), F.lit(200)).alias("snippet"),
        F.col("label").alias("prediction"),
        log_probability(F.col("spam_probability")).alias("spam_probability"),
        applied_label(F.col("label"), failed).alias("applied_label"),
    )


def feed_summary(log: DataFrame, today: Column) -> DataFrame:
    spam = F.col("prediction") == "spam"
    return log.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(spam).alias("n_spam"),
        F.count_if(~spam).alias("n_ham"),
        F.count_if(F.to_date("timestamp") == today).alias("n_today"),
    )


def recent_feed(log: DataFrame, n: int = 50) -> DataFrame:
    """The newest n log rows for display, ties by message id."""
    return (
        log.orderBy(F.desc("timestamp"), "message_id")
        .limit(n)
        .select(
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            "message_id",
            "subject",
            "snippet",
            "prediction",
            F.round(F.col("spam_probability").cast("double"), 3).alias("spam_probability"),
            "applied_label",
        )
    )
