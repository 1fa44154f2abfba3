"""Provided tables, and the mail-shaped views of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table whose texts will be worked on row by row.

    A scan with fewer splits than cores (a small table in one row group) is spread by key first.
    A large table has splits enough and is read as it lies.
    """
    rows = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def mails(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, body, raw_label) in doc_id order."""
    labels = table(spark, folder, "labels").select(
        "doc_id", F.when(F.col("quality") == 0, "spam").when(F.col("quality") == 1, "ham").alias("raw_label")
    )
    texts = text_table(spark, folder, "documents", "doc_id").select("doc_id", F.col("text").alias("body"))
    return texts.join(labels, "doc_id", "left")


def mail_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id")
