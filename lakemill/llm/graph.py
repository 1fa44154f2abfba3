"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.session import durable


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, label) of every end of the edges (a, b); label is the smallest id of the component.

    Smallest labels travel along the edges and along the labels themselves, so the number of rounds
    follows the logarithm of the diameter. Labels are combined before each shuffle, so a centre with
    most of the edges costs one row per task; each round is written to the shared folder.
    An empty table gives an empty table.
    """
    both = durable(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), f"{name}-edges"
    )
    labels = durable(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
        .withColumn("label", F.least("id", "label")), name,
    )
    while True:
        sent = both.join(labels.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "label")
        own = labels.select("id", "label", F.col("label").alias("old"))
        merged = (
            sent.withColumn("old", F.lit(None).cast(labels.schema["label"].dataType)).unionByName(own)
            .groupBy("id").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        )
        merged = durable(merged, name)
        if merged.where("label <> old").isEmpty():
            return merged.select("id", "label")
        jump = merged.select(F.col("id").alias("label"), F.col("label").alias("next"))
        labels = durable(
            merged.join(jump, "label", "left").select("id", F.coalesce("next", "label").alias("label")), name
        )
