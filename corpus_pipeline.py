"""The corpus pipeline: documents to token ids in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the docs of the next one. All but the last return the columns of `documents`:

1. toxicity: documents that the lexicon learned from `labels` rejects go;
2. near_duplicates: one document of each class of near duplicates stays, that of the smallest doc_id;
3. decontamination: documents that hold a benchmark item go;
4. pii: each span of personal data is replaced by its kind, and n_chars follows;
5. byte_bpe: one row per document that is left, with its ids and digests of ids and decoded bytes.

Documents without words (null, empty, white space) pass every stage. Repeated rows become one in
the second stage. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import bpe, decontaminate, jaccard, pii, toxicity
from lakemill.llm.queries import byte_ranks
from lakemill.session import durable
from lakemill.sources.tables import table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = byte_ranks()
    rows = bpe.round_trip(docs, ranks, "doc_id")
    return rows.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("pii", without_pii),
    ("byte_bpe", encode),
]

#: The first stage learns, the last needs a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
