"""The shared frames that the named queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import ingest, silver, splits
from lakemill.plans.twins import KEYWORDS, period_rows
from lakemill.session import durable
from lakemill.sources.tables import mail_keys, mails


def rows_of_period(spark: SparkSession, folder: str) -> int:
    """Rows of a period of the given mails, by their number."""
    return period_rows(mail_keys(spark, folder).count())


def bronze_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.bronze(
        mails(spark, folder), rows_per_period=rows_of_period(spark, folder), keys=mail_keys(spark, folder)
    )


def silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver(bronze_rows(spark, folder), keywords=KEYWORDS)


def split_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Silver keys, labels and the named columns, written once, with the latest month held out."""
    keep = dict.fromkeys(["email_id", "label", "month_partition", *columns])
    rows = durable(silver_rows(spark, folder).select(*keep), "silver")
    holdout = rows.agg(F.max("month_partition")).first()[0]
    return splits.split(rows, holdout)
