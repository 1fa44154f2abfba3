"""Queries of the ingest, cleaning and feature jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import cleaning
from lakemill.functions.features import has_marker, keyword_count
from lakemill.functions.fixed import SILVER_FEATURES
from lakemill.functions.folding import fold_ascii
from lakemill.operators import ingest, silver
from lakemill.plans.catalog import query
from lakemill.plans.frames import bronze_rows, rows_of_period, silver_rows
from lakemill.plans.twins import KEYWORDS, clean_parts, part, twin
from lakemill.sources.tables import mail_keys, mails

FEATURE_LIST = ", ".join(SILVER_FEATURES)


@query(twin(["months"], "SELECT doc_id, idx, chunk, month_partition, row_in_month FROM months"))
def period_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.assign_periods(mail_keys(spark, folder), "doc_id", rows_of_period(spark, folder))


@query(twin(["months"], "SELECT DISTINCT chunk, month_partition FROM months"))
def month_labels(spark: SparkSession, folder: str) -> DataFrame:
    periods = ingest.assign_periods(mail_keys(spark, folder), "doc_id", rows_of_period(spark, folder))
    return periods.select("chunk", "month_partition").distinct()


@query(twin(["mails"], """
SELECT doc_id, variant AS raw_label, CASE WHEN starts_with(bare, 'ham') AND length(bare) = 3 THEN 0
    WHEN starts_with(bare, 'spam') AND length(bare) = 4 THEN 1 END AS label
FROM (SELECT *, translate(lower(variant), ' ' || chr(9) || chr(10) || chr(160) || chr(8195), '') AS bare
  FROM (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN ' ' || upper(raw_label) || ' ' WHEN 1 THEN raw_label
      WHEN 2 THEN raw_label || '?' WHEN 3 THEN raw_label || chr(9) WHEN 4 THEN chr(160) || raw_label || chr(10)
      ELSE chr(8195) || raw_label END AS variant FROM mails))"""))
def label_map(spark: SparkSession, folder: str) -> DataFrame:
    raw, kind = F.col("raw_label"), F.col("doc_id") % 6
    variant = (
        F.when(kind == 0, F.concat(F.lit(" "), F.upper(raw), F.lit(" ")))
        .when(kind == 1, raw)
        .when(kind == 2, F.concat(raw, F.lit("?")))
        .when(kind == 3, F.concat(raw, F.lit("\t")))
        .when(kind == 4, F.concat(F.lit("\u00a0"), raw, F.lit("\n")))
        .otherwise(F.concat(F.lit("\u2003"), raw))
    )
    rows = mails(spark, folder).select("doc_id", variant.alias("raw_label"))
    return rows.withColumn("label", ingest.label_code(F.col("raw_label")))


@query(twin(["bronze"], "SELECT email_id, body, label, raw_label, received_at, month_partition FROM bronze"))
def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return bronze_rows(spark, folder)


@query(twin(["bronze"], """
SELECT month_partition, count(*) AS row_count, count(*) FILTER (label = 1) AS spam_count,
  count(*) FILTER (label = 0) AS ham_count, min(received_at) AS min_received_at,
  max(received_at) AS max_received_at, 'emails_' || month_partition || '.csv' AS source_file
FROM bronze GROUP BY month_partition"""))
def ingestion_log(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.ingestion_log(bronze_rows(spark, folder))


@query(twin(["bronze"], """
SELECT month_partition, count(*) AS n_rows FROM bronze
WHERE substr(month_partition, 6, 2) NOT IN ('11', '01') GROUP BY month_partition"""))
def pending_months(spark: SparkSession, folder: str) -> DataFrame:
    rows = bronze_rows(spark, folder)
    done = rows.where(F.substring("month_partition", 6, 2).isin("11", "01"))
    return ingest.pending(rows, done).groupBy("month_partition").agg(F.count(F.lit(1)).alias("n_rows"))


@query(twin(["bronze"], """
SELECT month_partition, count(*) AS n_rows, count(label) AS n_labelled FROM bronze
WHERE month_partition BETWEEN '2024-12' AND '2025-03' GROUP BY month_partition"""))
def months_in_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = bronze_rows(spark, folder).where(F.col("month_partition").between("2024-12", "2025-03"))
    return rows.groupBy("month_partition").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("label").alias("n_labelled")
    )


@query(twin(["bronze_squeezed"], """
SELECT email_id, regexp_replace(strip_accents(body), '[^\\x00-\\x7F]', '', 'g') AS folded, lined, squeezed,
  regexp_replace(squeezed, '[^a-z0-9\\x09-\\x0D\\x1C-\\x20]', ' ', 'g') AS no_symbols,
  trim(regexp_replace(regexp_replace(squeezed, '[^a-z0-9\\x09-\\x0D\\x1C-\\x20]', ' ', 'g'),
    '[\\x09-\\x0D\\x1C-\\x20]+', ' ', 'g')) AS spaced
FROM bronze_squeezed"""))
def clean_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Each cleaning step on its own, to compare against the one-pass chain."""
    return (
        bronze_rows(spark, folder)
        .select("email_id", fold_ascii(cleaning.text_or_none_word(F.col("body"))).alias("folded"))
        .withColumn("lined", cleaning.linebreaks_to_space(F.lower("folded")))
        .withColumn("squeezed", cleaning.squeeze_runs(F.col("lined")))
        .withColumn("no_symbols", cleaning.symbols_to_space(cleaning.merge_marker(F.col("squeezed"))))
        .withColumn("spaced", cleaning.collapse_spaces(F.col("no_symbols")))
    )


@query(twin(["bronze_clean"], "SELECT email_id, body_clean FROM bronze_clean"))
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return bronze_rows(spark, folder).select(
        "email_id", cleaning.clean_text(F.col("body")).alias("body_clean")
    )


MARKED_SQL = """
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN body || ' 3bescapenumber xyzzyescapenumber'
                    WHEN doc_id % 11 = 0 THEN 'ESCAPENUMBER, cescapenumber ' || body ELSE body END AS body FROM mails"""


def marked_mails(spark: SparkSession, folder: str) -> DataFrame:
    """Mails with marker words planted by a rule of doc_id."""
    body, key = F.col("body"), F.col("doc_id")
    planted = (
        F.when(key % 7 == 0, F.concat(body, F.lit(" 3bescapenumber xyzzyescapenumber")))
        .when(key % 11 == 0, F.concat(F.lit("ESCAPENUMBER, cescapenumber "), body))
        .otherwise(body)
    )
    return mails(spark, folder).withColumn("body", planted)


part("marked", ["mails"], MARKED_SQL)
clean_parts("marked", "marked", ["marked"])


@query(twin(["marked_clean"], """
SELECT doc_id, body_clean, contains(lower(body), 'escapenumber')::INTEGER AS has_escapenumber,
  len(regexp_extract_all(body_clean, '\\bescapenumber\\b'))::INTEGER AS n_marker_words
FROM marked_clean"""))
def marker_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    return (
        marked_mails(spark, folder)
        .withColumn("body_clean", cleaning.clean_text(F.col("body")))
        .select(
            "doc_id",
            "body_clean",
            has_marker(F.col("body")).alias("has_escapenumber"),
            keyword_count(F.col("body_clean"), ["escapenumber"]).alias("n_marker_words"),
        )
    )


@query(twin(["featured"], f"SELECT email_id, {FEATURE_LIST} FROM featured"))
def text_features(spark: SparkSession, folder: str) -> DataFrame:
    return silver.featured(bronze_rows(spark, folder), keywords=KEYWORDS).select("email_id", *SILVER_FEATURES)


@query(twin(["bronze_clean"], """
SELECT month_partition, count(*) AS initial_rows,
  count(*) FILTER (length(cut) >= 400 AND label IS NOT NULL) AS final_rows,
  count(*) FILTER (length(body_clean) > 5000) AS truncated_rows,
  count(*) FILTER (length(cut) < 400) AS dropped_short_body,
  count(*) FILTER (label IS NULL) AS dropped_null_label,
  count(*) - count(*) FILTER (length(cut) >= 400 AND label IS NOT NULL) AS total_dropped
FROM (SELECT *, substr(body_clean, 1, 5000) AS cut FROM bronze_clean) GROUP BY month_partition"""))
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return silver.gate_counts(bronze_rows(spark, folder), min_chars=400, max_chars=5000)


@query(twin(["silver"], f"""
SELECT email_id, body_clean, label, received_at, {FEATURE_LIST}, month_partition FROM silver"""))
def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    return silver_rows(spark, folder)


@query(twin(["silver"], "SELECT month_partition, count(*) AS n_rows, avg(label) AS spam_share, "
            + ", ".join(f"sum({c}::DECIMAL(20,6))::DOUBLE / count(*) AS mean_{c}" for c in SILVER_FEATURES)
            + " FROM silver GROUP BY month_partition"))
def silver_monthly_summary(spark: SparkSession, folder: str) -> DataFrame:
    return silver.monthly_summary(silver_rows(spark, folder))


@query(twin(["bronze_clean"], """
SELECT month_partition, reason, count(*) AS n_rows FROM (
  SELECT month_partition, CASE WHEN body IS NULL THEN 'null_text'
    WHEN email_id <> min(email_id) OVER (PARTITION BY month_partition, body) THEN 'duplicate_text'
    WHEN label IS NULL THEN 'invalid_label' WHEN body_clean = '' THEN 'empty_after_clean'
    WHEN length(body_clean) < 50 THEN 'short_text' ELSE 'kept' END AS reason FROM bronze_clean)
GROUP BY month_partition, reason"""))
def silver_drop_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return silver.drop_reasons(bronze_rows(spark, folder))
