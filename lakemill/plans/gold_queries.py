"""Queries of the split, vocabulary and scaling jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.fixed import DROPPED_FEATURES, MAX_TERMS, NUMERIC_FEATURES, STOP_WORDS
from lakemill.operators import splits
from lakemill.operators.scaling import ScalerModel, scaler_stats
from lakemill.operators.terms import TermModel, add_terms, oov_ratio, vocabulary
from lakemill.plans.catalog import query
from lakemill.plans.frames import silver_rows, split_rows
from lakemill.plans.twins import md5_int, part, twin

part("split_rows", ["silver"], f"""
SELECT * EXCLUDE (h, place, quota, is_test),
  CASE WHEN is_test THEN 'test' WHEN place <= quota THEN 'val' ELSE 'train' END AS split
FROM (
  SELECT s.*, q.quota, row_number() OVER (PARTITION BY s.is_test, s.label ORDER BY s.h, s.email_id) AS place
  FROM (SELECT *, month_partition = (SELECT max(month_partition) FROM silver) AS is_test,
          {md5_int('email_id', 42, 1)} AS h FROM silver) s
  LEFT JOIN (
    SELECT label, n_label, n_label - (floor(ideal) + (row_number() OVER (ORDER BY ideal - floor(ideal) DESC, label)
      <= rest - sum(floor(ideal)) OVER ())::INTEGER) AS quota
    FROM (
      SELECT label, n_label, n - ceil(n * 0.15::DOUBLE) AS rest, n_label * (n - ceil(n * 0.15::DOUBLE)) / n AS ideal
      FROM (SELECT label, count(*) AS n_label, sum(count(*)) OVER ()::DOUBLE AS n FROM silver
            WHERE month_partition <> (SELECT max(month_partition) FROM silver) GROUP BY label))) q
  ON q.label = s.label)""")

part("train_words", ["split_rows"], """
SELECT email_id, split, month_partition, list_filter(string_split(body_clean, ' '), lambda w: length(w) >= 2) AS w FROM split_rows""")
part("all_terms", ["train_words"], """
SELECT email_id, split, month_partition, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]))) AS term
FROM train_words""")
part("tf", ["all_terms"], "SELECT email_id, split, month_partition, term, count(*) AS tf FROM all_terms GROUP BY ALL")
part("vocab", ["tf"], f"""
SELECT *, ln((1.0::DOUBLE + n_docs) / (1.0::DOUBLE + df)) + 1.0 AS idf, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx FROM (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf, (SELECT count(*) FROM train_words WHERE split = 'train') AS n_docs
  FROM tf WHERE split = 'train' GROUP BY term HAVING count(*) >= 5
    AND count(*) <= (SELECT count(*) FROM train_words WHERE split = 'train') * 0.95::DOUBLE
  ORDER BY total_tf DESC, term LIMIT {MAX_TERMS})""")
part("raw_weights", ["vocab"], """
SELECT email_id, split, month_partition, term, idx, (1 + ln(tf::DOUBLE)) * idf AS w FROM tf JOIN vocab USING (term)""")
part("weights", ["raw_weights"], """
SELECT email_id, split, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY email_id)) AS weight FROM raw_weights""")


def terms_frame(spark: SparkSession, folder: str) -> DataFrame:
    return add_terms(split_rows(spark, folder, "body_clean"), "body_clean")


@query(twin(["silver"], " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS n_null FROM silver" for c in NUMERIC_FEATURES)))
def feature_selection_gate(spark: SparkSession, folder: str) -> DataFrame:
    return splits.null_features(silver_rows(spark, folder))


KEPT = "email_id, label, month_partition, " + ", ".join(NUMERIC_FEATURES)


@query(twin(["silver"], f"""
SELECT * EXCLUDE (doc_id, {', '.join(DROPPED_FEATURES)}) FROM silver"""))
def selected_features(spark: SparkSession, folder: str) -> DataFrame:
    return splits.select_features(silver_rows(spark, folder))


@query(twin(["split_rows"], "SELECT email_id, label, month_partition, split FROM split_rows"))
def split_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return split_rows(spark, folder, "email_id").select("email_id", "label", "month_partition", "split")


@query(twin(["silver"], f"""
SELECT email_id, CASE WHEN {md5_int('email_id', 42, 1)} < 858993459 THEN 'test' ELSE 'train' END AS split FROM silver"""))
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_by_hash(silver_rows(spark, folder), "email_id", 0.2).select("email_id", "split")


SUMMARY = """
SELECT split, count(*) AS n_rows, round_even(avg(label) * 1e4, 0)::DOUBLE / 1e4 AS spam_share,
  count(*) FILTER (label IS NULL) AS null_labels, count(DISTINCT month_partition) AS n_months,
  min(month_partition) AS first_month, max(month_partition) AS last_month, list_sort(list(DISTINCT month_partition)) AS months,
  count(*) / sum(count(*)) OVER () AS row_share FROM split_rows GROUP BY split"""


@query(twin(["split_rows"], SUMMARY))
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_summary(split_rows(spark, folder, "email_id"))


@query(twin(["split_rows"], """
SELECT email_id, ['test', split] AS splits FROM split_rows
WHERE split = 'train' AND label = 1"""))
def split_leak_check(spark: SparkSession, folder: str) -> DataFrame:
    """Leak check on splits with a planted leak: spam training rows repeated as test rows."""
    rows = split_rows(spark, folder, "email_id").select("email_id", "label", "split")
    planted = rows.where((F.col("split") == "train") & (F.col("label") == 1)).withColumn("split", F.lit("test"))
    return splits.leaked_ids(rows.unionByName(planted))


@query(twin(["vocab"], "SELECT term, df, total_tf, n_docs, round(idf, 9) AS idf, idx FROM vocab"))
def tfidf_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    train = terms_frame(spark, folder).where(F.col("split") == "train")
    return vocabulary(train).withColumn("idf", F.round("idf", 9))


@query(twin(["weights"], "SELECT email_id, split, idx, term, round(weight, 9) AS weight FROM weights"))
def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    rows = terms_frame(spark, folder)
    model = TermModel.fit(rows.where(F.col("split") == "train"))
    return model.weights(rows, ["email_id", "split"]).withColumn("weight", F.round("weight", 9))


@query(twin(["tf", "vocab"], """
SELECT month_partition, sum(tf)::BIGINT AS n_terms,
  round(1 - sum(CASE WHEN v.term IS NOT NULL THEN tf ELSE 0 END)::DOUBLE / sum(tf)::DOUBLE, 6) AS oov_ratio,
  1 - sum(CASE WHEN v.term IS NOT NULL THEN tf ELSE 0 END)::DOUBLE / sum(tf)::DOUBLE > 0.2 AS alert
FROM tf LEFT JOIN vocab v ON v.term = tf.term GROUP BY month_partition"""))
def oov_ratios(spark: SparkSession, folder: str) -> DataFrame:
    rows = terms_frame(spark, folder)
    model = TermModel.fit(rows.where(F.col("split") == "train"))
    return oov_ratio(rows, model, ["month_partition"])


@query(twin(["split_rows"], " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 9) AS mean, round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE"
    f" ELSE stddev_pop({c}) END, 9) AS scale FROM split_rows WHERE split = 'train'" for c in NUMERIC_FEATURES)),
    name="scaler_stats")
def scaler(spark: SparkSession, folder: str) -> DataFrame:
    stats = scaler_stats(split_rows(spark, folder, *NUMERIC_FEATURES).where(F.col("split") == "train"))
    return stats.withColumns({c: F.round(c, 9) for c in ("mean", "scale")})


@query(twin(["split_rows"], "SELECT email_id, split, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM split_rows WHERE split = 'train'))"
    f" / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}) END FROM split_rows WHERE split = 'train'), 7) AS {c}"
    for c in NUMERIC_FEATURES) + " FROM split_rows"))
def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = split_rows(spark, folder, *NUMERIC_FEATURES)
    model = ScalerModel.fit(rows.where(F.col("split") == "train"))
    return rows.select("email_id", "split", *[F.round(z, 7).alias(c) for c, z in model.scaled().items()])


@query()
def gold_features(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse text block with the scaled numerics behind it, per row and split."""
    rows = add_terms(split_rows(spark, folder, "body_clean", *NUMERIC_FEATURES), "body_clean")
    train = rows.where(F.col("split") == "train")
    weighted = TermModel.fit(train).vectors(rows)
    return ScalerModel.fit(train).vectors(weighted).select("email_id", "label", "split", "features")


STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)

part("draft_words", ["silver"], f"""
SELECT email_id, CASE WHEN {md5_int('email_id', 42, 1)} < 858993459 THEN 'test' ELSE 'train' END AS split,
  list_filter(string_split(body_clean, ' '), lambda w: length(w) >= 2 AND w NOT IN ({STOP_LIST})) AS w
FROM silver""")
part("draft_tf", ["draft_words"], """
SELECT email_id, split, term, count(*) AS tf FROM (SELECT email_id, split, unnest(w) AS term FROM draft_words) GROUP BY ALL""")


@query(twin(["draft_tf"], """
SELECT term, df, total_tf, n_docs, round(ln((1.0::DOUBLE + n_docs) / (1.0::DOUBLE + df)) + 1.0, 9) AS idf,
  (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx FROM (
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf, (SELECT count(*) FROM draft_words WHERE split = 'train') AS n_docs
    FROM draft_tf WHERE split = 'train' GROUP BY term ORDER BY total_tf DESC, term LIMIT 50000)"""))
def stopword_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Single words without stop words, any document frequency, of a hash split's training rows."""
    rows = splits.split_by_hash(silver_rows(spark, folder), "email_id", 0.2)
    train = add_terms(rows.where(F.col("split") == "train"), "body_clean", (1, 1), STOP_WORDS)
    return vocabulary(train, min_df=1, max_df=1.0, max_terms=50_000).withColumn("idf", F.round("idf", 9))
