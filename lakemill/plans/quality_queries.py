"""Queries of the quality profile and the exploratory profile."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.cleaning import split_words
from lakemill.functions.features import add_clean
from lakemill.functions.fixed import PROFILE_FEATURES
from lakemill.operators import heavy, ingest, profiling, quality, silver, sketches
from lakemill.plans.catalog import query
from lakemill.plans.frames import bronze_rows, rows_of_period, silver_rows
from lakemill.plans.ingest_queries import marked_mails
from lakemill.plans.twins import UNICODE_SPACE, even, part, twin
from lakemill.session import durable, new_path
from lakemill.sources import files
from lakemill.sources.tables import mail_keys, mails, table

# Raw texts, and beside some of them rows with gaps, so that every rate is exercised.
part("gappy", ["bronze"], """
SELECT doc_id, email_id, month_partition, label, body AS txt FROM bronze
UNION ALL SELECT doc_id, email_id || '-gap', month_partition, label, CASE doc_id % 23
  WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN 'Unknown' WHEN 4 THEN '12345' WHEN 5 THEN 'x' WHEN 6 THEN ' ' || body
  WHEN 7 THEN 'n/a' END FROM bronze WHERE doc_id % 23 < 8""")
part("words", ["gappy"], "SELECT *, coalesce(txt, 'None') AS s FROM gappy")


def gappy_rows(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("doc_id") % 23
    text = (
        F.when(kind == 1, "")
        .when(kind == 2, "   ")
        .when(kind == 3, "Unknown")
        .when(kind == 4, "12345")
        .when(kind == 5, "x")
        .when(kind == 6, F.concat(F.lit(" "), "body"))
        .when(kind == 7, "n/a")
    )
    given = mails(spark, folder)
    planted = given.where(kind < 8).withColumn("body", text)
    keys = mail_keys(spark, folder)
    rows = [ingest.bronze(part, rows_per_period=rows_of_period(spark, folder), keys=keys) for part in (given, planted)]
    rows[1] = rows[1].withColumn("email_id", F.concat("email_id", F.lit("-gap")))
    return rows[0].unionByName(rows[1]).select("email_id", "month_partition", "label", F.col("body").alias("txt"))


def feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Label and numeric features, worked out once; profiles read them several times."""
    return durable(silver_rows(spark, folder).select("label", *PROFILE_FEATURES), "profiled")


def rate(condition: str, digits: int = 4) -> str:
    return even(f"avg(CASE WHEN {condition} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", digits)


STRIPPED = f"regexp_replace(s, '^[{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+$', '', 'g')"
METRICS = {
    "completeness": {
        "total_rows": "count(*)",
        "null_count": "count(*) FILTER (txt IS NULL)",
        "null_rate": rate("txt IS NULL"),
        "empty_string_rate": rate("txt = ''"),
        "whitespace_rate": rate(f"{STRIPPED} = ''"),
        "placeholder_rate": rate("lower(s) IN ('na', 'n/a', 'none', 'null', 'unknown')"),
    },
    "consistency": {
        "case_inconsistency_rate": rate("s <> lower(s)"),
        "leading_trailing_spaces_rate": rate(f"s <> {STRIPPED}"),
        "multiple_spaces_rate": rate(f"regexp_matches(s, '[{UNICODE_SPACE}]{{2,}}')"),
    },
    "length": {
        "min_length": "min(length(s))::INTEGER",
        "max_length": "max(length(s))::INTEGER",
        "mean_length": even("avg(length(s))", 2),
        "short_text_rate_lt3": rate("length(s) < 3"),
        "long_text_rate_gt100": rate("length(s) > 100"),
    },
    "pattern": {
        "numeric_only_rate": rate("regexp_matches(s, '^\\d+\\n?$')"),
        "special_char_rate": rate(f"regexp_matches(s, '[^a-zA-Z0-9{UNICODE_SPACE}]')"),
        "contains_digit_rate": rate("regexp_matches(s, '\\d')"),
    },
    "semantic": {
        "single_word_rate": rate(
            f"len(list_filter(string_split_regex(s, '[{UNICODE_SPACE}]+'), lambda w: w <> '')) = 1"
        ),
        "very_low_information_rate": rate("length(s) < 2"),
    },
    "label_distribution": {
        "spam_ratio": even("avg(label)", 4),
        "spam_count": "count(*) FILTER (label = 1)",
        "ham_count": "count(*) FILTER (label = 0)",
        "drift_flag": "avg(label) < 0.10 OR avg(label) > 0.90",
    },
    "uniqueness": {
        "n_unique": "count(DISTINCT s)",
        "unique_rate": even("count(DISTINCT s) / count(*)", 4),
        "duplicate_rate": even("(count(*) - count(DISTINCT s)) / count(*)", 4),
    },
}


def family_sql(family: str) -> str:
    cols = ", ".join(f"{c} AS {m}" for m, c in METRICS[family].items())
    return twin(["words"], f"SELECT month_partition, {cols} FROM words GROUP BY month_partition")


def _register_families() -> None:
    for family, check in quality.CHECKS.items():
        def run(spark: SparkSession, folder: str, check=check) -> DataFrame:
            return quality.profile(gappy_rows(spark, folder), check("txt"), ["month_partition"])

        query(family_sql(family), name=f"dq_{family}")(run)


_register_families()


@query(family_sql("label_distribution"))
def dq_label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Spam share and its drift flag per month."""
    rows = gappy_rows(spark, folder)
    return quality.profile(rows, quality.label_distribution("label"), ["month_partition"])


@query(family_sql("uniqueness"))
def dq_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return quality.uniqueness(gappy_rows(spark, folder), "txt", ["month_partition"])


part("ranged", ["words"], """
SELECT * FROM words WHERE month_partition > (SELECT min(month_partition) FROM words) AND month_partition < (SELECT max(month_partition) FROM words)""")


@query(twin(["ranged"], f"""
SELECT count(*) AS n_rows, count(*) FILTER (txt IS NULL) AS n_null, min(length(s))::INTEGER AS min_length, max(length(s))::INTEGER AS max_length,
  {even("avg(length(s))", 2)} AS mean_length, round(stddev_samp(length(s)), 6) AS std_length, true AS unique_holds, true AS quartiles_hold FROM ranged"""))
def quality_of_range(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all months but the first and the last from stored sketches: exact counts and moments,
    and whether distinct texts and quartiles are within the stated error of the exact ones."""
    rows = durable(gappy_rows(spark, folder), "gappy")
    stored = durable(sketches.month_sketches(rows, "txt"), "sketches")
    months = sorted(r[0] for r in stored.select("month_partition").collect())
    if len(months) < 3:  # no month lies between the first and the last
        kind = "n_rows long, n_null long, min_length int, max_length int, mean_length double, std_length double, unique_holds boolean, quartiles_hold boolean"
        return spark.createDataFrame([(0, 0, None, None, None, None, True, True)], kind)
    report = sketches.range_report(stored, months[1], months[-2])
    ranged = sketches.in_range(rows, months[1], months[-2])
    exact = quality.uniqueness(ranged, "txt").first()["n_unique"]
    found, length = report.first(), F.length(F.coalesce("txt", F.lit("None")))
    shares = ranged.agg(*[
        F.avg((length < found[q]).cast("double")).alias(f"below_{q}") for q in ("q25", "q50", "q75")
    ], *[F.avg((length <= found[q]).cast("double")).alias(f"upto_{q}") for q in ("q25", "q50", "q75")]).first()
    held = all(
        shares[f"below_{q}"] - sketches.RANK_ERROR <= p <= shares[f"upto_{q}"] + sketches.RANK_ERROR
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    )
    return report.select(
        "n_rows", "n_null", "min_length", "max_length", "mean_length", "std_length",
        F.lit(abs(found["n_unique"] - exact) <= sketches.UNIQUE_ERROR * exact).alias("unique_holds"), F.lit(held).alias("quartiles_hold"),
    )


@query(twin(["words"], """
SELECT w.email_id, w.s AS value, t.n AS n_rows FROM words w JOIN (
  SELECT min(email_id) AS email_id, count(*) AS n FROM words GROUP BY s ORDER BY n DESC, min(email_id) LIMIT 5) t
ON w.email_id = t.email_id"""))
def dq_top_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.top_values(gappy_rows(spark, folder), "txt", "email_id")


@query(twin(["words"], " UNION ALL ".join(
    f"SELECT '{f}' AS category, '{m}' AS metric, ({c})::DOUBLE AS value FROM words"
    for f, ms in METRICS.items() for m, c in ms.items())))
def dq_summary_long(spark: SparkSession, folder: str) -> DataFrame:
    return quality.summary(gappy_rows(spark, folder), "txt")


@query()
def dq_approx_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.approx_unique(gappy_rows(spark, folder), "txt", ["month_partition"])


@query(twin(["words"], "SELECT month_partition, count(DISTINCT s) AS n_unique, true AS within_bounds FROM words GROUP BY month_partition"))
def dq_approx_unique_error(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate distinct counts beside the exact ones: within a tenth (or two) of them."""
    rows = gappy_rows(spark, folder)
    month = ["month_partition"]
    exact = quality.uniqueness(rows, "txt", month).select(*month, "n_unique")
    rough = quality.approx_unique(rows, "txt", month)
    name = next(c for c in rough.columns if c not in month)
    near = F.abs(F.col(name) - F.col("n_unique")) <= F.greatest(F.col("n_unique") * 0.1, F.lit(2))
    return exact.join(rough, month).select(*month, "n_unique", near.alias("within_bounds"))


@query(twin(["words"], f"SELECT {rate(chr(39).join(['regexp_matches(s, ', '^(?:[A-Z][a-z]+ )', ')']), 6)} AS valid_rate FROM words"))
def dq_regex_validity(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validity(gappy_rows(spark, folder), "txt", "[A-Z][a-z]+ ")


@query(twin(["words"], """
SELECT email_id, s AS value FROM words WHERE NOT regexp_matches(s, '^(?:[A-Z][a-z]+ )') ORDER BY email_id LIMIT 10"""))
def dq_invalid_examples(spark: SparkSession, folder: str) -> DataFrame:
    return quality.invalid_examples(gappy_rows(spark, folder), "txt", "[A-Z][a-z]+ ", "email_id")


@query(twin(["gappy"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM gappy"
    for c in ("email_id", "label", "month_partition", "txt"))))
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_counts(gappy_rows(spark, folder))


@query(twin(["bronze"], """
SELECT month_partition, count(*) AS initial_rows, count(*) FILTER (label IS NULL) AS dropped_null_label
FROM bronze GROUP BY month_partition"""), name="quality_report_counts")
def quality_report_counts(spark: SparkSession, folder: str) -> DataFrame:
    gate = silver.gate_counts(bronze_rows(spark, folder))
    return gate.select("month_partition", "initial_rows", "dropped_null_label")


@query()
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """Nested report per month as it is written to JSON."""
    rows = bronze_rows(spark, folder).select("email_id", "body", "label", "month_partition")
    cleaned = durable(silver.truncated(add_clean(rows)).drop("body"), "cleaned")
    return quality.quality_report(cleaned, silver.gate_counts_of(cleaned))


def _report_twin() -> str:
    families = [f for f in quality.CHECKS] + ["label_distribution"]
    pairs = [(f, m, c) for f in families for m, c in METRICS[f].items()]
    pairs += [("uniqueness", m, c) for m, c in METRICS["uniqueness"].items()]
    metrics = ", ".join(f"({c})::DOUBLE AS {f}_{m}" for f, m, c in pairs)
    return twin(["bronze_clean"], f""", words AS (SELECT email_id, month_partition, label, substr(body_clean, 1, 100000) AS txt, substr(body_clean, 1, 100000) AS s FROM bronze_clean),
    copies AS (SELECT month_partition, s, count(*) AS n, min(email_id) AS first FROM words GROUP BY 1, 2 HAVING count(*) > 1),
    placed AS (SELECT *, row_number() OVER (PARTITION BY month_partition ORDER BY n DESC, first) AS place FROM copies)
    SELECT month_partition, count(*) AS initial_rows, count(*) FILTER (length(s) >= 50 AND label IS NOT NULL) AS final_rows,
      count(*) FILTER (length(s) < 50) AS dropped_short_body, count(*) FILTER (label IS NULL) AS dropped_null_label, {metrics},
      (SELECT list(md5(s) || ':' || n ORDER BY place) FROM placed p WHERE p.month_partition = words.month_partition AND place <= 5) AS top_duplicates
    FROM words GROUP BY month_partition""")


@query(_report_twin())
def quality_report_flat(spark: SparkSession, folder: str) -> DataFrame:
    """The nested report with one column per metric."""
    return flat_report(quality_report(spark, folder))


@query(_report_twin())
def report_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """The same from the JSON files of the reports; the flat log beside them must hold the same months
    without the nested metrics."""
    path = new_path(spark, "reports")
    rows = durable(quality_report(spark, folder), "report")
    files.write_reports(rows, path)
    log = spark.read.json(f"{path}/log")
    plain = set(rows.columns) - {"quality_metrics"}
    told = log.select("month_partition").join(rows.select("month_partition"), "month_partition", "full").count()
    if not set(log.columns) <= plain or not told == log.count() == rows.count():
        raise ValueError("the log of the reports differs from the reports")
    return flat_report(spark.read.schema(rows.schema).json(f"{path}/report"))


def flat_report(rows: DataFrame) -> DataFrame:
    nested = rows.schema["quality_metrics"].dataType
    metrics = [
        F.col(f"quality_metrics.{f.name}.{m.name}").cast("double").alias(f"{f.name}_{m.name}")
        for f in nested for m in f.dataType if m.name != "top_duplicates"
    ]
    top = F.transform("quality_metrics.uniqueness.top_duplicates", lambda e: F.concat_ws(":", F.md5(e["value"]), e["n_rows"]))
    return rows.select(
        "month_partition", "initial_rows", "final_rows", "dropped_short_body", "dropped_null_label", *metrics, top.alias("top_duplicates")
    )


@query(twin(["bronze"], """
SELECT month_partition, count(*) FILTER (raw_label = 'ham') AS ham, count(*) FILTER (raw_label = 'spam') AS spam
FROM bronze GROUP BY month_partition"""))
def label_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.label_pivot(bronze_rows(spark, folder))


TOP_TOKENS = twin(["mails"], f"""
SELECT raw_label, token, n_uses, place::INTEGER AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY raw_label ORDER BY n_uses DESC, token) AS place FROM (
    SELECT raw_label, token, count(*) AS n_uses FROM (
      SELECT raw_label, unnest(string_split_regex(body, '[{UNICODE_SPACE}]+')) AS token FROM mails WHERE raw_label IS NOT NULL)
    WHERE token <> '' GROUP BY raw_label, token)) WHERE place <= 20""")


@query(TOP_TOKENS)
def top_tokens(spark: SparkSession, folder: str) -> DataFrame:
    rows = mails(spark, folder).where(F.col("raw_label").isNotNull())
    return profiling.top_tokens(rows, "body", "raw_label")


@query(TOP_TOKENS)
def top_tokens_two_passes(spark: SparkSession, folder: str) -> DataFrame:
    """The same list from bounded counters per task and an exact count of the few candidates."""
    rows = mails(spark, folder).where(F.col("raw_label").isNotNull())
    return heavy.top(rows, split_words(F.col("body")), 20, F.col("raw_label")).withColumnRenamed("grp", "raw_label")


@query(twin(["marked"], f"""
SELECT raw_label, {even("avg(contains(lower(body), 'escapenumber')::INTEGER) * 100", 2)} AS rate_pct
FROM (SELECT m.body, r.raw_label FROM marked m JOIN mails r USING (doc_id)) WHERE raw_label IS NOT NULL GROUP BY raw_label"""))
def marker_rate(spark: SparkSession, folder: str) -> DataFrame:
    rows = marked_mails(spark, folder).where(F.col("raw_label").isNotNull())
    return profiling.marker_rate(rows, F.lower("body").contains("escapenumber"), "raw_label")


VARIANTS = twin(["mails"], """
SELECT variant, count(*) AS n_uses FROM (
  SELECT unnest(regexp_extract_all(body, '\\b([a-z]{1,4}tion)\\b', 1)) AS variant FROM mails)
GROUP BY variant ORDER BY n_uses DESC, variant LIMIT 10""")
#: Word boundaries are ASCII on both sides.
VARIANT = r"(?<![A-Za-z0-9_])([a-z]{1,4}tion)(?![A-Za-z0-9_])"


@query(VARIANTS)
def regex_variants(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.top_matches(mails(spark, folder), "body", VARIANT)


@query(VARIANTS)
def regex_variants_two_passes(spark: SparkSession, folder: str) -> DataFrame:
    """The same list from bounded counters per task and an exact count of the few candidates."""
    found = F.regexp_extract_all("body", F.lit(VARIANT), F.lit(1))
    rows = heavy.top(mails(spark, folder).where("body IS NOT NULL"), found, 10)
    return rows.select(F.col("token").alias("variant"), "n_uses")


CONTENT_SQL = ", ".join(
    f"{rate(cond, 6)} AS {name}"
    for name, cond in {
        "html_tag": "regexp_matches({t}, '<[^>]+>')",
        "url": "regexp_matches({t}, 'https?://|www\\.')",
        "from_header": "regexp_matches({t}, '(?m)^From:')",
        "subject_header": "regexp_matches({t}, '(?m)^Subject:')",
    }.items()
)


@query(f"SELECT {CONTENT_SQL.format(t='html')} FROM pages")
def html_url_rates(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.content_rates(table(spark, folder, "pages"), "html")


@query(f"""
SELECT count(*) AS n_rows, round(avg(length(text)), 6) AS mean, round(stddev_samp(length(text)), 6) AS std,
  min(length(text))::INTEGER AS min, max(length(text))::INTEGER AS max,
  {rate('length(text) < 20', 6)} AS share_lt20, {rate('length(text) < 50', 6)} AS share_lt50,
  {rate('length(text) > 100000', 6)} AS share_gt100k,
  quantile_cont(length(text)::DOUBLE, 0.25) AS q25, quantile_cont(length(text)::DOUBLE, 0.5) AS q50,
  quantile_cont(length(text)::DOUBLE, 0.75) AS q75 FROM documents""")
def length_describe(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.describe_length(table(spark, folder, "documents"), "text")


@query(f"""
SELECT lang, count(*) AS n_rows, round(avg(length(text)), 6) AS mean, round(stddev_samp(length(text)), 6) AS std,
  min(length(text))::INTEGER AS min, max(length(text))::INTEGER AS max,
  {rate('length(text) < 20', 6)} AS share_lt20, {rate('length(text) < 50', 6)} AS share_lt50,
  {rate('length(text) > 100000', 6)} AS share_gt100k,
  quantile_cont(length(text)::DOUBLE, 0.25) AS q25, quantile_cont(length(text)::DOUBLE, 0.5) AS q50,
  quantile_cont(length(text)::DOUBLE, 0.75) AS q75 FROM documents GROUP BY lang""")
def length_describe_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.describe_length(table(spark, folder, "documents"), "text", ["lang"])


@query(twin(["silver"], f"""
SELECT month_partition, count(*) AS n_rows, {rate('char_count < 400', 6)} AS short_share
FROM silver GROUP BY month_partition"""))
def monthly_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.monthly_rows(silver_rows(spark, folder), 400)


@query(twin(["bronze"], """
SELECT month_partition, label, n, n / sum(n) OVER (PARTITION BY month_partition) AS label_share FROM (
  SELECT month_partition, label, count(*) AS n FROM bronze WHERE label IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'all', label, count(*) FROM bronze WHERE label IS NOT NULL GROUP BY label)"""))
def label_shares(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.label_shares(bronze_rows(spark, folder))


part("long_features", ["silver"], "\nUNION ALL ".join(
    f"SELECT label, '{f}' AS feature, {f}::DOUBLE AS value FROM silver" for f in PROFILE_FEATURES))


@query(twin(["long_features"], """
SELECT feature, label, bin, count(*) AS n_rows FROM (
  SELECT feature, label, CASE WHEN hi = lo THEN 25
    ELSE least(floor((value - lo) / (hi - lo) * 50), 49) END::INTEGER AS bin
  FROM (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM long_features
        WINDOW w AS (PARTITION BY feature, label)))
GROUP BY ALL"""))
def histograms(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.histograms(feature_rows(spark, folder), PROFILE_FEATURES, "label")


CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, CASE WHEN stddev_samp({a}) > 0 AND stddev_samp({b}) > 0"
    f" THEN round(corr({a}, {b}), 6) END AS correlation FROM silver"
    for a, b in combinations(PROFILE_FEATURES, 2)
)


@query(twin(["silver"], f"SELECT * FROM ({CORR_SQL}) WHERE correlation IS NOT NULL"))
def correlation_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.correlation_pairs(feature_rows(spark, folder), PROFILE_FEATURES)


@query(twin(["silver"], f"SELECT * FROM ({CORR_SQL}) WHERE abs(correlation) > 0.9"))
def high_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.high_correlation(feature_rows(spark, folder), PROFILE_FEATURES)


@query("""
WITH j AS (SELECT (quality = 0)::INTEGER AS y, toxic AS f FROM labels),
c AS (SELECT y, f, count(*) AS n FROM j GROUP BY ALL)
SELECT round(greatest(sum(p * ln(p / (pa * pb))), 0.0::DOUBLE), 9) AS mutual_information FROM (
  SELECT n / sum(n) OVER () AS p, sum(n) OVER (PARTITION BY y) / sum(n) OVER () AS pa,
    sum(n) OVER (PARTITION BY f) / sum(n) OVER () AS pb FROM c)""")
def mutual_information(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "labels").select((F.col("quality") == 0).cast("int").alias("y"), "toxic")
    return profiling.mutual_information(rows, "y", "toxic")


@query(twin(["long_features"], """
SELECT label, feature, round(quantile_cont(value, 0.5), 9) AS p50, round(quantile_cont(value, 0.995), 9) AS p995
FROM long_features GROUP BY label, feature"""))
def quantiles_by_label(spark: SparkSession, folder: str) -> DataFrame:
    rows = profiling.label_quantiles(feature_rows(spark, folder), PROFILE_FEATURES, [0.5, 0.995])
    return rows.select(
        "label", "feature", F.round(F.col("q")[0], 9).alias("p50"), F.round(F.col("q")[1], 9).alias("p995")
    )
