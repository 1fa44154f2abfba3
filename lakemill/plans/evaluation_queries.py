"""Queries of evaluation, selection, promotion and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.cleaning import letters_or_space
from lakemill.operators import drift, evaluation, ledger
from lakemill.operators.ledger import Ledger
from lakemill.operators.quality import label_distribution, profile
from lakemill.operators.terms import TermModel, add_terms
from lakemill.plans.catalog import query
from lakemill.plans.frames import bronze_rows, silver_rows
from lakemill.plans.twins import part, twin
from lakemill.session import durable, new_path
from lakemill.sources.tables import table, text_table

MODELS = {"lr": 11, "nb": 29, "rf": 53}

# Deterministic scores with ties and some signal, three models per labelled document.
part("scored", [], " UNION ALL ".join(f"""
SELECT '{m}' AS model, doc_id, (quality = 0)::INTEGER AS y,
  ((doc_id * 37 + {k}) % 61 + (quality = 0)::INTEGER * (doc_id % {k} + 20)) / 160.0::DOUBLE AS p FROM labels"""
    for m, k in MODELS.items()))
part("by_score", ["scored"], """
SELECT model, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY ALL""")
part("points", ["by_score"], """
SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY p DESC)::DOUBLE AS tp, sum(neg) OVER (PARTITION BY model ORDER BY p DESC)::DOUBLE AS fp,
  sum(pos) OVER (PARTITION BY model)::DOUBLE AS np, sum(neg) OVER (PARTITION BY model)::DOUBLE AS nn FROM by_score""")
part("curve", ["points"], """
SELECT model, p AS threshold, tp / (tp + fp) AS precision, tp / np AS recall, false AS is_end FROM points
UNION ALL SELECT DISTINCT model, 1.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, true FROM points""")
part("picked", ["curve"], """
SELECT model, arg_min(threshold, threshold) AS threshold, arg_min(precision, threshold) AS precision, arg_min(recall, threshold) AS recall
FROM curve WHERE precision >= 0.9 GROUP BY model""")
part("counts", ["scored"], """
SELECT model, count(*) FILTER (y = 0 AND p < 0.4) AS tn, count(*) FILTER (y = 0 AND p >= 0.4) AS fp,
  count(*) FILTER (y = 1 AND p < 0.4) AS fn, count(*) FILTER (y = 1 AND p >= 0.4) AS tp FROM scored GROUP BY model""")
part("ranking", ["points"], """
SELECT model, sum(pos / np * tp / (tp + fp)) AS average_precision,
  sum(pos * (nn - fp + neg / 2.0::DOUBLE)) / (any_value(np) * any_value(nn)) AS roc_auc FROM points GROUP BY model""")
RATES = """CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp / (tp + fn) END AS recall,
  2 * tp / (2 * tp + fp + fn) AS f1, (tp + tn) / (tn + fp + fn + tp) AS accuracy"""
part("metrics", ["counts", "ranking"], f"SELECT model, tn, fp, fn, tp, {RATES}, average_precision, roc_auc FROM counts JOIN ranking USING (model)")


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    spam = (F.col("quality") == 0).cast("int")

    def score(k: int) -> Column:
        return ((F.col("doc_id") * 37 + k) % 61 + spam * (F.col("doc_id") % k + 20)) / F.lit(160.0)

    pairs = F.array(*[F.struct(F.lit(m).alias("model"), score(k).alias("p")) for m, k in MODELS.items()])
    return table(spark, folder, "labels").select("doc_id", spam.alias("y"), F.inline(pairs))


@query(twin(["curve"], "SELECT model, round(threshold, 9) AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, is_end FROM curve"))
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.pr_curve(scored_rows(spark, folder), ["model"]))


@query(twin(["picked"], "SELECT model, round(threshold, 9) AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, true AS hit_target FROM picked"))
def threshold_pick(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.pick_threshold(scored_rows(spark, folder), ["model"], 0.9))


@query(twin(["curve"], """
SELECT model, round(threshold, 9) AS threshold, precision, round(recall, 9) AS recall, false AS hit_target FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY precision DESC, threshold, is_end) AS place FROM curve) WHERE place = 1"""))
def threshold_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A target beyond 1 cannot be hit: the first point of highest precision."""
    return rounded(evaluation.pick_threshold(scored_rows(spark, folder), ["model"], 1.1))


@query(twin(["counts"], "SELECT * FROM counts"))
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion(scored_rows(spark, folder), F.lit(0.4), ["model"])


@query(twin(["ranking"], "SELECT model, round(average_precision, 9) AS average_precision FROM ranking"))
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.ranking_metrics(scored_rows(spark, folder), ["model"]).drop("roc_auc"))


@query(twin(["ranking"], "SELECT model, round(roc_auc, 9) AS roc_auc FROM ranking"))
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.ranking_metrics(scored_rows(spark, folder), ["model"]).drop("average_precision"))


METRIC_COLUMNS = ", ".join(f"round({c}, 9) AS {c}" for c in ("precision", "recall", "f1", "accuracy", "average_precision", "roc_auc"))


@query(twin(["metrics"], f"SELECT model, tn, fp, fn, tp, {METRIC_COLUMNS} FROM metrics"))
def metrics_at_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.evaluate(scored_rows(spark, folder), F.lit(0.4), ["model"]))


@query(twin(["metrics"], f"SELECT tn, fp, fn, tp, {METRIC_COLUMNS} FROM metrics WHERE model = 'nb'"))
def metrics_one_model(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored_rows(spark, folder).where(F.col("model") == "nb").drop("model")
    return rounded(evaluation.evaluate(rows, F.lit(0.4)))


@query(twin(["metrics"], "SELECT model, " + ", ".join(
    f"round({c}, 9) AS {c}" for c in ("precision", "recall", "f1", "average_precision", "accuracy"))
    + " FROM metrics ORDER BY average_precision DESC"))
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.model_comparison(scored_rows(spark, folder), threshold=0.4))


@query(twin(["picked", "ranking"], """
SELECT model AS name, true AS hit_target, round(recall, 9) AS recall, round(average_precision, 9) AS average_precision,
  'highest recall at target precision' AS reason FROM picked JOIN ranking USING (model)
ORDER BY recall DESC, CASE model WHEN 'lr' THEN 1 WHEN 'nb' THEN 2 ELSE 3 END LIMIT 1"""))
def winner(spark: SparkSession, folder: str) -> DataFrame:
    scored = scored_rows(spark, folder)
    picks = evaluation.pick_threshold(scored, ["model"], 0.9)
    rows = picks.join(evaluation.ranking_metrics(scored, ["model"]), "model")
    candidates = rows.select(F.col("model").alias("name"), "hit_target", "recall", "average_precision")
    return rounded(evaluation.pick_winner(candidates))


@query(twin(["metrics"], """
SELECT '2025-08' AS month, round(c.f1, 9) AS challenger_f1, round(h.f1, 9) AS champion_f1, c.f1 - h.f1 >= 0 AS promoted,
  printf('challenger f1 %.4f %s champion f1 %.4f + 0.0000', c.f1, CASE WHEN c.f1 >= h.f1 THEN '>=' ELSE '<' END, h.f1) AS reason
FROM metrics c, metrics h WHERE c.model = 'rf' AND h.model = 'lr'"""))
def promotion_decision(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluation.evaluate(scored_rows(spark, folder), F.lit(0.4), ["model"])
    champion, challenger = (metrics.where(F.col("model") == m) for m in ("lr", "rf"))
    return rounded(evaluation.promotion(champion, challenger, "2025-08"))


@query("SELECT max(o_orderkey) + 1 AS version FROM orders")
def next_version(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.next_version(table(spark, folder, "orders").select(F.col("o_orderkey").alias("version")))


# Drift. The reference window is every month but the last.
part("windows", ["silver"], """
SELECT *, month_partition <> (SELECT max(month_partition) FROM silver) AS is_ref FROM silver""")
part("label_counts", ["windows"], """
SELECT count(*) FILTER (is_ref AND label = 0) AS ref_ham, count(*) FILTER (is_ref AND label = 1) AS ref_spam,
  count(*) FILTER (NOT is_ref AND label = 0) AS new_ham, count(*) FILTER (NOT is_ref AND label = 1) AS new_spam FROM windows""")
part("label_chi2", ["label_counts"], """
SELECT *, (SELECT sum(greatest(abs(o - e) - 0.5, 0) ** 2 / e) FROM (
    SELECT unnest([ref_ham, ref_spam, new_ham, new_spam])::DOUBLE AS o, unnest([
      (ref_ham + ref_spam) * (ref_ham + new_ham), (ref_ham + ref_spam) * (ref_spam + new_spam),
      (new_ham + new_spam) * (ref_ham + new_ham), (new_ham + new_spam) * (ref_spam + new_spam)])::DOUBLE
      / (ref_ham + ref_spam + new_ham + new_spam) AS e)) AS chi2 FROM label_counts""")


def drift_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = durable(
        silver_rows(spark, folder).select("email_id", "body_clean", "label", "month_partition"), "drift"
    )
    months = sorted(r[0] for r in rows.select("month_partition").distinct().collect())
    return drift.tag_windows(rows, months[0], months[-2], months[-1])


@query(twin(["label_chi2"], """
SELECT ref_ham, ref_spam, new_ham, new_spam, ref_ham + ref_spam AS ref_n, new_ham + new_spam AS new_n,
  round(ref_spam / (ref_ham + ref_spam), 9) AS ref_spam_share, round(new_spam / (new_ham + new_spam), 9) AS new_spam_share,
  round(chi2, 9) AS chi2, chi2 > 3.841458820694124 AS drifted FROM label_chi2"""))
def label_drift(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.label_drift(drift_windows(spark, folder)).drop("p_value"))


def ks_psi_parts(prefix: str, source: str, needs: list[str], key: str) -> None:
    """Parts <prefix>_ks and <prefix>_psi over `source`(key, value, ref, new)."""
    part(f"{prefix}_ks", needs, f"""
SELECT {key}, max(abs(cr / tr - cn / tn)) AS ks_stat, any_value(tr)::BIGINT AS ref_n, any_value(tn)::BIGINT AS new_n FROM (
  SELECT {key}, sum(ref) OVER w::DOUBLE AS cr, sum(new) OVER w::DOUBLE AS cn,
    sum(ref) OVER (PARTITION BY {key})::DOUBLE AS tr, sum(new) OVER (PARTITION BY {key})::DOUBLE AS tn
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY value)) GROUP BY {key}""")
    part(f"{prefix}_asked", [f"{prefix}_ks"], f"""
SELECT DISTINCT least(ref_n, new_n) AS m, greatest(ref_n, new_n) AS n, round(ks_stat * ref_n * new_n)::BIGINT AS k
FROM {prefix}_ks WHERE greatest(ref_n, new_n) <= 10000""")
    part(f"{prefix}_lattice", [f"{prefix}_asked"], f"""
SELECT m, n, k, 0::BIGINT AS i, j, (CASE WHEN j * m < k THEN 1 ELSE 0 END)::DOUBLE AS u
FROM {prefix}_asked, LATERAL (SELECT unnest(range(n + 1)) AS j)
UNION ALL
SELECT m, n, k, i + 1, j, CASE WHEN abs((i + 1) * n - j * m) < k THEN (i + 1)::DOUBLE / (i + 1 + n)
  * sum(CASE WHEN abs((i + 1) * n - j * m) < k THEN u ELSE 0 END) OVER (PARTITION BY m, n, k ORDER BY j) ELSE 0 END
FROM {prefix}_lattice WHERE i < m""", recursive=True)
    part(f"{prefix}_p", [f"{prefix}_lattice"], f"""
SELECT {key}, ks_stat, ref_n, new_n, CASE WHEN k IS NULL AND lam < 0.2 THEN 1.0::DOUBLE
  WHEN k IS NULL THEN least(greatest(2 * list_sum(list_transform(range(1, 101),
    lambda t: CASE WHEN t % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0::DOUBLE * t * t * lam * lam))), 0.0), 1.0)
  WHEN k <= 0 THEN 1.0 ELSE least(greatest(1 - u, 0.0), 1.0) END AS ks_p_value
FROM (SELECT *, ks_stat * sqrt(ref_n::DOUBLE * new_n / (ref_n + new_n)) AS lam FROM {prefix}_ks) s
LEFT JOIN (SELECT m, n, k, u FROM {prefix}_lattice WHERE i = m AND j = n) l
  ON m = least(ref_n, new_n) AND n = greatest(ref_n, new_n) AND k = round(ks_stat * ref_n * new_n)::BIGINT""")
    part(f"{prefix}_ranked", needs, f"""
SELECT {key}, value, ref, sum(ref) OVER (PARTITION BY {key} ORDER BY value) - ref AS before,
  sum(ref) OVER (PARTITION BY {key}) AS total FROM {source} WHERE ref > 0""")
    part(f"{prefix}_edges", [f"{prefix}_ranked"], f"""
SELECT {key}, list(DISTINCT edge) AS edges, min(edge) AS lo, max(edge) AS hi FROM (
  SELECT {key}, CASE WHEN h - floor(h) >= 0.5 THEN b - (b - a) * (1 - (h - floor(h))) ELSE a + (b - a) * (h - floor(h)) END AS edge FROM (
    SELECT {key}, q, any_value((total - 1) * q) AS h,
      max(CASE WHEN before <= floor((total - 1) * q) AND floor((total - 1) * q) < before + ref THEN value END) AS a,
      max(CASE WHEN before <= ceil((total - 1) * q) AND ceil((total - 1) * q) < before + ref THEN value END) AS b
    FROM {prefix}_ranked, (SELECT CASE WHEN i = 10 THEN 1.0::DOUBLE ELSE i * 0.1::DOUBLE END AS q FROM range(11) t(i))
    GROUP BY {key}, q)) GROUP BY {key}""")
    part(f"{prefix}_psi", [f"{prefix}_edges"], f"""
SELECT {key}, sum((n - r) * ln(n / r)) AS psi FROM (
  SELECT {key}, CASE WHEN r = 0 THEN 1e-6::DOUBLE ELSE r END AS r, CASE WHEN n = 0 THEN 1e-6::DOUBLE ELSE n END AS n FROM (
    SELECT {key}, bin, sum(ref) / sum(sum(ref)) OVER (PARTITION BY {key}) AS r, sum(new) / sum(sum(new)) OVER (PARTITION BY {key}) AS n FROM (
      SELECT s.*, len(list_filter(e.edges, lambda x: x > e.lo AND x < e.hi AND x <= s.value)) AS bin
      FROM {source} s JOIN {prefix}_edges e ON e.{key} = s.{key})
    GROUP BY {key}, bin)) GROUP BY {key}""")


part("event_values", [], """
SELECT event_type, value, count(*) FILTER (ts < TIMESTAMP '2024-01-21') AS ref, count(*) FILTER (ts >= TIMESTAMP '2024-01-21') AS new
FROM events GROUP BY ALL""")
ks_psi_parts("event", "event_values", ["event_values"], "event_type")
part("line_values", [], """
SELECT l_returnflag, l_extendedprice AS value, count(*) FILTER (l_shipdate < TIMESTAMP '1999-01-01') AS ref,
  count(*) FILTER (l_shipdate >= TIMESTAMP '1999-01-01') AS new FROM lineitem GROUP BY ALL""")
ks_psi_parts("line", "line_values", ["line_values"], "l_returnflag")


def tagged_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("is_ref", F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))


def line_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").withColumn(
        "is_ref", F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    )
    return drift.window_counts(rows, "l_extendedprice", ["l_returnflag"])


@query(twin(["event_psi"], "SELECT event_type, round(psi, 9) AS psi FROM event_psi"))
def psi_numeric(spark: SparkSession, folder: str) -> DataFrame:
    counts = drift.window_counts(tagged_events(spark, folder), "value", ["event_type"])
    return rounded(drift.psi(counts, ["event_type"]))


@query(twin(["line_psi"], "SELECT l_returnflag, round(psi, 9) AS psi FROM line_psi"))
def psi_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.psi(line_counts(spark, folder), ["l_returnflag"]))


@query(twin(["event_p"], "SELECT event_type, ref_n, new_n, round(ks_stat, 9) AS ks_stat, round(ks_p_value, 9) AS ks_p_value FROM event_p"))
def ks_numeric(spark: SparkSession, folder: str) -> DataFrame:
    counts = drift.window_counts(tagged_events(spark, folder), "value", ["event_type"])
    return rounded(drift.ks(counts, ["event_type"]))


@query(twin(["line_p"], "SELECT l_returnflag, ref_n, new_n, round(ks_stat, 9) AS ks_stat, round(ks_p_value, 9) AS ks_p_value FROM line_p"))
def ks_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(drift.ks(line_counts(spark, folder), ["l_returnflag"]))


@query("""
SELECT round(sum((n - r) * ln(n / r)), 9) AS psi FROM (
  SELECT count(*) FILTER (o_orderdate < TIMESTAMP '1999-01-01') / sum(count(*) FILTER (o_orderdate < TIMESTAMP '1999-01-01')) OVER () AS r,
    count(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01') / sum(count(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01')) OVER () AS n
  FROM orders GROUP BY o_orderstatus)""")
def psi_category(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").withColumn(
        "is_ref", F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    )
    return rounded(drift.psi_categories(rows, "o_orderstatus"))


def term_drift_parts(prefix: str, windows: str, text: str) -> None:
    """Parts <prefix>_terms: KS and PSI per term of a windows(email_id, is_ref, body_clean) part."""
    part(f"{prefix}_words", [windows], f"""
SELECT email_id, is_ref, list_filter({text}, lambda w: length(w) >= 2) AS w FROM {windows}""")
    part(f"{prefix}_tf", [f"{prefix}_words"], f"""
SELECT email_id, is_ref, term, count(*) AS tf FROM (SELECT email_id, is_ref, unnest(w) AS term FROM {prefix}_words) GROUP BY ALL""")
    part(f"{prefix}_vocab", [f"{prefix}_tf"], f"""
SELECT term, ln((1.0::DOUBLE + n_docs) / (1.0::DOUBLE + df)) + 1.0 AS idf FROM (
  SELECT term, count(*) AS df, sum(tf) AS total_tf, (SELECT count(*) FROM {prefix}_words WHERE is_ref) AS n_docs
  FROM {prefix}_tf WHERE is_ref GROUP BY term HAVING count(*) >= 2 ORDER BY total_tf DESC, term LIMIT 100)""")
    part(f"{prefix}_weights", [f"{prefix}_vocab"], f"""
SELECT is_ref, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY email_id)), 8) AS value FROM (
  SELECT email_id, is_ref, term, (1 + ln(tf::DOUBLE)) * idf AS w FROM {prefix}_tf JOIN {prefix}_vocab USING (term))""")
    part(f"{prefix}_held", [f"{prefix}_weights"], f"""
SELECT term, value, count(*) FILTER (is_ref) AS ref, count(*) FILTER (NOT is_ref) AS new FROM {prefix}_weights GROUP BY ALL""")
    part(f"{prefix}_counts", [f"{prefix}_held"], f"""
SELECT * FROM {prefix}_held UNION ALL
SELECT term, 0.0::DOUBLE, (SELECT count(*) FROM {windows} WHERE is_ref) - sum(ref)::BIGINT,
  (SELECT count(*) FROM {windows} WHERE NOT is_ref) - sum(new)::BIGINT FROM {prefix}_held GROUP BY term
HAVING (SELECT count(*) FROM {windows} WHERE is_ref) > sum(ref) OR (SELECT count(*) FROM {windows} WHERE NOT is_ref) > sum(new)""")
    ks_psi_parts(prefix, f"{prefix}_counts", [f"{prefix}_counts"], "term")
    part(f"{prefix}_terms", [f"{prefix}_p", f"{prefix}_psi"], f"SELECT * FROM {prefix}_p JOIN {prefix}_psi USING (term)")


term_drift_parts("drift", "windows", "string_split(body_clean, ' ')")


def term_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = drift_windows(spark, folder)
    terms = add_terms(rows, "body_clean", (1, 1))
    model = TermModel.fit(terms.where("is_ref"), min_df=2, max_df=1.0, max_terms=100)
    return rows, drift.term_drift(durable(drift.term_counts(terms, model), "term-counts"))


@query(twin(["drift_terms"], """
SELECT term, ref_n, new_n, round(ks_stat, 9) AS ks_stat, round(ks_p_value, 9) AS ks_p_value, round(psi, 9) AS psi,
  ks_p_value < 0.05 AND psi > 0.1 AS drifted FROM drift_terms"""))
def term_drift(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(term_rows(spark, folder)[1])


# A window pair that does drift: documents in the most common language against all others.
part("languages", [], """
SELECT doc_id AS email_id, lang = (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS is_ref,
  lower(regexp_replace(text, '[^A-Za-z ]', ' ', 'g')) AS body_clean FROM documents""")
term_drift_parts("lang", "languages", "string_split(body_clean, ' ')")


@query(twin(["lang_terms"], """
SELECT term, round(psi, 8) AS psi, round(ks_stat, 9) AS ks_stat FROM lang_terms
WHERE ks_p_value < 0.05 AND psi > 0.1 ORDER BY psi DESC, term LIMIT 20"""))
def top_drifted_terms(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents", "doc_id")
    common = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").first()["lang"]
    rows = docs.select(
        (F.col("lang") == common).alias("is_ref"),
        F.lower(letters_or_space(F.col("text"))).alias("body_clean"),
    )
    terms = add_terms(rows, "body_clean", (1, 1))
    model = TermModel.fit(terms.where("is_ref"), min_df=2, max_df=1.0, max_terms=100)
    found = drift.top_drifted(drift.term_drift(durable(drift.term_counts(terms, model), "term-counts")))
    return found.select("term", F.round("psi", 8).alias("psi"), F.round("ks_stat", 9).alias("ks_stat"))


part("report", ["drift_terms", "label_chi2"], """
SELECT t.*, chi2, chi2 > 3.841458820694124 AS label_drifted,
  greatest(0.7::DOUBLE * least(mean_psi / 0.25, 1.0::DOUBLE) + 0.3::DOUBLE * (chi2 > 3.841458820694124)::INTEGER, 0.0::DOUBLE) AS drift_score
FROM (SELECT count(*) AS n_features, count(*) FILTER (ks_p_value < 0.05 AND psi > 0.1) AS ks_drifted_features,
  avg(psi) AS mean_psi, max(psi) AS max_psi FROM drift_terms) t, label_chi2""")


REPORT = twin(["report"], """
SELECT n_features, ks_drifted_features, round(mean_psi, 8) AS mean_psi, round(max_psi, 8) AS max_psi, round(chi2, 8) AS chi2,
  label_drifted, round(drift_score, 8) AS drift_score, drift_score >= 0.25 AS retrain FROM report""")


def score_row(rows: DataFrame, terms: DataFrame) -> DataFrame:
    report = drift.retrain_gate(drift.drift_report(drift.label_drift(rows), terms))
    report = report.withColumnRenamed("drifted", "label_drifted")
    return rounded(
        report.select("n_features", "ks_drifted_features", "mean_psi", "max_psi", "chi2", "label_drifted",
                      "drift_score", "retrain"), 8)


@query(REPORT)
def drift_score(spark: SparkSession, folder: str) -> DataFrame:
    return score_row(*term_rows(spark, folder))


@query(REPORT)
def drift_score_from_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The same report from a ledger filled in two runs, by a window that has slid over all its months;
    texts are read once, when their month enters the ledger."""
    rows = durable(silver_rows(spark, folder).select("email_id", "body_clean", "label", "month_partition"), "silver")
    book = Ledger(new_path(spark, "ledger"))
    months = sorted(r[0] for r in rows.select("month_partition").distinct().collect())
    half = months[len(months) // 2]
    book.update(rows.where(F.col("month_partition") <= half))
    book.update(rows)
    totals = book.totals(spark)
    # From the months after the first two to those before the last.
    window = ledger.slid(ledger.window_totals(totals, months[2:]), totals, months[:2], months[-1:])
    tagged = drift.tag_windows(book.documents(spark), months[0], months[-2], months[-1])
    model = ledger.vocabulary(window, 2, 100)
    return score_row(tagged, drift.term_drift(durable(ledger.drift_counts(tagged, model), "term-counts")))


@query(twin(["bronze"], """
SELECT month_partition, avg(label) AS spam_share, avg(label) < 0.10 OR avg(label) > 0.90 AS drift_flag
FROM bronze GROUP BY month_partition"""))
def drift_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows = bronze_rows(spark, folder)
    metrics = {"spam_share": F.avg("label"), "drift_flag": label_distribution("label")["drift_flag"]}
    return profile(rows, metrics, ["month_partition"])


@query("""
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, strftime(date_trunc('month', o_orderdate) - INTERVAL 6 MONTH, '%Y-%m') AS ref_start,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS ref_end FROM orders""")
def default_ref_window(spark: SparkSession, folder: str) -> DataFrame:
    months = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    return months.withColumns(drift.default_window(F.col("month")))
