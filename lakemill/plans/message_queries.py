"""Queries of message scoring and of the older text pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import cleaning, features
from lakemill.functions.fixed import DOMAIN_STOP_WORDS, STOP_WORDS
from lakemill.functions.messages import header, input_text
from lakemill.operators import messages
from lakemill.plans.catalog import query
from lakemill.plans.twins import UNICODE_SPACE, clean_parts, even, part, squeeze, twin
from lakemill.session import durable
from lakemill.sources.tables import table, text_table

# The mailbox: conversation turns as messages, with a subject, a time and a score by rule.
part("inbox", [], """
SELECT message_id, CASE conv_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE role || ' of ' || conv_id END AS subject, body,
  left(text, 240) AS snippet, TIMESTAMP '2025-03-01' + to_minutes(conv_id * 90 + turn) AS ts,
  ((conv_id * 13 + turn * 5) % 41) / 40.0::DOUBLE AS p
FROM (SELECT *, conv_id || '-' || turn AS message_id, text AS body FROM conversations
  UNION ALL SELECT *, conv_id || '-' || turn || '-gap', CASE (conv_id * 7 + turn) % 9 WHEN 1 THEN '  ' WHEN 2 THEN '!! ?' END
    FROM conversations WHERE (conv_id * 7 + turn) % 9 < 3)""")


def inbox(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn as a message, and beside some of them a message without a usable body."""
    conv, turn = F.col("conv_id"), F.col("turn")
    kind = (conv * 7 + turn) % 9
    gap = F.when(kind == 1, "  ").when(kind == 2, "!! ?")
    name = F.concat_ws("-", conv, turn)
    given = F.struct(name.alias("message_id"), F.col("text").alias("body"))
    planted = F.struct(F.concat(name, F.lit("-gap")).alias("message_id"), gap.alias("body"))
    rows = text_table(spark, folder, "conversations", "conv_id")
    rows = rows.select("*", F.inline(F.when(kind < 3, F.array(given, planted)).otherwise(F.array(given))))
    return rows.select(
        "message_id",
        F.when(conv % 5 == 0, F.lit(None)).when(conv % 5 == 1, "").otherwise(
            F.concat("role", F.lit(" of "), conv.cast("string"))).alias("subject"),
        "body",
        F.left("text", F.lit(240)).alias("snippet"),
        (F.lit("2025-03-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(conv * 90 + turn).cast("int"))).alias("ts"),
        (((conv * 13 + turn * 5) % 41) / F.lit(40.0)).alias("p"),
    )


part("inputs", ["inbox"], f"""
SELECT *, regexp_replace(concat_ws(' ', nullif(subject, ''), nullif(body, '')), '^[{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+$', '', 'g') AS input_text
FROM inbox""")
part("kept_inputs", ["inputs"], "SELECT * FROM inputs WHERE input_text <> ''")
clean_parts("message", "kept_inputs", ["kept_inputs"], "input_text")
part("decided", ["message_clean"], """
SELECT *, CASE WHEN body_clean = '' THEN 0.0::DOUBLE ELSE p END AS spam_probability,
  CASE WHEN body_clean = '' THEN 'not_spam' WHEN p >= 0.6 THEN 'spam' ELSE 'not_spam' END AS label,
  CASE WHEN body_clean = '' THEN 'input contained no usable tokens after cleaning' END AS note FROM message_clean""")
part("mail_log", ["decided"], """
SELECT ts AS timestamp, message_id, left(coalesce(subject, ''), 200) AS subject, left(coalesce(snippet, ''), 200) AS snippet,
  label AS prediction, printf('%.6f', spam_probability) AS spam_probability,
  CASE WHEN length(input_text) % 17 = 0 THEN 'ERROR' WHEN label = 'spam' THEN 'AI_SPAM' ELSE 'AI_HAM' END AS applied_label FROM decided""")


def decided_rows(spark: SparkSession, folder: str) -> DataFrame:
    return messages.decided(messages.prepared(inbox(spark, folder)), F.lit(0.6))


def log_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = decided_rows(spark, folder)
    return messages.mail_log(rows, F.col("ts"), F.length("input_text") % 17 == 0)


@query(twin(["inputs"], "SELECT message_id, input_text FROM inputs"))
def build_input_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = inbox(spark, folder)
    return rows.select("message_id", input_text(F.col("subject"), F.col("body")).alias("input_text"))


@query(twin(["inputs"], "SELECT message_id, 'Subject or body must not be empty.' AS error FROM inputs WHERE input_text = ''"))
def reject_blank(spark: SparkSession, folder: str) -> DataFrame:
    return messages.blank(inbox(spark, folder)).select("message_id", "error")


@query(twin(["message_clean"], f"""
SELECT message_id, {even('ln(1 + length(body_clean)::DOUBLE)', 4)} AS log_chars, {even('length(body_clean) / greatest(len(tokens), 1)', 2)} AS avg_word_length,
  {even('len(list_distinct(tokens)) / greatest(len(tokens), 1)', 4)} AS unique_word_ratio, len(regexp_extract_all(input_text, '!'))::INTEGER AS exclaim_count
FROM message_clean"""))
def scoring_features(spark: SparkSession, folder: str) -> DataFrame:
    return messages.prepared(inbox(spark, folder)).select(
        "message_id", "log_chars", "avg_word_length", "unique_word_ratio", "exclaim_count"
    )


@query(twin(["decided"], "SELECT message_id, label, spam_probability, 0.6::DOUBLE AS threshold, note FROM decided"))
def score_decisions(spark: SparkSession, folder: str) -> DataFrame:
    rows = decided_rows(spark, folder)
    return rows.select("message_id", "label", "spam_probability", "threshold", "note")


@query(twin(["decided"], """
SELECT ts AS timestamp, replace(replace(coalesce(subject, ''), chr(10), ' '), chr(13), ' ') AS subject,
  replace(replace(coalesce(body, ''), chr(10), ' '), chr(13), ' ') AS body, label AS prediction,
  printf('%.6f', spam_probability) AS spam_probability FROM decided"""))
def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    return messages.prediction_log(decided_rows(spark, folder), F.col("ts"))


@query(twin(["mail_log"], "SELECT * FROM mail_log"))
def mail_log(spark: SparkSession, folder: str) -> DataFrame:
    return log_rows(spark, folder)


@query(twin(["mail_log"], """
SELECT count(*) AS n_total, count(*) FILTER (prediction = 'spam') AS n_spam, count(*) FILTER (prediction <> 'spam') AS n_ham,
  count(*) FILTER (timestamp::DATE = DATE '2025-03-04') AS n_today FROM mail_log"""))
def feed_summary(spark: SparkSession, folder: str) -> DataFrame:
    return messages.feed_summary(log_rows(spark, folder), F.lit("2025-03-04").cast("date"))


@query(twin(["mail_log"], """
SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, message_id, subject, snippet, prediction,
  round(spam_probability::DOUBLE, 3) AS spam_probability, applied_label
FROM mail_log ORDER BY mail_log.timestamp DESC, message_id LIMIT 50"""))
def recent_feed(spark: SparkSession, folder: str) -> DataFrame:
    return messages.recent_feed(log_rows(spark, folder))


# Multi-part messages: pages as html parts, documents as plain parts; empty and damaged parts in messages beside them.
part("mime_parts", [], """
SELECT 'm' || page_id AS message_id, 2 AS part_no, 'text/html' AS mime,
  translate(to_base64(encode(html)), '+/', '-_') AS data FROM pages
UNION ALL SELECT 'g' || page_id, 2, 'text/html', CASE page_id % 7 WHEN 1 THEN '%%%' END FROM pages WHERE page_id % 7 < 2
UNION ALL SELECT 'm' || doc_id, 3, 'text/plain', translate(to_base64(encode(text)), '+/', '-_') FROM documents
UNION ALL SELECT 'g' || doc_id, 3, 'text/plain', '' FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT 'm' || doc_id, 1, 'text/plain', CASE WHEN doc_id % 5 = 0 THEN translate(to_base64(encode(source)), '+/', '-_') END FROM documents
UNION ALL SELECT 'm' || doc_id, 0, 'multipart/mixed', CASE WHEN doc_id % 11 = 0 THEN translate(to_base64(encode(lang)), '+/', '-_') END FROM documents""")
part("mime_text", ["mime_parts"], """
SELECT *, CASE WHEN data IS NULL OR data = '' THEN NULL WHEN data = '%%%' THEN ''
  ELSE decode(from_base64(translate(data, '-_', '+/'))) END AS t FROM mime_parts""")


def mime_parts(spark: SparkSession, folder: str) -> DataFrame:
    def coded(text: str) -> F.Column:
        return F.translate(F.base64(F.col(text).cast("binary")), "+/", "-_")

    def parts(rows: DataFrame, key: str, no: int, mime: str, data, kind: str = "m") -> DataFrame:
        return rows.select(F.concat(F.lit(kind), F.col(key).cast("string")).alias("message_id"), F.lit(no).alias("part_no"),
                           F.lit(mime).alias("mime"), data.alias("data"))

    pages, docs = (text_table(spark, folder, n, k) for n, k in (("pages", "page_id"), ("documents", "doc_id")))
    page, doc = F.col("page_id"), F.col("doc_id")
    return (
        parts(pages, "page_id", 2, "text/html", coded("html"))
        .unionByName(parts(pages.where(page % 7 < 2), "page_id", 2, "text/html", F.when(page % 7 == 1, "%%%"), "g"))
        .unionByName(parts(docs, "doc_id", 3, "text/plain", coded("text")))
        .unionByName(parts(docs.where(doc % 3 == 0), "doc_id", 3, "text/plain", F.lit(""), "g"))
        .unionByName(parts(docs, "doc_id", 1, "text/plain", F.when(doc % 5 == 0, coded("source"))))
        .unionByName(parts(docs, "doc_id", 0, "multipart/mixed", F.when(doc % 11 == 0, coded("lang"))))
    )


@query(twin(["mime_text"], """
SELECT message_id, coalesce(min_by(t, part_no) FILTER (part_no = 0 AND t IS NOT NULL), min_by(t, part_no) FILTER (mime = 'text/plain' AND t <> ''),
  min_by(t, part_no) FILTER (mime = 'text/html' AND t <> ''), '') AS body FROM mime_text GROUP BY message_id"""))
def body_from_parts(spark: SparkSession, folder: str) -> DataFrame:
    return messages.bodies(mime_parts(spark, folder))


# Nested messages of five levels: (part, parent, place, mime). Part g holds the text four levels down, after
# the empty ones on its way; x hangs on a parent that is not there, and y and z on each other.
TREE = [
    ("r", None, 0, "multipart/mixed"), ("a", "r", 1, "multipart/alternative"), ("b", "r", 0, "multipart/related"),
    ("c", "b", 0, "multipart/alternative"), ("e", "c", 1, "text/html"), ("f", "c", 0, "multipart/mixed"),
    ("g", "f", 0, "text/plain"), ("h", "a", 0, "text/plain"), ("x", "missing", 0, "text/plain"),
    ("y", "z", 0, "text/plain"), ("z", "y", 0, "text/plain"),
]
CODED = "translate(to_base64(encode({})), '+/', '-_')"
TREE_ROWS = ", ".join(
    f"('{name}', {f"'{parent}'" if parent else 'NULL'}, {place}, '{mime}')" for name, parent, place, mime in TREE
)
part("tree_parts", [], f"""
SELECT 'd' || doc_id AS message_id, t.*, CASE part_id
  WHEN 'r' THEN CASE WHEN doc_id % 11 = 0 THEN {CODED.format('lang')} END
  WHEN 'e' THEN {CODED.format('source')}
  WHEN 'g' THEN CASE WHEN doc_id % 3 = 0 THEN '' ELSE {CODED.format('text')} END
  WHEN 'h' THEN CASE WHEN doc_id % 6 <> 0 THEN {CODED.format('lang')} END
  WHEN 'x' THEN {CODED.format('source')} WHEN 'y' THEN {CODED.format('source')} WHEN 'z' THEN {CODED.format('source')} END AS data
FROM documents, (VALUES {TREE_ROWS}) t(part_id, parent_id, place, mime)""")
part("tree_walk", ["tree_parts"], """
SELECT message_id, part_id, mime, data, []::INTEGER[] AS path FROM tree_parts WHERE parent_id IS NULL
UNION ALL
SELECT p.message_id, p.part_id, p.mime, p.data, list_append(w.path, p.place) FROM tree_parts p
JOIN tree_walk w ON w.message_id = p.message_id AND w.part_id = p.parent_id""", recursive=True)
part("tree_text", ["tree_walk"], """
SELECT *, CASE WHEN data IS NULL OR data = '' THEN NULL ELSE decode(from_base64(translate(data, '-_', '+/'))) END AS t FROM tree_walk""")


@query(twin(["tree_text"], """
SELECT message_id, coalesce(min_by(t, path) FILTER (len(path) = 0 AND t IS NOT NULL), min_by(t, path) FILTER (mime = 'text/plain' AND t <> ''),
  min_by(t, path) FILTER (mime = 'text/html' AND t <> ''), '') AS body FROM tree_text GROUP BY message_id"""))
def body_from_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies of documents wrapped in nested parts, chosen in depth-first order."""
    docs = text_table(spark, folder, "documents", "doc_id")
    doc = F.col("doc_id")

    def coded(text: str) -> F.Column:
        return F.translate(F.base64(F.col(text).cast("binary")), "+/", "-_")

    data = {
        "r": F.when(doc % 11 == 0, coded("lang")), "e": coded("source"), "g": F.when(doc % 3 == 0, "").otherwise(coded("text")),
        "h": F.when(doc % 6 != 0, coded("lang")), "x": coded("source"), "y": coded("source"), "z": coded("source"),
    }
    parts = [
        F.struct(
            F.lit(name).alias("part_id"), F.lit(parent).cast("string").alias("parent_id"), F.lit(place).alias("place"),
            F.lit(mime).alias("mime"), data.get(name, F.lit(None)).cast("string").alias("data"),
        )
        for name, parent, place, mime in TREE
    ]
    rows = docs.select(F.concat(F.lit("d"), doc.cast("string")).alias("message_id"), F.inline(F.array(*parts)))
    return messages.tree_bodies(durable(rows, "parts"))


@query("""
SELECT conv_id || '-' || turn AS message_id, CASE turn % 4 WHEN 2 THEN '' ELSE text END AS subject FROM conversations""")
def header_lookup(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.col("turn") % 4

    def pair(name: str, value) -> F.Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    sender = pair("From", F.col("role"))
    headers = (
        F.when(turn == 0, F.array(sender, pair("SUBJECT", F.col("text"))))
        .when(turn == 1, F.array(pair("subject", F.col("text")), sender))
        .when(turn == 2, F.array(sender))
        .otherwise(F.array(pair("Subject", F.lit("first")), pair("sUbJeCt", F.col("text"))))
    )
    rows = table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"), headers.alias("headers")
    )
    return rows.select("message_id", header(F.col("headers"), "subject").alias("subject"))


# One user in each event type stands for a message that arrives again and again.
@query("""
SELECT message_id, event_id, ts, value FROM (
  SELECT event_type || '-' || (CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END) AS message_id, event_id, ts, value FROM events)
QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY event_id) = 1""")
def dedupe_messages(spark: SparkSession, folder: str) -> DataFrame:
    user = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    rows = table(spark, folder, "events").select(
        F.concat_ws("-", "event_type", user.cast("string")).alias("message_id"), "event_id", "ts", "value"
    )
    return messages.first_occurrences(rows, "event_id")


# The older text pipeline.
@query(twin(["mails"], f"""
SELECT doc_id, array_to_string(list_filter(string_split_regex(regexp_replace({squeeze('ch', 1)}, '[^a-z0-9\\x09-\\x0D\\x1C-\\x20]', ' ', 'g'),
  '[\\x09-\\x0D\\x1C-\\x20]+'), lambda w: length(w) >= 3), ' ') AS body_clean
FROM (SELECT doc_id, string_split(regexp_replace(lower(nfc_normalize(body)), '[\\n\\r\\t]+', ' ', 'g'), '') AS ch FROM mails)"""))
def clean_text_unfolded(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents", "doc_id")
    return docs.select("doc_id", cleaning.clean_text_unfolded(F.col("text")).alias("body_clean"))


def strip_sql(text: str) -> str:
    return f"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({text}, ''), '<[^>]+>', '', 'g'),
  'http[^{UNICODE_SPACE}]+|www\\.[^{UNICODE_SPACE}]+', '', 'g'), '[^a-zA-Z{UNICODE_SPACE}]', '', 'g'), '[{UNICODE_SPACE}]+', ' ', 'g'))"""


STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in [*STOP_WORDS, *DOMAIN_STOP_WORDS])

part("stripped", [], f"SELECT doc_id, text, list_filter(string_split(lower({strip_sql('text')}), ' '), lambda w: w <> '') AS text_tokens FROM documents")
part("stopped", ["stripped"], f"""
SELECT *, len(text_tokens) - len(kept) AS removed, array_to_string(kept, ' ') AS text_processed FROM (
  SELECT *, list_filter(text_tokens, lambda w: length(w) >= 3 AND w NOT IN ({STOP_LIST})) AS kept FROM stripped)""")
part("stats", ["stopped"], """
SELECT doc_id, removed::INTEGER AS n_stopwords_removed, length(text)::INTEGER AS n_chars,
  len(list_distinct(string_split(replace(text, ' ', ''), '')))::INTEGER AS n_unique_chars,
  len(text_tokens)::INTEGER AS n_words, len(list_distinct(text_tokens))::INTEGER AS n_unique_words FROM stopped""")


@query(f"SELECT page_id, {strip_sql('html')} AS stripped FROM pages")
def strip_markup(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "pages", "page_id").select("page_id", cleaning.strip_markup(F.col("html")).alias("stripped"))


def stopped_rows(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    return features.add_stopword_filter(docs, "text", STOP_WORDS)


@query(twin(["stopped"], "SELECT doc_id, removed::INTEGER AS n_stopwords_removed, text_processed FROM stopped"))
def stopword_filter(spark: SparkSession, folder: str) -> DataFrame:
    return stopped_rows(spark, folder).select("doc_id", "n_stopwords_removed", "text_processed")


@query(twin(["stats"], "SELECT * FROM stats"))
def row_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_row_stats(stopped_rows(spark, folder), "text")
    return rows.select("doc_id", "n_stopwords_removed", "n_chars", "n_unique_chars", "n_words", "n_unique_words")


RATIO_SQL = {
    "perc_stopwords_removed": "r / w", "perc_unique_words": "u / w", "stopword_ratio": "(w - r) / w",
    "unique_word_ratio": "u / w", "unique_char_ratio": "uc / c", "avg_word_length": "c / w",
    "log_words": "ln(1 + w)", "log_chars": "ln(1 + c)", "chars_per_unique_word": "c / u",
    "repetition_ratio": "1 - u / w", "char_repetition": "1 - uc / c", "content_ratio": "r / w",
    "stopword_vs_unique": "(w - r) / u", "complexity": "u / w * (c / w)", "info_density": "u / c",
}


@query(twin(["stats"], "SELECT doc_id, " + ", ".join(f"round({e}, 9) AS {n}" for n, e in RATIO_SQL.items()) + """
FROM (SELECT doc_id, n_stopwords_removed::DOUBLE AS r, nullif(n_words, 0)::DOUBLE AS w, nullif(n_unique_words, 0)::DOUBLE AS u,
  nullif(n_chars, 0)::DOUBLE AS c, n_unique_chars::DOUBLE AS uc FROM stats)"""))
def row_ratios(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_row_ratios(features.add_row_stats(stopped_rows(spark, folder), "text"))
    return rows.select("doc_id", *[F.round(n, 9).alias(n) for n in RATIO_SQL])
