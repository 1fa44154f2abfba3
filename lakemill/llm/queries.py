"""The named queries of the dealt operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import bpe, chat, decontaminate, jaccard, langid, lm, merkle, pii, rules, runs, suffix_dedup, token_files, toxicity
from lakemill.llm.sample import remainder
from lakemill.session import new_path
from lakemill.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
    n AS (SELECT doc_id, text, w, len(w) AS n_words FROM d),
    win AS (
        SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(n_words - 6, 1))) AS i FROM n)),
    rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
    cov AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM rep WHERE c > 1) GROUP BY doc_id),
    ln AS (SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
           WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM ln GROUP BY doc_id),
    m AS (
        SELECT n.doc_id, CAST(n_words AS BIGINT) AS n_words,
               CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(n_lines, 0) AS n_lines,
               CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
               CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters,
               CAST(len(list_filter(w, lambda x: ends_with(x, '!'))) AS BIGINT) AS n_marked,
               CAST(len(list_filter(range(2, n_words + 1), lambda k: w[k] = w[k - 1])) AS BIGINT) AS n_stutters
        FROM n LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id)),
    f AS (SELECT *, CAST(
            CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END
            + CASE WHEN 3 * n_dup_lines > n_lines AND n_dup_lines > 2 THEN 8 ELSE 0 END
            + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
            + CASE WHEN 2 * n_upper > n_letters AND n_letters > 40 THEN 32 ELSE 0 END
            + CASE WHEN 3 * n_marked > n_words THEN 64 ELSE 0 END
            + CASE WHEN 100 * n_stutters > 30 * n_words THEN 128 ELSE 0 END AS BIGINT) AS failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           failed & 3 <> 0 AS base_failed, failed & 239 = 0 AS kept, failed
    FROM f
    """
)
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of `documents` under policy v2; policy v1 is the base verdict."""
    rows = rules.ledger(table(spark, folder, "documents"))
    base = ~rules.decided(rows, "v1")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & rules.decided(rows, "v2")).alias("kept"), "failed",
    )


@query(
    r"""
    WITH RECURSIVE
    t AS (SELECT md5(text) AS n, min(doc_id) AS low, regexp_extract_all(lower(any_value(text)), '[^\x20\x09-\x0D]+') AS w
          FROM documents WHERE text IS NOT NULL GROUP BY 1),
    g AS (SELECT DISTINCT n, array_to_string(w[i:i+4], ' ') AS s
          FROM (SELECT n, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
    z AS (SELECT n, count(*) AS c FROM g GROUP BY n),
    p AS (SELECT a.n AS a, b.n AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.n < b.n GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN z x ON x.n = a JOIN z y ON y.n = b WHERE 5 * i >= 4 * (x.c + y.c - i)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    reach AS (SELECT n, n AS m FROM z UNION SELECT reach.n, e.b FROM reach JOIN e ON e.a = reach.m),
    cls AS (SELECT reach.n, min(t.low) AS class_id FROM reach JOIN t ON t.n = reach.m GROUP BY reach.n),
    k AS (SELECT a AS n, count(*) AS links FROM e GROUP BY a)
    SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(links, 0) AS n_links
    FROM documents LEFT JOIN cls ON cls.n = md5(text) LEFT JOIN k ON k.n = md5(text)
    """
)
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of `documents` and the links of each document."""
    return jaccard.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


@query()
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in `documents`, with the best window of each."""
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark")).withColumnRenamed(
        "item", "item_id"
    )


@query()
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of each document; learned from the documents that are not held out."""
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predicted(docs, model, "doc_id", held_out.alias("held_out"))


@query()
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of each document; learned from the labels that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    lexicon = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.scores(docs, lexicon, "doc_id", held_out.alias("held_out"))


@query()
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram base and backoff model scores of each document; learned from those not held out."""
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 10) == 0
    model = lm.fit(docs.where(~held_out), order=3, least=1)  # trigrams, none left out
    rows = lm.scored(docs, model, "doc_id", held_out.alias("held_out"), learned=~held_out)
    return rows.withColumn("train_tokens", F.lit(model.total).cast("long"))


@query()
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """`documents` as token files of the shared folder, read back."""
    made = token_files.written(
        table(spark, folder, "documents"), new_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), end=2
    )
    return token_files.read(spark, made)


def byte_ranks() -> bpe.Ranks:
    return bpe.Ranks.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each document and the bytes they decode to, as digests."""
    ranks = byte_ranks()
    rows = bpe.round_trip(table(spark, folder, "documents"), ranks, "doc_id")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _chat_twin() -> str:
    escaped = r"regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')"
    return rf"""
    WITH c AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    o AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM c
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    p AS (SELECT *, CASE coalesce(before, 'start') WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
                    WHEN 'user' THEN role = 'assistant' ELSE role = 'user' END AS fits FROM o),
    g AS (
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(role) + 6 + length({escaped}) + 9) AS BIGINT) AS formatted_chars,
               bool_and(fits) AS valid, arg_max(role, k) = 'assistant' AS closed
        FROM p GROUP BY conv_id)
    SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, valid AND closed AS complete FROM g
    """


@query(_chat_twin())
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All `conversations`, and one that holds control strings, formatted and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.formatted(turns.unionByName(more)))


@query()
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of each document."""
    rows = pii.spans(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query()
def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """`documents` without the bytes of any string of 200 bytes that occurs twice, first copies included."""
    rows = suffix_dedup.removed(table(spark, folder, "documents"), 200, keep="none")
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def with_runs(docs: DataFrame) -> DataFrame:
    """`docs` in which every tenth text, by a hash of its id, repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    planted = docs.withColumn("_w", F.when(h % 10 == 0, words)).withColumn("_g", F.floor(h / 10))
    planted = planted.withColumn("_n", F.size("_w")).withColumn("_a", F.expr("_g % greatest(_n, 1)"))
    planted = planted.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    repeated = F.expr(
        "array_join(transform(sequence(0, _n - 1), i -> element_at(_w, CAST(1 + if(i < _a, i, _a + (i - _a) % _p) AS INT))), ' ')"
    )
    return planted.withColumn("text", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text"))).select(*docs.columns)


@query()
def op12_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of `documents`, every tenth of which holds a planted one."""
    rows = runs.found(with_runs(table(spark, folder, "documents").select("doc_id", "text")), least=24, exponent=3)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of `documents`; every fifth row, by a hash of its id, is presented with its text in lower case."""
    tampered = remainder(F.col("doc_id"), 5) == 0
    lower = F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    return merkle.manifest(
        table(spark, folder, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], shown={"text": lower}
    )
