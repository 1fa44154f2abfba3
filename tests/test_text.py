import unicodedata

import pytest
from pyspark.sql import functions as F

from lakemill.functions import cleaning, features
from lakemill.functions.folding import fold_ascii
from lakemill.operators import silver


def apply(spark, fn, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("t"))).collect()]


def test_every_code_point_folds_as_python_does(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["a" + "b".join(map(chr, codes[i : i + 512])) + "z" for i in range(0, len(codes), 512)]
    want = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert apply(spark, fold_ascii, texts) == want


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Free!!! cescapenumber cash prize now", "free escapenumber cash prize now"),
        ("ＦＲＥＥ café\n\tSoooo goood", "free cafe soo good"),
        ("a an the to", "the"),
        ("", ""),
        ("!!! ?? ..", ""),
        ("one_two three-four", "one two three four"),
        (None, "none"),
    ],
)
def test_clean_text(spark, raw, clean):
    assert apply(spark, cleaning.clean_text, [raw]) == [clean]


def test_one_pass_chain_equals_the_steps(spark):
    texts = ["Viiiiagra... 3bescapenumber!! \x1c\x0b tabs\there", "été ½ ﬁne ™ №5", "aaaa____bbbb    cc", "x y zzz www"]

    def steps(c):
        c = cleaning.squeeze_runs(cleaning.linebreaks_to_space(F.lower(fold_ascii(c))))
        c = cleaning.collapse_spaces(cleaning.symbols_to_space(cleaning.merge_marker(c)))
        return cleaning.drop_short_words(c)

    assert apply(spark, cleaning.clean_text, texts) == apply(spark, steps, texts)


def test_unfolded_cleaner(spark):
    # Accented letters, composed or not, separate words; runs of three or more become one.
    texts = ["Viiiiagra caf\u00e9 noe\u0301tre", "baaad goood"]
    assert apply(spark, cleaning.clean_text_unfolded, texts) == ["viagra caf tre", "bad god"]


def test_strip_markup(spark):
    texts = ["<b>Hi</b> see http://x.y/z now www.a.b 123 don't", None]
    assert apply(spark, cleaning.strip_markup, texts) == ["Hi see now dont", ""]


def test_features_of_the_sample_mail(spark):
    body = "FREE cash prize!!! click here 3bescapenumber now"
    df = spark.createDataFrame([("e1", body, 1, "2025-01")], "email_id string, body string, label int, month_partition string")
    row = silver.featured(df).first()
    assert row["body_clean"] == "free cash prize click here escapenumber now"
    assert row["spam_keyword_count"] >= 3
    assert row["has_escapenumber"] == 1
    assert row["exclaim_count"] == 3


def test_scoring_features_use_the_same_formulas(spark):
    df = spark.createDataFrame([("Hi team!!!",)], "t string")
    row = features.add_scoring_features(features.add_clean(df, "t"), "t").first()
    # 'hi' is dropped by the cleaner, so check the formulas on the given clean text too.
    assert row["body_clean"] == "team" and row["exclaim_count"] == 3
    given = spark.createDataFrame([("Hi team!!!", "hi team", ["hi", "team"])], "t string, body_clean string, tokens array<string>")
    row = features.add_scoring_features(given, "t").first()
    assert (row["log_chars"], row["avg_word_length"], row["unique_word_ratio"], row["exclaim_count"]) == (2.0794, 3.5, 1.0, 3)


def test_empty_text_features(spark):
    df = spark.createDataFrame([("e", "!!", 0, "m")], "email_id string, body string, label int, month_partition string")
    row = silver.featured(df).first()
    assert (row["word_count"], row["n_unique_words"], row["unique_word_ratio"], row["repetition_ratio"]) == (0, 0, 0.0, 1.0)


def test_half_even_rounding(spark):
    from lakemill.functions.numbers import half_even

    rows = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    assert [r[0] for r in rows.select(half_even(F.col("x"), 2)).collect()] == [0.12, 0.38, 2.5]


def test_phrases_and_overlaps(spark):
    def count(c):
        return features.keyword_count(c, ["win", "winner", "click here"])

    assert apply(spark, count, ["win winner winners click here", "clickhere"]) == [3, 0]


def test_no_python_in_cleaning_plans(spark):
    df = spark.createDataFrame([("e", "x", 0, "m")], "email_id string, body string, label int, month_partition string")
    plan = silver.silver(df.withColumn("received_at", F.lit(None).cast("timestamp_ntz")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "ArrowEval" not in text


def test_markup_is_stripped_as_the_steps_do(spark):
    space = f"[{cleaning.UNICODE_SPACE}]+"
    codes = spark.range(1, 0x110000).where("id < 55296 OR id > 57343").selectExpr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32') AS c")
    rows = codes.select(F.concat(F.lit("a <b> 9"), "c", F.lit(" http://x.y B"), "c", "c").alias("t"))
    steps = F.regexp_replace("t", r"<[^>]+>", "")
    steps = F.regexp_replace(steps, rf"http[^{cleaning.UNICODE_SPACE}]+|www\.[^{cleaning.UNICODE_SPACE}]+", "")
    steps = F.trim(F.regexp_replace(F.regexp_replace(steps, rf"[^a-zA-Z{cleaning.UNICODE_SPACE}]", ""), space, " "))
    got = rows.select(steps.alias("a"), cleaning.strip_markup(F.col("t")).alias("b"))
    assert got.where("NOT a <=> b").isEmpty() and got.count() == 0x110000 - 2048 - 1
    words = rows.select(*[
        F.regexp_extract_all(t, F.lit("[A-Za-z]+"), F.lit(0)).alias(n)
        for n, t in (("a", F.regexp_replace("t", "[^A-Za-z ]", " ")), ("b", cleaning.letters_or_space(F.col("t"))))
    ])
    assert words.where("a <> b").isEmpty()


def test_stop_words_are_a_hash_set(spark):
    rows = spark.createDataFrame([("The cash a prize <b>cash</b>",), (None,)], "t string")
    out = features.add_stopword_filter(rows, "t", ["the", "a"])
    assert [(r["n_stopwords_removed"], r["text_processed"]) for r in out.collect()] == [(2, "cash prize cash"), (0, "")]
    assert "INSET" in features.add_stopword_filter(rows, "t", [f"w{k}" for k in range(20)])._jdf.queryExecution().optimizedPlan().toString()
