import math
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakemill.functions.fixed import DROPPED_FEATURES, NUMERIC_FEATURES
from lakemill.operators import splits
from lakemill.operators.scaling import ScalerModel
from lakemill.operators.terms import TermModel, add_terms, counted_terms, vocabulary


def test_feature_selection_and_gate(spark):
    cols = [*DROPPED_FEATURES, *NUMERIC_FEATURES]
    df = spark.createDataFrame([("e", *[1.0] * len(cols))], ["email_id", *cols])
    kept = splits.select_features(df)
    assert not set(DROPPED_FEATURES) & set(kept.columns) and kept.count() == 1
    broken = splits.select_features(df.withColumn("log_chars", F.lit(None).cast("double")))
    with pytest.raises(PySparkException):
        broken.collect()


def split_frame(spark, n):
    return spark.range(n).select(
        F.format_string("email_%05d", "id").alias("email_id"),
        (F.col("id") % 3 == 0).cast("int").alias("label"),
        F.when(F.col("id") % 10 == 0, "2025-02").otherwise("2025-01").alias("month_partition"),
    )


@pytest.mark.parametrize("n", [40, 1000, 5003])
def test_split_is_exact_stratified_and_disjoint(spark, n):
    rows = splits.split(split_frame(spark, n), "2025-02").cache()
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    rest = rows.where("month_partition <> '2025-02'")
    total, spam = rest.count(), rest.where("label = 1").count()
    assert sizes["val"] == math.ceil(total * 0.15)
    assert abs(rows.where("split = 'val' and label = 1").count() - spam * 0.15) <= 1
    assert rows.where("split = 'test' and month_partition <> '2025-02'").count() == 0
    assert splits.leaked_ids(rows).count() == 0
    again = splits.split(split_frame(spark, n).repartition(7), "2025-02")
    assert again.exceptAll(rows).count() == 0


def test_leak_is_found(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "val")], "email_id string, split string")
    assert [tuple(r) for r in splits.leaked_ids(df).collect()] == [("a", ["test", "train"])]


TEXTS = ["free cash now", "free free team meeting", "team meeting now", "cash cash cash", ""]


def test_term_counts_match_a_counter(spark):
    df = add_terms(spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string"), "t")
    got = {(r["id"], r["term"]): r["tf"] for r in counted_terms(df, ["id"]).collect()}
    want = {}
    for i, text in enumerate(TEXTS):
        w = text.split()
        for term, n in Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]).items():
            want[(i, term)] = n
    assert got == want


def test_vocabulary_limits_and_order(spark):
    df = add_terms(spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string"), "t")
    rows = vocabulary(df, min_df=2, max_df=1.0, max_terms=4).orderBy("idx").collect()
    # Most used first (cash 4, free 3, meeting 2, now 2), then ties by term; numbered by term.
    assert [r["term"] for r in rows] == ["cash", "free", "meeting", "now"]
    assert rows[0]["df"] == 2 and rows[0]["total_tf"] == 4
    assert rows[0]["idf"] == pytest.approx(math.log(6 / 3) + 1)
    none = vocabulary(df, min_df=2, max_df=0.3)
    assert none.count() == 0


def test_weights_and_vectors_agree(spark):
    df = add_terms(spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string"), "t", (1, 1))
    model = TermModel.fit(df, min_df=1, max_df=1.0)
    long = {(r["id"], r["idx"]): r["weight"] for r in model.weights(df, ["id"]).collect()}
    wide = {
        (r["id"], int(i)): v
        for r in model.vectors(df).collect()
        for i, v in zip(r["tfidf"].indices, r["tfidf"].values)
    }
    assert long.keys() == wide.keys()
    assert all(long[k] == pytest.approx(wide[k], abs=1e-12) for k in long)
    # Second text: free twice, team, meeting.
    idf = dict(zip(model.terms, model.idf))
    raw = {"free": (1 + math.log(2)) * idf["free"], "team": idf["team"], "meeting": idf["meeting"]}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert long[(1, model.terms.index("free"))] == pytest.approx(raw["free"] / norm)
    assert sum(v * v for (i, _), v in long.items() if i == 0) == pytest.approx(1.0)


def test_unseen_terms_and_empty_texts_give_empty_vectors(spark):
    train = add_terms(spark.createDataFrame([(0, "alpha beta")], "id int, t string"), "t", (1, 1))
    model = TermModel.fit(train, min_df=1, max_df=1.0)
    new = add_terms(spark.createDataFrame([(0, "gamma"), (1, "")], "id int, t string"), "t", (1, 1))
    assert all(r["tfidf"].numNonzeros() == 0 and r["tfidf"].size == 2 for r in model.vectors(new).collect())


def test_vector_step_stays_in_the_jvm(spark):
    df = add_terms(spark.createDataFrame([(0, "alpha beta")], "id int, t string"), "t")
    text = TermModel.fit(df, min_df=1, max_df=1.0).vectors(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_scaler_with_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    model = ScalerModel.fit(df, ["a", "b"])
    assert model.mean == (2.0, 5.0) and model.scale == (1.0, 1.0)
    rows = df.select(*[z.alias(c) for c, z in model.scaled().items()]).collect()
    assert sorted(tuple(r) for r in rows) == [(-1.0, 0.0), (1.0, 0.0)]


def test_a_single_month_cannot_be_held_out(spark):
    df = spark.createDataFrame([("a", 0, "2025-01")], "email_id string, label int, month_partition string")
    with pytest.raises(ValueError, match="at least two"):
        splits.split(df, "2025-01")


def test_forest_input_is_dealt_by_its_dense_size(spark, monkeypatch):
    """The forest keeps rows dense: many wide rows make many partitions, few narrow ones stay as they lie."""
    from pyspark.ml.linalg import Vectors

    from lakemill.operators import training

    rows = spark.createDataFrame([(k % 2, Vectors.sparse(30_000, {k: 1.0})) for k in range(40)], ["label", "features"])
    train = rows.coalesce(1)
    assert training.spread(train, 30_000).rdd.getNumPartitions() == 1
    monkeypatch.setattr(training, "DENSE_BYTES", 1 << 20)
    dealt = training.spread(train, 30_000)
    assert dealt.rdd.getNumPartitions() == 5 and dealt.count() == 40


def test_grams_are_built_from_shorter_ones(spark):
    from lakemill.operators.terms import ngrams

    lists = [["a", "b", "c", "d"], ["a", "b"], ["a"], [], None]
    rows = spark.createDataFrame([(x,) for x in lists], "w array<string>").coalesce(1)
    out = rows.select(*[ngrams(F.col("w"), n, n).alias(f"g{n}") for n in (1, 2, 3)])
    assert [r["g2"] for r in out.collect()][:4] == [["a b", "b c", "c d"], ["a b"], [], []]
    assert [r["g3"] for r in out.collect()][:4] == [["a b c", "b c d"], [], [], []]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" in plan and "array_join" not in plan
