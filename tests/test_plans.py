"""Shapes of physical plans that results do not show."""


from lakemill.operators import evaluation, profiling, silver, terms


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bronze(spark):
    return spark.createDataFrame(
        [("e", "some text", 0, "2025-01", None)],
        "email_id string, body string, label int, month_partition string, received_at timestamp_ntz",
    )


def test_text_is_cleaned_once(spark):
    text = plan(silver.silver(bronze(spark)))
    # The gate on the cleaned length stays above the cleaning step.
    assert text.count("regexp_extract_all(CASE WHEN") <= 1


def test_top_n_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("a b c", "x")], "t string, g string")
    assert "WindowGroupLimit" in plan(profiling.top_tokens(df, "t", "g", 2))


def test_curve_has_no_single_partition_sort(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.2)], "y int, p double")
    text = plan(evaluation.score_points(df))
    windows = [line for line in text.splitlines() if "Window [" in line]
    # Rows are windowed per range; the windows over ranges see one row per range.
    assert any("_range" in line.split("],")[1] for line in windows)


def test_vocabulary_shuffles_terms_and_not_documents(spark):
    df = terms.add_terms(spark.createDataFrame([(0, "a1 b2 c3")], "id int, t string"), "t")
    text = plan(terms.vocabulary(df, min_df=1, max_df=1.0))
    assert "partial_count" in text and "hashpartitioning(id" not in text


def test_no_python_workers_in_operators(spark):
    rows = bronze(spark)
    for df in (silver.gate_counts(rows), silver.drop_reasons(rows), profiling.describe_length(rows, "body")):
        assert "Python" not in plan(df) and "ArrowEval" not in plan(df)


def test_shadow_checks_train_each_model_once(spark, monkeypatch):
    """The batch log and the shadow scores are those of one champion: two fits differ beyond the bound."""
    from lakemill.plans import all_queries, model_queries

    trained = []
    train = model_queries.train_one
    monkeypatch.setattr(model_queries, "train_one", lambda name, gold, **sizes: trained.append(name) or train(name, gold, **sizes))
    row = all_queries.QUERIES["shadow_checks"](spark, "/root/testdata/sf0.001").first()
    assert row["champion_holds"] and row["probabilities_hold"]
    assert sorted(trained) == ["lr", "nb"]


def test_a_saved_model_is_evaluated_on_the_silver_it_was_trained_on(spark, monkeypatch):
    """Texts are cleaned once for a model and its evaluation."""
    from lakemill.operators import silver
    from lakemill.plans.all_queries import QUERIES

    made, silver_of = [], silver.silver
    monkeypatch.setattr(silver, "silver", lambda *args, **kwargs: made.append(1) or silver_of(*args, **kwargs))
    row = QUERIES["evaluate_saved"](spark, "/root/testdata/sf0.001").first()
    assert made == [1] and row["tp"] + row["fp"] + row["fn"] + row["tn"] > 0
