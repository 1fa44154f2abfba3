"""Queries of training, the monthly loop, batch scoring and the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.fixed import BASELINE_FEATURES, NUMERIC_FEATURES
from lakemill.operators import evaluation, ingest, silver, training
from lakemill.operators.messages import prepared
from lakemill.operators.training import Preparation, SpamModel, train_one
from lakemill.plans import lake as jobs
from lakemill.plans.catalog import query
from lakemill.plans.frames import bronze_rows, rows_of_period, silver_rows, split_rows
from lakemill.plans.message_queries import inbox
from lakemill.plans.twins import part, twin
from lakemill.session import durable, new_path
from lakemill.sources import files
from lakemill.sources.commits import Generations
from lakemill.sources.tables import mails, table
from lakemill.streaming import feed
from lakemill.streaming.mailbox import deliver, mailbox_feed, trim


def text_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All silver rows, with what a model reads of them, written once."""
    return split_rows(spark, folder, "body_clean", *NUMERIC_FEATURES)


def gold_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, Preparation]:
    return gold_of(text_rows(spark, folder))


def gold_of(rows: DataFrame) -> tuple[DataFrame, Preparation]:
    train = rows.where(F.col("split") == "train")
    preparation = Preparation.fit(train)
    gold = durable(
        preparation.transform(rows).select("email_id", "label", "split", "tfidf", "features"), "gold", "split"
    )
    return gold, preparation


def _register_training() -> None:
    for name in training.MODEL_CLASSES:
        def run(spark: SparkSession, folder: str, name=name) -> DataFrame:
            """Candidate row: threshold on val, metrics on val and test."""
            gold, _ = gold_rows(spark, folder)
            return spark.createDataFrame([train_one(name, gold).row("latest")])

        query(name=f"train_{name}")(run)


_register_training()


@query()
def train_svm(spark: SparkSession, folder: str) -> DataFrame:
    gold, _ = gold_rows(spark, folder)
    model = training.calibrated_svm(gold.where(F.col("split") == "train"), "email_id")
    rows = training.scored(model, gold.where(F.col("split") != "train")).select("split", F.col("label").alias("y"), "p")
    return evaluation.evaluate(durable(rows, "scores"), F.lit(0.5), ["split"])


@query()
def cv_f1(spark: SparkSession, folder: str) -> DataFrame:
    return training.cross_validated_f1(
        durable(silver_rows(spark, folder).select("email_id", "label", *BASELINE_FEATURES), "baseline")
    )


def spam_model(rows: DataFrame) -> SpamModel:
    gold, preparation = gold_of(rows)
    best = train_one("lr", gold)
    return SpamModel("lr", preparation, best.classifier, best.threshold)


@query()
def evaluate_saved(spark: SparkSession, folder: str) -> DataFrame:
    """A saved and reloaded model, measured on the latest silver months."""
    path = new_path(spark, "model")
    rows = text_rows(spark, folder)
    spam_model(rows).save(spark, path)
    model = SpamModel.load(spark, path)
    start = files.months(rows)[-1]
    return training.evaluate_months(model, rows, start)


@query()
def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    return feed.scored_log(inbox(spark, folder), spam_model(text_rows(spark, folder)))


@query()
def shadow_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Champion and challenger side by side on every message."""
    return _shadow(spark, folder, *shadow_pair(spark, folder))


def shadow_pair(spark: SparkSession, folder: str) -> tuple[SpamModel, SpamModel]:
    """(champion, challenger), each trained once on the same gold rows."""
    gold, preparation = gold_rows(spark, folder)
    found = [train_one(n, gold) for n in ("lr", "nb")]
    return tuple(SpamModel(c.name, preparation, c.classifier, c.threshold) for c in found)


def _shadow(spark: SparkSession, folder: str, first: SpamModel, second: SpamModel) -> DataFrame:
    rows = first.preparation.transform(prepared(inbox(spark, folder)))
    champion = training.scored(first.classifier, rows).withColumnRenamed("p", "champion_p")
    both = training.scored(second.classifier, champion).withColumnRenamed("p", "challenger_p")
    return both.select("message_id", "champion_p", "challenger_p")


@query()
def monthly_loop(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze, silver, first champion, then one monthly run with an open gate and all candidates."""
    return _monthly_loop(spark, folder, jobs.Lake(new_path(spark, "lake")))


def _monthly_loop(spark: SparkSession, folder: str, lake: jobs.Lake) -> DataFrame:
    jobs.to_bronze(mails(spark, folder), lake, "doc_id", rows_of_period(spark, folder))
    jobs.to_silver(spark, lake)
    known = files.months(files.read_table(spark, lake.path("silver")))
    jobs.first_load(spark, lake, known[-1])
    return jobs.monthly_run(spark, lake, known[-1], known[0], known[-2], gate=0.0)


@query(twin(["split_rows"], """
SELECT split, count(*) AS n_rows, count(*) FILTER (label = 1) AS n_spam, count(*) FILTER (split <> 'test') AS n_pinned, 2::BIGINT AS n_builds
FROM split_rows GROUP BY split"""))
def gold_generations(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot built twice, while a third build dies before its switch: what readers get now, and what
    a reader still gets that holds the first generation."""
    rows = durable(split_rows(spark, folder, *NUMERIC_FEATURES), "split-rows")
    store = Generations(new_path(spark, "gold-generations"))
    for part_ in (rows.where("split <> 'test'"), rows):
        path = store.staged()
        part_.write.partitionBy("split").parquet(path)
        store.publish(spark, path, {"n_rows": part_.count()})
    rows.where("split = 'val'").write.parquet(store.staged())
    first = store.log.entries(spark)[0]
    pinned = store.read(spark, first).groupBy("split").agg(F.count(F.lit(1)).alias("n_pinned"))
    now = store.read(spark).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("label") == 1).alias("n_spam"))
    return now.join(pinned, "split", "left").fillna(0, ["n_pinned"]).withColumn(
        "n_builds", F.lit(len(store.log.entries(spark))).cast("long")
    )


@query(twin(["split_rows"], """
SELECT version, name, (SELECT count(*) FROM split_rows WHERE split = 'test') AS n_scored, true AS probabilities_hold
FROM (SELECT unnest([1, 2, 3]) AS version, unnest(['nb', 'lr', 'nb']) AS name)"""))
def registry_race(spark: SparkSession, folder: str) -> DataFrame:
    """Two promotions that interleave: both read version 1, the slower one reads again and becomes version
    3. Every version has a model of its own, which scores the test rows."""
    gold, preparation = gold_rows(spark, folder)
    lake = jobs.Lake(new_path(spark, "lake"))
    models = {}
    for name in ("nb", "lr"):
        best = train_one(name, gold)
        models[name] = SpamModel(name, preparation, best.classifier, best.threshold)
    jobs.register(spark, lake, "first", models["nb"])
    log, slow = jobs.decision_log(lake), jobs.saved_model(spark, lake, "slow", models["nb"])
    raced: list[int] = []

    def entry(known: list[dict]) -> dict:
        if not raced:
            raced.append(jobs.register(spark, lake, "fast", models["lr"]))
        return slow | {"version": jobs.next_in(known)}

    log.commit(spark, entry)
    test = gold.where("split = 'test'")
    out = None
    for row in jobs.registry(spark, lake).collect():
        model = SpamModel.load(spark, row["path"])
        rows = training.scored(model.classifier, test).agg(
            F.count(F.lit(1)).alias("n_scored"), F.bool_and(F.col("p").between(0, 1)).alias("probabilities_hold")
        )
        rows = rows.select(F.lit(row["version"]).alias("version"), F.lit(row["name"]).alias("name"), "n_scored", "probabilities_hold")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(twin(["bronze"], "SELECT month_partition, body, raw_label FROM bronze"))
def raw_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly raw CSV files of two header layouts written and read back row by row."""
    path = new_path(spark, "csv")
    rows = durable(bronze_rows(spark, folder).select("body", "raw_label", "month_partition"), "raw")
    even = F.substring("month_partition", 6, 2).cast("int") % 2 == 0
    files.write_csv(
        rows.where(even).select(F.col("body").alias(" Text "), F.col("raw_label").alias("LABEL"), "month_partition"),
        path, "month_partition",
    )
    files.write_csv(
        rows.where(~even).select(F.col("raw_label").alias("Category"), F.col("body").alias("MESSAGE "), "month_partition"),
        path, "month_partition", mode="append",
    )
    return files.read_monthly_csv(spark, path)


@query(twin(["silver"], "SELECT month_partition, count(*) AS n_rows, sum(char_count)::BIGINT AS n_chars FROM silver GROUP BY month_partition"))
def silver_store(spark: SparkSession, folder: str) -> DataFrame:
    """Silver with its storage types, written by month twice: the second run adds nothing."""
    path = new_path(spark, "silver-store")
    rows = silver.stored(silver_rows(spark, folder))
    files.append_new_months(rows, path)
    files.append_new_months(rows, path)
    stored = files.read_table(spark, path)
    return stored.groupBy("month_partition").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("char_count").alias("n_chars")
    )


PORTIONS = 3


def _replayed(spark: SparkSession, folder: str, start) -> None:
    """Let the events arrive in time order, in several portions; the stream stops after each one and
    goes on from its checkpoint. `start` gets the feed and starts the query."""
    events = table(spark, folder, "events")
    arrived = new_path(spark, "arrived")
    at = F.col("ts").cast("timestamp").cast("double")
    first, last = events.agg(F.min(at), F.max(at)).first()
    portion = F.least(F.floor((at - F.lit(first)) / F.lit(max(1.0, last - first)) * PORTIONS), F.lit(PORTIONS - 1))
    for k in range(PORTIONS):
        # Empty portions arrive as well: an empty file.
        events.where(portion == k).write.mode("append").parquet(arrived)
        start(feed.file_feed(spark, arrived, events.schema)).awaitTermination()


EVENT_LOG = "CASE WHEN event_type = 'error' THEN 'spam' ELSE 'not_spam' END"


@query(f"""
SELECT ts::DATE AS day, count(*) AS n_total, count(*) FILTER ({EVENT_LOG} = 'spam') AS n_spam,
  count(*) FILTER ({EVENT_LOG} <> 'spam') AS n_ham FROM events GROUP BY day""")
def stream_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tumbling-day counts of the event feed, kept current by updates."""
    out = new_path(spark, "daily")
    verdicts = F.when(F.col("event_type") == "error", "spam").otherwise("not_spam")

    def start(rows: DataFrame):
        log = rows.select(F.col("ts").cast("timestamp").alias("timestamp"), verdicts.alias("prediction"))
        return feed.updates_to(feed.daily_counts(log), f"{out}/rows", f"{out}/checkpoint", once=True)

    _replayed(spark, folder, start)
    feed.compact_updates(spark, f"{out}/rows", "day")
    return feed.latest_updates(spark, f"{out}/rows", "day")


@query("SELECT event_type || '-' || user_id AS message_id FROM events GROUP BY message_id")
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Message ids of the event feed after de-duplication within a watermark longer than the feed."""
    out = new_path(spark, "dedupe")

    def start(rows: DataFrame):
        ids = rows.select(
            F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("message_id"),
            F.col("ts").cast("timestamp").alias("ts"),
        )
        unique = feed.deduplicated(ids, late="60 days").select("message_id")
        return feed.append_to(unique, f"{out}/rows", f"{out}/checkpoint", once=True)

    _replayed(spark, folder, start)
    return spark.read.schema("message_id string").parquet(f"{out}/rows")


part("late_events", [], """
SELECT event_id, event_type, ts FROM events WHERE ts > TIMESTAMP '2024-01-20'""")


@query(twin(["late_events"], "SELECT event_id, event_type FROM late_events"))
def stream_since(spark: SparkSession, folder: str) -> DataFrame:
    """The feed from its start time on: earlier messages are not backfilled."""
    out = new_path(spark, "since")

    def start(rows: DataFrame):
        later = feed.since(rows, "2024-01-20").select("event_id", "event_type")
        return feed.append_to(later, f"{out}/rows", f"{out}/checkpoint", once=True)

    _replayed(spark, folder, start)
    return spark.read.schema("event_id long, event_type string").parquet(f"{out}/rows")


@query("""
SELECT event_id AS history_id, event_type FROM events
WHERE event_id > (SELECT min(event_id) + (max(event_id) - min(event_id)) // 3 FROM events)""")
def stream_mailbox(spark: SparkSession, folder: str) -> DataFrame:
    """The events as mail that arrives in three deliveries: the first before the stream's first start, the
    last when the stream's cursor has expired. Everything after the first start comes out once."""
    out = new_path(spark, "mailbox")
    mail = table(spark, folder, "events").select(
        F.concat(F.lit("m"), "event_id").alias("message_id"), F.col("event_id").cast("long").alias("history_id"), "event_type"
    )
    low, high = mail.agg(F.min("history_id"), F.max("history_id")).first()
    cuts = [low - 1, *(low + (high - low) * k // 3 for k in (1, 2)), high]
    for k, (above, upto) in enumerate(zip(cuts, cuts[1:])):
        deliver(mail.where((F.col("history_id") > above) & (F.col("history_id") <= upto)), f"{out}/box")
        if k == 2:
            trim(f"{out}/box", upto - (upto - above) // 2)
        rows = mailbox_feed(spark, f"{out}/box", mail.schema)
        stream = rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").start(f"{out}/rows")
        try:
            stream.processAllAvailable()
        finally:
            stream.stop()
    return spark.read.schema(mail.schema).parquet(f"{out}/rows").select("history_id", "event_type")


@query()
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """The mailbox, and messages without a time beside it, scored as a stream in three runs; every
    batch asks the registry for the current model, which is replaced after the first run."""
    out = new_path(spark, "scored")
    lake = jobs.Lake(new_path(spark, "lake"))
    arrived = f"{out}/arrived"
    rows = inbox(spark, folder)
    timeless = rows.where(F.col("message_id").endswith("-0")).select(
        F.concat("message_id", F.lit("-untimed")).alias("message_id"), "subject", "body", "snippet",
        F.lit(None).cast("timestamp_ntz").alias("ts"), "p",
    )
    rows = rows.unionByName(timeless)
    gold, preparation = gold_rows(spark, folder)
    for k, name in enumerate(("lr", "nb", None)):
        if name:
            best = train_one(name, gold)
            jobs.register(spark, lake, f"run-{k}", SpamModel(name, preparation, best.classifier, best.threshold))
        rows.where(F.pmod(F.xxhash64("message_id"), F.lit(3)) == k).write.mode("append").parquet(arrived)
        feed.refreshed_log(
            feed.file_feed(spark, arrived, rows.schema), lambda s: jobs.current_model(s, lake), f"{out}/rows",
            f"{out}/checkpoint", once=True,
        ).awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("batch")


@query(twin(["kept_inputs"], """
SELECT count(*) + count(*) FILTER (ends_with(message_id, '-0')) AS n_rows, count(*) FILTER (ends_with(message_id, '-0')) AS n_errors,
  count(DISTINCT message_id) + count(*) FILTER (ends_with(message_id, '-0')) AS n_ids, true AS probabilities_hold FROM kept_inputs"""))
def stream_score_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of the scored stream whatever the model: every usable message once, errors where planted."""
    p = F.col("spam_probability").cast("double")
    return stream_score(spark, folder).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("applied_label") == "ERROR").alias("n_errors"),
        F.countDistinct("message_id").alias("n_ids"), F.bool_and(p.between(0, 1)).alias("probabilities_hold"),
    )


@query(twin(["kept_inputs"], """
SELECT message_id, CASE WHEN split_part(message_id, '-', 1)::BIGINT % 3 = 0 THEN 1 ELSE 2 END::INTEGER AS model_version FROM kept_inputs"""))
def stream_model_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Which model scored which message: conversations arrive in three portions, and the model is replaced
    after the first."""
    out = new_path(spark, "versions")
    lake = jobs.Lake(new_path(spark, "lake"))
    rows = inbox(spark, folder)
    portion = F.split_part("message_id", F.lit("-"), F.lit(1)).cast("long") % 3
    gold, preparation = gold_rows(spark, folder)
    for k, name in enumerate(("lr", "nb", None)):
        if name:
            best = train_one(name, gold)
            jobs.register(spark, lake, f"run-{k}", SpamModel(name, preparation, best.classifier, best.threshold))
        rows.where(portion == k).write.mode("append").parquet(f"{out}/arrived")
        feed.refreshed_log(
            feed.file_feed(spark, f"{out}/arrived", rows.schema), lambda s: jobs.current_model(s, lake), f"{out}/rows", f"{out}/checkpoint", once=True,
        ).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("message_id", "model_version")


@query(twin(["silver"], """
SELECT count(*) AS n_rows, count(*) FILTER (label = 1) AS n_spam, true AS same_as_unsaved, true AS same_scores FROM silver
WHERE month_partition = (SELECT max(month_partition) FROM silver)"""))
def saved_model_checks(spark: SparkSession, folder: str) -> DataFrame:
    """A saved and reloaded model of every kind gives the metrics and scores of the one that was saved, on
    all rows of the latest silver month."""
    rows = text_rows(spark, folder)
    gold, preparation = gold_of(rows)
    start = files.months(rows)[-1]
    same_metrics = same_scores = True
    for name in training.MODEL_CLASSES:
        best = train_one(name, gold)
        model = SpamModel(best.name, preparation, best.classifier, best.threshold)
        path = new_path(spark, "model")
        model.save(spark, path)
        again = SpamModel.load(spark, path)
        metrics = [training.evaluate_months(m, rows, start).first().asDict() for m in (model, again)]
        last = rows.where(F.col("month_partition") >= start)
        a, b = (m.score(last).select("email_id", F.col("p").alias(n)) for m, n in ((model, "a"), (again, "b")))
        same_metrics = same_metrics and metrics[0] == metrics[1]
        same_scores = same_scores and a.join(b, "email_id").where(F.abs(F.col("a") - F.col("b")) > 1e-12).isEmpty()
    m = metrics[1]
    counts = (m["tp"] + m["fp"] + m["fn"] + m["tn"], m["tp"] + m["fn"], same_metrics, same_scores)
    return spark.createDataFrame([counts], "n_rows long, n_spam long, same_as_unsaved boolean, same_scores boolean")


@query(twin(["kept_inputs"], """
SELECT count(*) AS n_rows, count(DISTINCT message_id) AS n_messages, true AS probabilities_hold, true AS champion_holds FROM kept_inputs"""))
def shadow_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of the shadow scores whatever the models: every usable message once, probabilities, and
    the champion's scores those of the batch log."""
    # One champion for both sides: a second fit stops elsewhere within its tolerance, as sums of doubles vary.
    champion, challenger = shadow_pair(spark, folder)
    rows = durable(_shadow(spark, folder, champion, challenger), "shadow")
    log = durable(feed.scored_log(inbox(spark, folder), champion), "log").select("message_id", F.col("spam_probability").cast("double").alias("logged"))
    both = rows.join(log, "message_id", "left")
    usable = F.col("logged") != 0  # a message without tokens is logged as 0
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("message_id").alias("n_messages"),
        F.bool_and(F.col("champion_p").between(0, 1) & F.col("challenger_p").between(0, 1)).alias("probabilities_hold"),
        F.bool_and(F.coalesce(~usable | (F.abs(F.col("logged") - F.col("champion_p")) < 1e-5), F.lit(False))).alias("champion_holds"),
    )


SPLIT_COUNTS = """
SELECT name, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val,
  count(*) FILTER (split = 'test') AS n_test, count(*) FILTER (split = 'test' AND label = 1) AS test_spam, true AS rates_hold
FROM split_rows, (SELECT unnest([{names}]) AS name) GROUP BY name"""


@query(twin(["split_rows"], SPLIT_COUNTS.format(names="'lr', 'nb', 'rf', 'hgb'")))
def candidate_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of every trained candidate whatever its weights: split sizes, the spam of the
    confusion counts, rates between 0 and 1, and a threshold at which the label follows the score."""
    gold, _ = gold_rows(spark, folder)
    sizes = gold.groupBy("split").count().collect()
    n = {r["split"]: r["count"] for r in sizes}
    rows = []
    for name in training.MODEL_CLASSES:
        best = train_one(name, gold)
        threshold = best.threshold
        scored = training.scored(best.classifier, gold.where(F.col("split") == "test"))
        scored = durable(scored.select(F.col("label").alias("y"), "p"), "scored")
        m = evaluation.evaluate(scored, F.lit(float(threshold))).first().asDict()
        held = all(0 <= m[k] <= 1 for k in ("precision", "recall", "f1", "accuracy", "average_precision"))
        held = held and 0 <= threshold <= 1 and scored.where(~F.col("p").between(0, 1)).isEmpty()
        rows.append((name, n["train"], n["val"], n["test"], m["tp"] + m["fn"], held))
    return spark.createDataFrame(rows, "name string, n_train long, n_val long, n_test long, test_spam long, rates_hold boolean")


@query(twin(["weights", "split_rows"], f"""
SELECT s.email_id, s.split, count(w.idx) AS n_terms, round(coalesce(sqrt(sum(w.weight * w.weight)), 0), 6) AS norm, {", ".join(
    f"any_value(round(({c} - (SELECT avg({c}) FROM split_rows WHERE split = 'train'))"
    f" / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}) END FROM split_rows WHERE split = 'train'), 6)) AS {c}"
    for c in NUMERIC_FEATURES)}
FROM split_rows s LEFT JOIN weights w USING (email_id) GROUP BY s.email_id, s.split"""))
def gold_vector_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The gold vectors taken apart: number and norm of the term weights, and the scaled tail."""
    gold, preparation = gold_rows(spark, folder)
    width = len(preparation.terms.terms)
    v = F.unwrap_udt("features")
    # Vectors are stored dense or sparse; both are read by place.
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    cells = F.arrays_zip(places.alias("i"), v["values"].alias("w"))
    terms = F.filter(cells, lambda c: (c["i"] < width) & (c["w"] != 0))

    def tail(k: int) -> F.Column:
        own = F.filter("_cells", lambda c: c["i"] == width + k)
        return F.round(F.coalesce(F.try_element_at(own, F.lit(1))["w"], F.lit(0.0)), 6)

    rows = gold.select("email_id", "split", terms.alias("_terms"), cells.alias("_cells"))
    norm = F.sqrt(F.aggregate("_terms", F.lit(0.0), lambda a, c: a + c["w"] * c["w"]))
    return rows.select(
        "email_id", "split", F.size("_terms").cast("long").alias("n_terms"), F.round(norm, 6).alias("norm"),
        *[tail(k).alias(c) for k, c in enumerate(NUMERIC_FEATURES)],
    )


@query(twin(["silver"], """
SELECT max(month_partition) AS month, false AS skipped, (SELECT count(DISTINCT month_partition) FROM silver) AS n_months,
  8::BIGINT AS n_candidates, 2::BIGINT AS n_decisions, true AS registry_holds FROM silver"""))
def monthly_loop_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of the monthly loop whatever the models: candidates stored, decisions recorded, and a
    registry whose versions count up from one, the last one the champion's."""
    lake = jobs.Lake(new_path(spark, "lake"))
    decision = _monthly_loop(spark, folder, lake)
    versions = [r["version"] for r in jobs.registry(spark, lake).orderBy("version").collect()]
    decisions = jobs.decisions(spark, lake)
    promoted = decisions.where("promoted").count()
    following = evaluation.next_version(jobs.registry(spark, lake)).first()["version"]
    held = versions == list(range(1, promoted + 1)) and following == promoted + 1 and jobs.champion(spark, lake) is not None
    known = files.months(files.read_table(spark, lake.path("silver")))
    return decision.select(
        "month", F.contains("reason", F.lit("skipped")).alias("skipped"), F.lit(len(known)).cast("long").alias("n_months"),
        F.lit(spark.read.parquet(lake.path("candidates")).count()).cast("long").alias("n_candidates"),
        F.lit(decisions.count()).cast("long").alias("n_decisions"), F.lit(held).alias("registry_holds"),
    )


@query(twin(["silver"], """
SELECT count(*) AS n_rows, count(*) FILTER (label = 1 AND month_partition >= (SELECT max(month_partition) FROM silver)) AS n_spam,
  true AS marked_only_spam, 0::BIGINT AS n_broken FROM silver"""))
def marker_and_contract(spark: SparkSession, folder: str) -> DataFrame:
    """A marker put into all spam from the last month on, as a planted drift, and the silver contract."""
    rows = durable(silver.stored(silver_rows(spark, folder)).select(*jobs.CONTRACT), "silver")
    last = files.months(rows)[-1]
    marked = ingest.inject_marker(rows.withColumn("body", F.col("body_clean")), "plantedtoken", last, rate=1.0)
    hit = F.contains("body", F.lit("plantedtoken"))
    return marked.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_spam"),
        F.bool_and(~hit | ((F.col("label") == 1) & (F.col("month_partition") >= last))).alias("marked_only_spam"),
        F.lit(len(files.check_contract(rows, jobs.CONTRACT))).cast("long").alias("n_broken"),
    )
