"""Raw rows to bronze: column names, periods, ids, labels, arrival times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.fixed import BASE_MONTH, ROWS_PER_PERIOD, SEED
from lakemill.functions.messages import EDGE_SPACE
from lakemill.functions.numbers import seeded_int
from lakemill.operators.ranks import row_index

BRONZE_COLUMNS = ["email_id", "body", "label", "raw_label", "received_at", "month_partition"]


def normalize_columns(df: DataFrame, keep: list[str] = []) -> DataFrame:
    """Trim and lower-case the header; accept either known layout as (body, raw_label)."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    for body, label in (("text", "label"), ("message", "category")):
        if {body, label} <= set(df.columns):
            return df.select(F.col(body).alias("body"), F.col(label).alias("raw_label"), *keep)
    raise ValueError(f"Unknown columns: {df.columns}")


def month_label(offset: Column, base: str = BASE_MONTH) -> Column:
    """YYYY-MM of the base month plus `offset` months; an error past 9999-12, where labels would no
    longer sort. Choose more rows per period for a table that needs so many."""
    first = F.to_date(F.lit(f"{base}-01"))
    year, month = map(int, base.split("-"))
    label = F.date_format(F.add_months(first, offset.cast("int")), "yyyy-MM")
    last = (9999 - year) * 12 + 12 - month
    late = F.raise_error(F.concat(F.lit("period past 9999-12, raise rows_per_period: "), offset.cast("string")))
    return F.when(offset > last, late.cast("string")).otherwise(label)


def assign_periods(
    df: DataFrame, order: str, rows_per_period: int = ROWS_PER_PERIOD, base: str = BASE_MONTH
) -> DataFrame:
    """Add `month_partition` and the row's number within it.

    Rows are numbered by `order` and cut into equal chunks; a last chunk under half size joins
    the chunk before it. Pass the key columns only and join wide columns back afterwards, so
    that texts are not sorted for numbering.
    """
    numbered = row_index(df, order)
    full, rest = F.floor(F.col("n_total") / rows_per_period), F.col("n_total") % rows_per_period
    short_tail = (rest < rows_per_period // 2) & (full > 0)
    last = F.when((rest == 0) | short_tail, full - 1).otherwise(full)
    chunk = F.least(F.floor(F.col("idx") / rows_per_period), last)
    return (
        numbered.withColumn("chunk", chunk)
        .withColumn("month_partition", month_label(F.col("chunk"), base))
        .withColumn("row_in_month", F.col("idx") - F.col("chunk") * rows_per_period)
        .drop("n_total")
    )


def email_id(month: Column, row: Column) -> Column:
    return F.format_string("email_%s_%05d", F.replace(month, F.lit("-")), row)


def label_code(raw: Column) -> Column:
    """ham is 0, spam is 1, whatever white space is around them; anything else null."""
    word = F.lower(F.regexp_replace(raw, EDGE_SPACE, ""))
    return F.when(word == "ham", 0).when(word == "spam", 1)


def arrival_time(key: Column, month: Column, seed: int = SEED) -> Column:
    """Deterministic time in the first 28 days of the month, derived from the row's id."""
    year, number = (F.substring(month, a, n).cast("int") for a, n in ((1, 4), (6, 2)))
    day, hour, minute = (
        (seeded_int(key, seed, start) % size).cast("int") for start, size in ((1, 28), (9, 24), (17, 60))
    )
    return F.make_timestamp_ntz(year, number, day + 1, hour, minute, F.lit(0))


def bronze(
    mails: DataFrame,
    order: str = "doc_id",
    rows_per_period: int = ROWS_PER_PERIOD,
    base: str = BASE_MONTH,
    seed: int = SEED,
    keys: DataFrame | None = None,
) -> DataFrame:
    """(order, body, raw_label) to bronze rows.

    `keys` may give the order column from a narrower source than `mails` itself.
    """
    keys = mails.select(order) if keys is None else keys
    periods = assign_periods(keys, order, rows_per_period, base)
    keys = periods.select(
        order, "month_partition", email_id(F.col("month_partition"), F.col("row_in_month")).alias("email_id")
    )
    return (
        mails.join(keys, order)
        .withColumn("label", label_code(F.col("raw_label")))
        .withColumn("received_at", arrival_time(F.col("email_id"), F.col("month_partition"), seed))
        .select(*BRONZE_COLUMNS)
    )


def ingestion_log(rows: DataFrame, source: Column | None = None) -> DataFrame:
    """One log row per month of bronze rows."""
    log = rows.groupBy("month_partition").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("label") == 1).alias("spam_count"),
        F.count_if(F.col("label") == 0).alias("ham_count"),
        F.min("received_at").alias("min_received_at"),
        F.max("received_at").alias("max_received_at"),
    )
    name = F.format_string("emails_%s.csv", "month_partition") if source is None else source
    return log.withColumn("source_file", name)


def pending(incoming: DataFrame, existing_months: DataFrame) -> DataFrame:
    """Rows of months that are not in the target yet."""
    return incoming.join(existing_months.select("month_partition").distinct(), "month_partition", "left_anti")


def inject_marker(
    df: DataFrame, token: str, from_month: str, rate: float = 0.05, seed: int = SEED
) -> DataFrame:
    """Append `token` to a fixed share of spam bodies from a month on (a planted drift)."""
    picked = seeded_int(F.col("email_id"), seed, 25) < F.lit(int(rate * 2**32))
    hit = (F.col("label") == 1) & (F.col("month_partition") >= from_month) & picked
    return df.withColumn("body", F.when(hit, F.concat_ws(" ", "body", F.lit(token))).otherwise(F.col("body")))
