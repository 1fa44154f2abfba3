import pytest
from pyspark.sql import functions as F

from lakemill.operators import drift, quality, sketches
from lakemill.session import durable


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    text = F.when(n % 50 == 0, F.lit(None)).otherwise(F.repeat(F.concat((n % 7000).cast("string"), F.lit("x")), (n % 13 + 1).cast("int")))
    return durable(spark.range(20_000).select(
        text.alias("txt"), F.format_string("2025-%02d", n % 5 + 1).alias("month_partition"),
        (F.randn(3) + F.when(n % 5 == 4, 0.5).otherwise(0.0)).alias("score"),
    ), "rows")


@pytest.fixture(scope="module")
def stored(rows):
    return durable(sketches.month_sketches(rows, "txt", ["score"]), "stored")


def test_any_range_without_texts(rows, stored):
    for start, end in (("2025-01", "2025-05"), ("2025-02", "2025-03"), ("2025-04", "2025-04")):
        held = sketches.in_range(rows, start, end)
        got = sketches.range_report(stored, start, end).first()
        s = F.coalesce("txt", F.lit("None"))
        want = held.agg(
            F.count("*").alias("n"), F.avg(F.length(s)).alias("mean"), F.stddev_samp(F.length(s)).alias("std"),
            F.min(F.length(s)).alias("low"), F.max(F.length(s)).alias("high"), F.count_if(F.col("txt").isNull()).alias("null"),
        ).first()
        assert (got["n_rows"], got["n_null"], got["min_length"], got["max_length"]) == (want["n"], want["null"], want["low"], want["high"])
        assert got["mean_length"] == pytest.approx(want["mean"], abs=0.006) and got["std_length"] == pytest.approx(want["std"])
        exact = quality.uniqueness(held, "txt").first()
        assert abs(got["n_unique"] - exact["n_unique"]) <= sketches.UNIQUE_ERROR * exact["n_unique"]
        lengths = sorted(r[0] for r in held.select(F.length(s)).collect())
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            below, upto = (sum(v < got[q] for v in lengths) / len(lengths), sum(v <= got[q] for v in lengths) / len(lengths))
            assert below - sketches.RANK_ERROR <= p <= upto + sketches.RANK_ERROR
    plan = sketches.range_report(stored, "2025-01", "2025-02")._jdf.queryExecution().toString()
    assert "txt" not in plan


def test_psi_of_ranges(rows, stored):
    exact = drift.psi(drift.window_counts(rows.withColumn("is_ref", F.col("month_partition") < "2025-05"), "score")).first()["psi"]
    got = sketches.range_psi(stored, "score", ("2025-01", "2025-04"), ("2025-05", "2025-05")).first()["psi"]
    assert exact > 0.1 and got == pytest.approx(exact, abs=0.04)
    same = sketches.range_psi(stored, "score", ("2025-01", "2025-02"), ("2025-03", "2025-04")).first()["psi"]
    assert same < 0.02


def test_no_months(stored):
    assert sketches.range_report(stored, "2030-01", "2030-02").count() == 0
