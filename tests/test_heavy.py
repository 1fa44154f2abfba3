from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakemill.operators import heavy


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    # Some frequent words, ties among them, and a long tail of words that occur once.
    words = F.array(
        F.concat(F.lit("w"), (n % 7).cast("string")), F.when(n % 3 == 0, "third"), F.when(n % 2 == 0, "even"),
        F.concat(F.lit("tail"), n.cast("string")), F.when(n % 4 == 1, "tie-b"), F.when(n % 4 == 3, "tie-a"),
    )
    group = F.when(n % 5 == 0, "small").when(n % 11 == 0, F.lit(None)).otherwise("large")
    return spark.range(4000).repartition(6).select(group.alias("g"), words.alias("words")).cache()


def brute(rows, n):
    counts = {}
    for r in rows.collect():
        counts.setdefault(r["g"], Counter()).update(w for w in r["words"] if w is not None)
    out = []
    for g, c in counts.items():
        out += [(g, t, k, i + 1) for i, (t, k) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:n])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["grp"], r["token"], r["n_uses"], r["place"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("capacity", [heavy.CAPACITY, 40, 12, 1])
def test_exact_for_any_number_of_counters(rows, capacity):
    """With few counters the bound fails, and everything is counted."""
    for n in (3, 9):
        assert found(heavy.top(rows, F.col("words"), n, F.col("g"), capacity)) == brute(rows, n)


def test_counts_are_short_by_at_most_what_was_taken_off():
    counters, true = heavy.Counters(10), Counter()
    for k in range(200):
        values = [f"v{k % 3}", f"v{k % 5}", f"tail{k}"]
        counters.add(values, [1, 1, 1])
        true.update(values)
    assert len(counters.counts) <= 10 and counters.off > 0
    for value, n in true.items():
        assert n - counters.off <= counters.counts.get(value, 0) <= n


def test_candidates_too_many_to_broadcast_and_no_rows(rows, monkeypatch):
    monkeypatch.setattr(heavy, "BROADCAST", 2)
    assert found(heavy.top(rows, F.col("words"), 5, F.col("g"))) == brute(rows, 5)
    assert heavy.top(rows.limit(0), F.col("words"), 5).count() == 0
