import re

from pyspark.sql import functions as F

from lakemill.llm import rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_measurements(spark, docs, texts):
    small = docs.where("n_chars < 2500")
    for r in rules.ledger(small).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])


def test_odd_documents(odd_docs, no_docs):
    rows = rules.ledger(odd_docs)
    assert rows.count() == odd_docs.count()
    got = {r.doc_id: r for r in rows.collect()}
    assert [got[i].n_words for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 30_000, 1]
    assert got[1].failed & 1 and got[4].failed & 2
    assert rules.ledger(no_docs).count() == 0


def test_policies_read_the_ledger_only(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 2 | 4), (4, 4), (5, 16)], "doc_id long, failed long")
    kept = {v: {r.doc_id for r in rows.where(rules.decided(rows, v)).collect()} for v in ("v1", "v2")}
    assert kept == {"v1": {1, 4, 5}, "v2": {1, 5}}
    by = {r.rule: (r.failed, r["only"], r.without) for r in rules.ablation(rows, "v2").collect()}
    assert by["few_words"] == (1, 1, 3) and by["symbols"] == (2, 1, 3) and by["repeated_windows"] == (1, 0, 2)
    assert "long_words" not in by
    assert all(r["only"] == 0 for r in rules.ablation(rows.where(F.lit(False))).collect())
