import hashlib
import random
import re
import zlib

import pytest

from lakemill.llm import queries, runs


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def brute(words, least, exponent):
    """Every stretch by its definition."""
    out = []
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - i
            if length >= max(least, exponent * q) and smallest_period(words[i : i + length]) == q:
                out.append((i, length, q))
            i = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng):
    words = []
    while len(words) < 60:
        unit = [rng.choice("ab") for _ in range(rng.randint(1, 7))]
        words += unit * rng.randint(1, 6) + [rng.choice("abcd") for _ in range(rng.randint(0, 4))]
    return words


@pytest.mark.parametrize(("least", "exponent"), [(24, 3), (6, 3), (4, 2), (3, 3), (10, 4)])
def test_runs_by_definition(least, exponent):
    rng = random.Random(least * 10 + exponent)
    for _ in range(40):
        texts = [made(rng) for _ in range(4)]
        texts += [["a"] * 40, [], ["b"], texts[0]]
        for words, (got, found) in zip(texts, runs.of_texts([" ".join(t).encode() for t in texts], least, exponent)):
            assert [w.decode() for w in got] == words
            assert found == brute(words, least, exponent)


def test_long_periods_and_long_texts():
    rng = random.Random(5)
    unit = [str(rng.randrange(50)) for _ in range(900)]
    words = ["x"] + unit * 4 + unit[:17] + ["y"] + ["word"] * 30_000
    (_, found), = runs.of_texts([" ".join(words).encode()], 24, 3)
    assert found == [(1, 3617, 900), (len(words) - 30_000, 30_000, 1)]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_against_brute_force(spark, docs):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: r for r in queries.op12_word_runs(spark, "/root/testdata/sf0.001").collect()}
    many = 0
    for r in docs.select("doc_id", "text").collect():
        words = planted(r.doc_id, r.text)
        found = brute(words, 24, 3) if len(words) < 1500 else None
        row = got.pop(r.doc_id)
        if found is None:
            continue
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        assert row.n_runs == len(found)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert row.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2])) if found else (None, None, None)
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
        many += bool(found)
    assert many > 5 and not got


def test_odd_documents(spark, odd_docs, no_docs):
    rows = runs.found(odd_docs)
    assert rows.columns == ["doc_id", "n_words", "runs", "best", "collapsed"] and rows.count() == odd_docs.count()
    got = {r.doc_id: r for r in rows.collect()}
    assert [(got[i].n_words, got[i].runs, got[i].best, got[i].collapsed) for i in (1, 2, 3)] == [(0, [], None, "")] * 3
    assert got[4].best.asDict() == {"start": 0, "length": 30_000, "period": 1} and got[4].collapsed == "word"
    assert runs.found(no_docs).count() == 0
    renamed = odd_docs.drop("text").withColumnRenamed("doc_id", "text").withColumnRenamed("source", "body")
    assert runs.found(renamed, key="text", text="body").columns[0] == "text"
    with pytest.raises(ValueError):
        runs.found(odd_docs, least=24, exponent=1)


def test_planted_texts(spark):
    rows = [(i, t) for i, t in enumerate(["a b c d e f g h"] * 60)] + [(100, None), (101, "  "), (None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = queries.with_runs(docs).collect()
    for r, (i, t) in zip(got, rows):
        assert (r.text or "").split() == (planted(i, t) if i is not None else t.split())
