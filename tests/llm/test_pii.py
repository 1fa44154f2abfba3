import hashlib
import random
import re

from lakemill.llm import pii


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)


def brute(text):
    return [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def fuzz(n):
    rng = random.Random(8)
    bits = ["@", ".", "a", "b%", "1", "22", "255", "256", "+", "-", " ", "(", ")", "é", "\n", "4111111111111111", "4111-1111 1111 1111",
            "x@y.zz", "1.2.3.4", "+1 (456) 555-2186", "0", "..", "007.1.1.1", "😀", "a@b.c%d@e.f", "1.2.3.4.5.6.7.8"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(n)]


def test_base_spans_equal_the_patterns(spark, docs, texts):
    rows = fuzz(1500) + [(10_000 + i, t) for i, t in texts.items()]
    by = dict(rows)
    for r in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        want = brute(by[r.doc_id])
        assert r.base == joined(want), by[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k, _, _ in BASE]
        assert r.spans == r.base or r.spans.startswith(r.base + "," * bool(r.base))


def test_many_spans_and_long_runs(spark):
    text = "mail x@y.org, " * 3000
    long_runs = ["a" * 60_000, "1" * 60_000, "1.1" * 20_000, "+1" * 20_000, "1 " * 30_000, "a.b@" * 10_000]
    rows = [(0, text), *enumerate(long_runs, 1)]
    got = {r.doc_id: r for r in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i].base == joined(brute(t))


def test_the_method_adds_spans_that_the_labelers_back(spark):
    rows = [(i, f"Please call my phone ({200 + i % 700}) 555-{1000 + i}, thanks") for i in range(300)]
    rows += [(1000 + i, f"mail ada{i} [at] example [dot] org today") for i in range(200)]
    rows += [(2000 + i, f"order number 000-00-{1000 + i} of page {i}, total 12") for i in range(100)]
    rows += [(3000 + i, f"phone +1 (456) 555-{1000 + i} or mail bo{i}@mail.example.com") for i in range(200)]
    got = {r.doc_id: r.spans for r in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5].startswith("national_phone:21:35") and got[1005].startswith("spelled_email:5:")
    assert got[2005] == "" and got[3005].count(",") == 1


def test_estimation_tells_good_labelers_from_bad():
    rng, counts = random.Random(9), {}
    for _ in range(4000):
        real = rng.random() < 0.3
        vote = lambda right: int(real if rng.random() < right else not real)
        p = {"kind": "x", "v_check": vote(0.95), "v_listed": vote(0.9), "v_words": vote(0.9), "v_edges": vote(0.55), "v_variety": 2, "f_long": 0, "f_line": 0}
        counts.setdefault(tuple(p.items()), 0)
        counts[tuple(p.items())] += 1
    counted = [(dict(k), n) for k, n in counts.items()]
    theta, share, posterior = pii.estimate(counted)
    right = lambda v: (theta[v][0][0] + theta[v][1][1]) / 2
    assert right("v_check") > right("v_edges") + 0.2 and abs(share["x"] - 0.3) < 0.08
    weights, _ = pii.train(counted, posterior)
    assert weights["v_check", 1] > weights["v_check", 0]


def test_redaction_keeps_columns(spark, odd_docs, no_docs):
    docs = spark.createDataFrame(
        [(1, "to bo@mail.example.com now", 26, "x"), (2, "clean", 5, "y"), (3, None, 0, "z"), (4, "call +1 (456) 555-2186, 4111111111111111", 1, "w")],
        "doc_id long, text string, n_chars long, spans string",
    )
    got = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert got[1].text == "to <EMAIL> now" and got[1].n_chars == 14 and got[1].spans == "x"
    assert got[2].text == "clean" and got[3].text is None and got[4].text == "call <PHONE>, <CARD>"
    assert pii.redacted(odd_docs).columns == odd_docs.columns and pii.redacted(odd_docs).count() == odd_docs.count()
    assert pii.redacted(no_docs).count() == 0
    assert pii.spans(odd_docs).count() == odd_docs.count() and pii.spans(no_docs).count() == 0


def test_no_python_runs_on_the_executors(docs):
    plan = pii.spans(docs)._jdf.queryExecution().toString() + pii.redacted(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_chains_of_overlapping_added_spans(spark):
    """A overlaps B and B overlaps C: B goes, and C, which meets nothing that is kept, stays."""
    kind = "array<struct<kind: string, start: bigint, end: bigint, base: boolean, v_check: int>>"
    chain = [("national_phone", 0, 10, False, 1), ("national_phone", 8, 20, False, 1), ("national_phone", 18, 30, False, 1)]
    shaded = [("email", 40, 50, True, 1), ("national_phone", 45, 55, False, 1), ("national_phone", 54, 60, False, 1)]
    rows = spark.createDataFrame([(1, chain), (2, shaded), (3, []), (4, chain[1:])], f"id int, found {kind}")
    got = {r.id: [(s.start, s.end) for s in r.spans] for r in pii.kept(rows, pii.Model({}, {}, {}, 30.0)).collect()}
    assert got == {1: [(0, 10), (18, 30)], 2: [(40, 50), (54, 60)], 3: [], 4: [(8, 20)]}
