import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from lakemill.llm import queries, suffix_dedup


def spans(n, gone):
    return sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone[:n]))


def brute(rows, length, keep):
    """{(key, text): (n_bytes, n_removed, n_spans, kept)}, from every string of `length` bytes."""
    places, order = defaultdict(list), sorted({(k, t or "") for k, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    listed = [(k, t or "") for k, t in rows] if keep == "none" else order
    for d, (_, text) in enumerate(listed):
        raw = text.encode()
        for i in range(len(raw) - length + 1):
            places[raw[i : i + length]].append((d, i))
    out = {}
    for d, (k, text) in enumerate(listed):
        raw = text.encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            at = places[raw[i : i + length]]
            if len(at) > 1 and (keep == "none" or at[0] != (d, i)):
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[k, text] = (len(raw), sum(gone), spans(len(raw), gone), kept)
    return out


def found(rows, length, keep, spark):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.removed(docs, length, keep).collect()
    return sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got)


def texts(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(4, 30))) for _ in range(6)]
    rows = []
    for i in range(30):
        made = "".join(rng.choice([*parts, *(rng.choice("abcé") for _ in range(8))]) for _ in range(rng.randint(0, 8)))
        rows.append((i, made))
    return [*rows, (40, rows[3][1]), (41, rows[3][1]), (42, "x" * 300), (43, None), (44, ""), (45, "xyz" * 90), (None, rows[5][1])]


@pytest.mark.parametrize("block", [512, 2])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_every_string_is_found(spark, monkeypatch, keep, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    for seed, length in ((1, 12), (2, 7)):
        rows = texts(seed)
        if keep == "first":
            # Which of two texts comes first is the key's matter; rows without a key come first.
            rows = [r for r in rows if r[0] not in (42, 45)]
        want = brute(rows, length, keep)
        expected = sorted((k or -1, *want[k, t or ""]) for k, t in rows)
        assert found(rows, length, keep, spark) == expected


def test_repeated_rows(spark):
    row = (7, "the same words in the same row")
    assert [r[2] for r in found([row, row], 10, "none", spark)] == [30, 30]
    assert [r[2] for r in found([row, row], 10, "first", spark)] == [0, 0]  # one document, listed twice
    assert [r[2] for r in found([row, (8, row[1])], 10, "first", spark)] == [0, 30]
    inner = (9, "abcdefghij-abcdefghij")
    assert found([inner], 10, "first", spark)[0][4] == b"abcdefghij-"


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(9000)) + "z" * 700
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.array([0, len(data)])
    whole = suffix_dedup._whole(data, at, 50)
    monkeypatch.setattr(suffix_dedup, "STEP", 700)
    pieces = suffix_dedup._whole(data, at, 50)
    assert all((a == b).all() for a, b in zip(whole, pieces))
    assert int(whole[2].sum()) == len(data) - 49


def test_factors_are_those_of_a_suffix_array():
    rng = random.Random(4)
    for length in (1, 3, 8, 21):
        bodies = ["".join(rng.choice("ab") for _ in range(rng.randint(length, 40))).encode() for _ in range(12)]
        body, offset, earlier, later, _ = suffix_dedup.factors(bodies, length)
        strings = [bodies[b][o : o + length] for b, o in zip(body, offset)]
        assert len(strings) == sum(len(b) - length + 1 for b in bodies)
        for i, s in enumerate(strings):
            assert earlier[i] == (s in strings[:i]) and later[i] == (s in strings[i + 1 :])


def test_odd_documents(spark, odd_docs, no_docs):
    rows = suffix_dedup.removed(odd_docs, 200, "none").collect()
    assert len(rows) == odd_docs.count()
    got = {r.doc_id: r for r in rows}
    assert (got[1].n_bytes, got[1].n_removed, got[2].n_bytes, bytes(got[2].kept)) == (0, 0, 0, b"")
    assert got[4].n_removed == got[4].n_bytes == 150_000 and got[5].n_removed == 70_000
    assert suffix_dedup.removed(no_docs).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.removed(odd_docs, keep="last")


def test_query_against_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, 200, "none")
    got = queries.op11_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        n, gone, runs, kept = want[r.doc_id, text[r.doc_id] or ""]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, runs, hashlib.sha256(kept).hexdigest())
    assert sum(r.n_removed for r in got) > 0
