import random
import re

from lakemill.llm import jaccard
from lakemill.llm.graph import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    texts = sorted({t for _, t in rows if shingles(t)})
    sets = [shingles(t) for t in texts]
    n = len(texts)
    near = [[j for j in range(n) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in near[i]:
                label[i] = label[j] = min(label[i], label[j])
    at = {t: i for i, t in enumerate(texts)}
    low = {}
    for i, t in rows:
        if t in at:
            low[label[at[t]]] = min(low.get(label[at[t]], i), i)
    return {(i, low[label[at[t]]], len(near[at[t]])) if t in at else (i, i, 0) for i, t in rows}


def made(seed, groups, size):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(4, 120))]
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_classes_and_links_equal_brute_force(spark):
    rows = made(1, 25, 8) + [(1000, None), (1001, ""), (1002, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(df).collect()}
    assert got == brute(rows)


def test_large_groups_are_cut_into_blocks_without_losing_links(spark):
    rows = made(2, 6, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(df, hot=4, block=7).collect()}
    assert got == brute(rows)


def test_one_of_each_class_stays_with_its_columns(odd_docs, no_docs):
    left = jaccard.one_each(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [1, 2, 3, 4, 5, 6, 9, 10]
    assert jaccard.one_each(no_docs).count() == 0
    assert jaccard.classes(odd_docs).count() == odd_docs.count()


def test_banding_reaches_the_recall():
    bands, rows = jaccard.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99999 and bands * rows <= 160


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 200)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100} and 200 not in got
