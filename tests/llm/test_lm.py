import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemill.llm import lm
from lakemill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


class Walk:
    """The automaton as dictionaries, traversed token by token."""

    def __init__(self, texts, order, least=2, d=0.5):
        self.order, self.d, self.counts = order, d, Counter()
        for t in texts:
            seq = ["\0", *tokens(t)]
            for size in range(1, order + 1):
                for i in range(1, len(seq)):
                    if i - size + 1 >= 0:
                        self.counts[tuple(seq[i - size + 1 : i + 1])] += 1
        self.n = sum(c for g, c in self.counts.items() if len(g) == 1)
        self.v = sum(len(g) == 1 for g in self.counts)
        self.counts = Counter({g: c for g, c in self.counts.items() if len(g) == 1 or c >= least})
        self.counts["\0",] = len(texts)
        self.left = {}
        for g, c in self.counts.items():
            if len(g) > 1:
                self.left[g[:-1]] = self.left.get(g[:-1], 0) + c - d

    def p(self, context, word):
        if not context:
            return (self.counts[word,] * (word != "\0") + 0.1) / (self.n + 0.1 * (self.v + 1))
        shorter = self.p(context[1:], word)
        total = self.counts.get(context, 0)
        if not total:
            return shorter
        return max(self.counts.get((*context, word), 0) - self.d, 0) / total + (1 - self.left.get(context, 0) / total) * shorter

    def score(self, text):
        seq, out = ["\0", *tokens(text)], 0.0
        for i in range(1, len(seq)):
            out += math.log10(self.p(tuple(seq[max(0, i - self.order + 1) : i]), seq[i]))
        return out


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_a_token_by_token_traversal(spark, docs, texts, order):
    train = {i: t for i, t in texts.items() if i % 10}
    model = lm.fit(docs.where("doc_id % 10 <> 0"), order=order)
    walk = Walk(list(train.values()), order)
    assert (model.total, model.distinct) == (walk.n, walk.v)
    for r in lm.scored(docs, model, "doc_id").collect():
        seq = tokens(texts[r.doc_id])
        base = sum(math.log10((walk.counts[w,] + 0.1) / (walk.n + 0.1 * (walk.v + 1))) for w in seq)
        assert (r.n_tokens, r.n_known) == (len(seq), sum(walk.counts[w,] > 0 for w in seq))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(walk.score(texts[r.doc_id]), rel=1e-5)


def test_probabilities_after_a_context_sum_to_one():
    walk = Walk(["a b a b c", "a c", "b b"], 2, least=1)
    for context in ("a",), ("b",), ("\0",):
        total = sum(walk.p(context, w) for w in ("a", "b", "c", "\n"))
        assert total + walk.p(context, "never seen") == pytest.approx(1)


def test_odd_documents(odd_docs, no_docs):
    model = lm.fit(odd_docs)
    got = {r.doc_id: r for r in lm.scored(odd_docs, model, "doc_id").collect()}
    assert [got[i].n_tokens for i in (1, 2, 3, 4)] == [1, 1, 1, 30_001]
    empty = lm.fit(no_docs)
    assert (empty.total, empty.distinct) == (0, 0)
    assert all(r.base_score == r.score == 0 for r in lm.scored(odd_docs, empty, "doc_id").collect())


def test_the_query_scores_by_all_ngrams_up_to_three_words(spark, texts):
    rows = QUERIES["op7_lm_scoring"](spark, "/root/testdata/sf0.001").collect()
    walk = Walk([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10], 3, least=1)
    assert {r.train_tokens for r in rows} == {walk.n}
    for r in rows:
        assert r.score == pytest.approx(walk.score(texts[r.doc_id]), rel=1e-5)


def test_states_seen_once_and_one_training_text(spark):
    rows = spark.createDataFrame([(1, "a b a c a b d")], "doc_id long, text string")
    more = spark.createDataFrame([(1, "a b a c a b d"), (2, "b a c"), (3, "d e a"), (4, None)], "doc_id long, text string")
    for order in (2, 3, 4):
        for least in (1, 2, 3):
            model, walk = lm.fit(rows, order=order, least=least), Walk(["a b a c a b d"], order, least)
            for r in lm.scored(more, model, "text").collect():
                assert r.score == pytest.approx(walk.score(r.text), rel=1e-5)


def test_lanes_of_a_long_text_meet_the_state_of_the_whole_walk(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice("a b c d e".split()) for _ in range(5 * lm.LANE + 3))
    rows = spark.createDataFrame([(1, long), (2, "a b"), (3, None)], "doc_id long, text string")
    for order in (1, 2, 3, 5):
        model, walk = lm.fit(rows.where("doc_id < 3"), order=order, least=1), Walk([long, "a b"], order, 1)
        for r in lm.scored(rows, model, "text").collect():
            assert r.score == pytest.approx(walk.score(r.text), rel=1e-5)


def test_small_fetches_score_alike(spark, docs):
    model = lm.fit(docs, order=3, least=1)
    whole = {r.doc_id: r.score for r in lm.scored(docs, model, "doc_id").collect()}
    arrays = [b.column("text") for b in docs.select("text").toArrow().combine_chunks().to_batches()]
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    for limit in (1, 5_000, 1 << 30):
        got = [x for array in lm.gathered(iter(arrays), limit) for x in model.measured(array)["score"].tolist()]
        assert got == pytest.approx([whole[i] for i in ids], rel=1e-12)


def test_learned_texts_need_fewer_looks_and_score_alike(spark, docs, monkeypatch):
    train = docs.where("doc_id % 10 <> 0")
    for order, least in (3, 1), (3, 2), (1, 1):
        model = lm.fit(train, order=order, least=least)
        plain, told = (lm.scored(docs, model, "doc_id", learned=known).collect() for known in (None, F.col("doc_id") % 10 != 0))
        assert sorted(plain) == sorted(told)
    model, looked, places = lm.fit(train, order=3, least=1), [], lm._places
    monkeypatch.setattr(lm, "_places", lambda keys, grams: looked.append(len(grams)) or places(keys, grams))
    texts = pa.concat_arrays(b.column("text") for b in train.select("text").toArrow().to_batches())
    model.fetched(texts)
    every = sum(looked)
    looked.clear()
    model.fetched(texts, np.ones(len(texts), bool))
    assert sum(looked) < every / 2
