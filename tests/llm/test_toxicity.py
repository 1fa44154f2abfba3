import random

from lakemill.llm import toxicity
from lakemill.llm.toxicity import Lexicon, Matcher, folded


def test_folding():
    assert folded("Idiot") == folded("1d10t") == folded("іdіоt") == folded("İdiot ").replace("i̇", "i") == " idiot "
    assert folded("$tup1d, cl0wn!") == " stupid ciown " and folded(None) == folded(" \n") == "  "


def test_weights_exceptions_and_length():
    lexicon = Lexicon({" idiot ": 5.0, " scum": 3.0}, [("useful", "idiot")], (-3.0, 1.0, 1.0, 0.0))
    m = Matcher(lexicon)
    assert m.features("an idiot") > m.features("an idiot " + "and more words of text " * 9)
    assert m.features("the useful idiot") == (0.0, 0.0, 0.0) != m.features("useful idiot, you idiot")
    assert m.features("scummy") == m.features("SCUMMY scummy") != (0.0, 0.0, 0.0)
    assert m.score(None) == m.score("") == m.score("nothing here") < 0.5 < m.score("idiot scum")


def made(n, spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("bdgkmnprtvaeou") for _ in range(6)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["jerkface", "j3rkface", "dumbhead"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_and_predicts_held_out(spark, odd_docs, no_docs):
    docs, labels = made(400, spark)
    lexicon = toxicity.fit(docs, labels.where("doc_id % 4 <> 0"))
    rows = toxicity.scores(docs.where("doc_id % 4 = 0"), lexicon, "doc_id").collect()
    wrong = [r.doc_id for r in rows if r.predicted != int(r.doc_id % 5 == 0)]
    assert len(wrong) <= 2
    assert toxicity.scores(odd_docs, lexicon, "doc_id").where("score >= 0 AND score <= 1").count() == odd_docs.count()
    assert toxicity.accepted(odd_docs, lexicon).columns == odd_docs.columns
    assert toxicity.accepted(no_docs, lexicon).count() == 0


def test_nothing_to_learn_from(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one_kind = spark.createDataFrame([(6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    for labels in (none, one_kind):
        assert {r.predicted for r in toxicity.scores(odd_docs, toxicity.fit(odd_docs, labels), "doc_id").collect()} == {0}


def test_only_copies_of_one_label_count_as_one_text(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(60):  # a fifth or a third of the shingles are shared: not copies
        passage = [word() for _ in range(60)]
        rows += [(3 * i + k, " ".join(passage + [word() for _ in range(60)]), 0, 0) for k in range(2)]
    text = [word() for _ in range(200)]
    near = [" ".join(text[:k] + [word()] + text[k + 1 :]) for k in (10, 60, 110)]
    rows += [(1000 + k, t, 0, 0) for k, t in enumerate(near)] + [(900, near[0], 1, 1), (1100, near[0], 1, 1), (1101, near[0], 0, 0)]
    frame = spark.createDataFrame(rows, "id long, text string, toxic long, part long")
    want = {(i, toxic) for i, _, toxic, _ in rows} - {(1001, 0), (1002, 0), (1100, 1), (1101, 0)}
    for given in (frame, frame.orderBy(frame.id.desc())):
        assert {(r.id, r.toxic) for r in toxicity._distinct_texts(given).collect()} == want
