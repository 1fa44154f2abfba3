import math
import random
from collections import Counter

import pytest

from lakemill.llm import langid
from lakemill.llm.langid import Model, Scorer


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where("doc_id % 4 <> 2"))
    rows = langid.predicted(docs.where("doc_id % 4 = 2"), model, "doc_id", "lang").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_documents(spark, odd_docs, no_docs):
    model = langid.fit(odd_docs)
    got = {r.doc_id: r for r in langid.predicted(odd_docs, model, "doc_id").collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4 and got[1].score == 0
    assert got[4].lang_pred == got[6].lang_pred == "en" and got[10].lang_pred == "fr"
    nothing = langid.fit(no_docs)
    assert nothing.langs == [] and {r.lang_pred for r in langid.predicted(odd_docs, nothing, "doc_id").collect()} == {"und"}


def test_unseen_words_back_off_to_the_longest_known_grams(spark):
    df = spark.createDataFrame([(1, "singing ringing singing ringing", "a"), (2, "xyloph xylopq xyloph xylopq", "b")], "doc_id long, text string, lang string")
    scorer = Scorer(langid.fit(df))
    assert scorer.predict("bringing")[0] == "a" and scorer.predict("xylo")[0] == "b"
    assert langid.grams("ab", 3) == ["<ab", "ab>"] and langid.grams("ab", 1) == ["a", "b"]


def test_memory_bound_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(langid, "_CACHE", 8)
    model = langid.fit(spark.createDataFrame([(1, "aa bb aa bb", "a"), (2, "cc dd cc dd", "b")], "doc_id long, text string, lang string"))
    text = " ".join(f"a{c}b" for c in "abcdefghijklmnopq") + " cc"
    small = Scorer(model).predict(text)
    monkeypatch.setattr(langid, "_CACHE", 200_000)
    assert small == Scorer(model).predict(text) and isinstance(model, Model)


def test_rare_languages_are_learned_whole_and_nothing_is_left_out(spark):
    rows = [(i, f"common words of many rows number{i}", "a") for i in range(2000)]
    rows += [(i, f"seltenes wort nummer{i}", "b") for i in range(2000, 2005)]
    long = "q" * 200 + "zzzzz"
    rows.append((3000, long, "c"))
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bound=100)
    assert model.langs == ["a", "b", "c"] and long in model.words and "zzzzz" in model.grams  # seen once, behind 200 letters
    assert Scorer(model).predict("seltenes wort")[0] == "b" and Scorer(model).predict("izzzzzi")[0] == "c"


def brute(texts, text):
    """Sum of log frequencies by the definition, from plain dictionaries."""
    langs = sorted({lang for lang, _ in texts})
    words = {lang: Counter(w for l, t in texts if l == lang for w in langid.words_of(t)) for lang in langs}
    grams = {(lang, k): Counter() for lang in langs for k in range(1, langid.LONGEST + 1)}
    for lang in langs:
        for w, n in words[lang].items():
            for k in range(1, langid.LONGEST + 1):
                for g in langid.grams(w, k):
                    grams[lang, k][g] += n
    floor = lambda tables: 0.5 / max(max(sum(t.values()), 1) for t in tables)
    out = {}
    for lang in langs:
        total = 0.0
        for w in langid.words_of(text):
            if any(w in words[l] for l in langs):
                total += math.log(words[lang][w] / max(sum(words[lang].values()), 1) + floor(list(words.values())))
                continue
            for k in range(min(langid.LONGEST, len(w) + 2), 0, -1):
                tables = {l: grams[l, k] for l in langs}
                known = [g for g in langid.grams(w, k) if any(g in t for t in tables.values())]
                if known:
                    own = max(sum(tables[lang].values()), 1)
                    total += sum(math.log(tables[lang][g] / own + floor(list(tables.values()))) for g in known) / len(known)
                    break
        out[lang] = total
    return out


def test_predictions_equal_brute_force(spark):
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    rows = [(lang, " ".join(word(letters) for _ in range(30))) for lang, letters in (("x", "abcde"), ("y", "cdefg"), ("z", "efghi")) for _ in range(8)]
    model = langid.fit(spark.createDataFrame([(i, t, l) for i, (l, t) in enumerate(rows)], "doc_id long, text string, lang string"))
    scorer = Scorer(model)
    for _ in range(200):
        text = " ".join(word("abcdefghij") for _ in range(rng.randint(1, 8)))
        sums = brute(rows, text)
        lang, score = scorer.predict(text)
        best = max(sums.values())
        assert sums[lang] == pytest.approx(best, abs=1e-9)
        assert score == pytest.approx(1 / sum(math.exp(v - best) for v in sums.values()), rel=1e-6)
