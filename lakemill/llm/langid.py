"""Language identification by words first, backing off to shorter character n-grams.

A word seen in training adds its log frequency in each language. An unseen word is cut into
character n-grams (with word boundaries) of the longest size at which any is known, down to single
characters, and adds the mean log frequency of the known ones. The language with the largest sum
wins; the score is its share after normalising over the learned languages.

The classifier is fitted on about TRAIN_ROWS labelled rows (a documented bound). The bound is shared
out so that languages with few rows are learned from all of them. Every word and every n-gram of these
rows is kept, n-grams of whole words; the sample alone bounds what is sent to the tasks.

Cases: null texts and texts without a letter are `und` with score 0, as is everything when there is
nothing to learn from; a text of letters never seen gets the learned language with the most words
and an even score; ties go to the first language by name; repeated rows are predicted alike; an empty
table gives no rows; a very long text is one prediction from the counts of its distinct words, which
are scored a bounded number at a time; other input columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm import batches
from lakemill.llm.sample import evenly

TRAIN_ROWS = 12_000
LONGEST = 5
_SMOOTH = 0.5
_WORD = re.compile(r"[^\W\d_]+")
#: Unseen words a worker remembers.
_CACHE = 200_000

NONE = "und"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(word: str, size: int) -> list[str]:
    """Character n-grams of a word between boundary marks; size 1 has none of the marks."""
    if size == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray


def _summed(rows: DataFrame, fn, schema: str, *keys: str) -> DataFrame:
    return rows.mapInArrow(fn, schema).groupBy(*keys).agg(F.sum("n").alias("n"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word, n in Counter(words_of(text)).items():
                counts[lang, word] += n
        yield pa.RecordBatch.from_pylist(
            [{"lang": k[0], "word": k[1], "n": n} for k, n in counts.items()],
            pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]),
        )


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for row in batch.to_pylist():
            for size in range(1, LONGEST + 1):
                for gram in grams(row["word"], size):
                    counts[row["lang"], gram] += row["n"]
        yield pa.RecordBatch.from_pylist(
            [{"lang": k[0], "gram": k[1], "n": n} for k, n in counts.items()],
            pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())]),
        )


def _logs(counts: DataFrame, unit: str, langs: list[str], group) -> tuple[dict[str, int], np.ndarray]:
    """Number of each unit, and its log frequency in each language among the units of its group."""
    rows = counts.select(unit, "lang", "n").toArrow()
    units, lang = (rows.column(c).combine_chunks().dictionary_encode() for c in (unit, "lang"))
    table = units.dictionary.to_pylist()
    at = np.array([langs.index(x) for x in lang.dictionary.to_pylist()], dtype=np.int64)
    seen = np.zeros((len(table), len(langs)))
    seen[units.indices.to_numpy(), at[lang.indices.to_numpy()]] = rows.column("n").to_numpy()
    kind = np.array([group(x) for x in table], dtype=int)
    logs = np.zeros_like(seen)
    for k in np.unique(kind):
        own = kind == k
        # Relative frequencies with one floor for all, so that a language with few texts gains nothing.
        totals = np.maximum(seen[own].sum(axis=0), 1)
        logs[own] = np.log(seen[own] / totals + _SMOOTH / totals.max())
    return {x: i for i, x in enumerate(table)}, logs


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = TRAIN_ROWS) -> Model:
    """Learn from the rows with a text and a language."""
    batches.small(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    sampled = evenly(rows, F.col("id"), "lang", bound).select("lang", "text")
    words = _summed(sampled, _count_words, "lang string, word string, n long", "lang", "word").cache()
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    word_at, word_logs = _logs(words, "word", langs, lambda _: 0)
    counted = _summed(words, _count_grams, "lang string, gram string, n long", "lang", "gram")
    gram_at, gram_logs = _logs(counted, "gram", langs, len)
    words.unpersist()
    return Model(langs, word_at, word_logs, gram_at, gram_logs)


class Scorer:
    """Predicts with a model; remembers the rows of unseen words up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.unseen: dict[str, int] = {}
        self.rows = np.zeros((1024, max(1, len(model.langs))))  # of unseen words; grows to _CACHE

    def backoff(self, word: str) -> np.ndarray:
        for size in range(min(LONGEST, len(word) + 2), 0, -1):
            known = [i for g in grams(word, size) if (i := self.model.grams.get(g)) is not None]
            if known:
                return self.model.gram_logs[known].mean(axis=0)
        return np.zeros(len(self.model.langs))

    def _unseen(self, words: list[str]) -> np.ndarray:
        """Rows of words that no training text has."""
        if len(self.unseen) + len(words) > _CACHE:  # the memory starts anew
            self.unseen.clear()
        spots = []
        for word in words:
            at = self.unseen.get(word)
            if at is None:
                at = self.unseen[word] = len(self.unseen)
                if at == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.rows[at] = self.backoff(word)
            spots.append(at)
        return self.rows[spots]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text or ""))
        if not self.model.langs or not any(c.isalpha() for word in counts for c in word):
            return NONE, 0.0
        sums = np.zeros(len(self.model.langs))
        known = {at: n for word, n in counts.items() if (at := self.model.words.get(word)) is not None}
        if known:
            sums += np.array(list(known.values()), dtype=float) @ self.model.word_logs[list(known)]
        words = [word for word in counts if word not in self.model.words] if len(known) < len(counts) else []
        for low in range(0, len(words), max(1, _CACHE // 4)):
            part = words[low : low + max(1, _CACHE // 4)]
            sums += np.array([counts[word] for word in part], dtype=float) @ self._unseen(part)
        return self._best(sums)

    def _best(self, sums: np.ndarray) -> tuple[str, float]:
        share = np.exp(sums - sums.max())
        best = int(np.argmax(share))
        return self.model.langs[best], float(share[best] / share.sum())


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(spark: SparkSession, model: Model):
    """UDF of a text: (lang_pred, score)."""
    batches.small(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(sent.value)
        for array in column:
            found = [scorer.predict(x.as_py()) for x in array]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang_pred", "score"],
            )

    return predict


def predicted(docs: DataFrame, model: Model, *keep: str | Column, text: str = "text") -> DataFrame:
    """(the kept columns, lang_pred, score) per input row."""
    predict = predictor(docs.sparkSession, model)
    return docs.select(*keep, predict(F.col(text)).alias("_p")).select("*", "_p.*").drop("_p")
