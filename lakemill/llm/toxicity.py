"""Toxicity by a weighted lexicon.

Texts are folded first: case, accents, look-alike letters of other scripts, digits and signs that
stand for letters. Lexicon entries (whole words, or starts of words) and exception phrases are
matched by one Aho-Corasick automaton; a word counts once, with its heaviest entry, and not inside
an exception phrase. The sum of the weights, once as it is and once per hundred different words,
and the number of matched words give the score through a logistic curve.

Weights are log odds among the different words of toxic and of other texts; entries need MIN_TOXIC
toxic texts, log odds of MIN_ODDS and a likelihood ratio of MIN_RATIO. Phrases of two words that
hold an entry but occur almost only in texts that are not toxic become exceptions. The curve is
fitted on texts that had no part in the lexicon they are measured with (two halves, each measured
with the other's). The classifier is fitted on about TRAIN_ROWS labelled rows (a documented bound)
and has at most MAX_ENTRIES entries and as many exceptions. Copies and near copies of one text
with one label count as one text in training, so their words weigh no more; the smallest key stays.

Cases: null and empty texts have no words and get the score of a text without matches; with no
labelled rows, or rows of one kind only, every text gets their share of toxic ones; repeated rows
score alike; a document labelled twice counts as toxic if one label says so; null labels are left
out; other input columns are left out (`scores`) or kept (`accepted`).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import batches
from lakemill.llm.columns import spare
from lakemill.llm.jaccard import _overlaps, _signature, _similar, banding
from lakemill.llm.sample import about
from lakemill.llm.words import release
from lakemill.session import durable

TRAIN_ROWS = 10_000
MAX_ENTRIES = 2_000
MIN_TOXIC = 4
MIN_ODDS = 2.0
MIN_RATIO = 20.0
SIMILAR = 0.8
_STARTS = (4, 5, 6, 7, 8)

#: Look-alike letters, and what they are read as.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "и": "u", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "п": "n", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ß": "ss", "ø": "o", "æ": "ae", "œ": "oe", "đ": "d",
}
#: Digits that stand for letters; 1, l and i are read alike.
DIGITS = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
_SIGNS = re.compile(r"[@$](?=\w)")
_GAPS = re.compile(r"[\W_]+")


def _table() -> dict[int, str]:
    out = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if plain and plain.isascii():
            out[code] = "".join(DIGITS.get(c, c) for c in plain)
    out |= {code: None for code in [*range(0x300, 0x370), *range(0x200B, 0x2010), 0xAD, 0xFEFF]}
    return out | {ord(k): v for k, v in (LOOK_ALIKES | DIGITS).items()}


_FOLD = _table()


def folded(text: str | None) -> str:
    """The words of a text as the lexicon sees them, each with a space before and after."""
    text = (text or "").lower()
    if "@" in text or "$" in text:
        text = _SIGNS.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return f" {_GAPS.sub(' ', text.translate(_FOLD)).strip()} "


def entries_of(word: str) -> list[str]:
    """What the lexicon may hold of a word: the whole word, and its starts."""
    return [f" {word} ", *[f" {word[:n]}" for n in _STARTS if len(word) >= n]]


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[tuple[str, str]] = field(default_factory=list)
    #: Intercept, factors of the logged sum, the logged sum per hundred words, the logged number of words.
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.curve = lexicon.curve
        self.machine = ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            entry = entry.lower().translate(_FOLD)
            self.machine.add_word(entry, (len(entry), weight, 0))
        for first, second in (tuple(w.lower().translate(_FOLD) for w in phrase) for phrase in lexicon.exceptions):
            self.machine.add_word(f" {first} {second} ", (len(first) + len(second) + 3, 0.0, len(first) + 1))
        self.empty = len(self.machine) == 0
        self.machine.make_automaton()

    def hits(self, text: str) -> dict[int, float]:
        """Weight by the place of the space before each matched word of a folded text."""
        found: dict[int, float] = {}
        excepted: set[int] = set()
        for end, (size, weight, second) in () if self.empty else self.machine.iter(text):
            start = end - size + 1
            if second:
                excepted |= {start, start + second}
            elif weight > found.get(start, 0.0):
                found[start] = weight
        return {k: v for k, v in found.items() if k not in excepted}

    def features(self, text: str | None) -> tuple[float, float, float]:
        plain = folded(text)
        words = {plain[start + 1 : plain.index(" ", start + 1)]: w for start, w in self.hits(plain).items()}
        if not words:
            return 0.0, 0.0, 0.0
        total = sum(words.values())
        return math.log1p(total), math.log1p(100 * total / len(set(plain.split()))), math.log1p(len(words))

    def score(self, text: str | None) -> float:
        odds = self.curve[0] + sum(b * x for b, x in zip(self.curve[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))


_COUNTED = pa.schema([("unit", pa.string()), ("part", pa.int64()), ("n", pa.int64()), ("texts", pa.int64())])


def _counted(units):
    """mapInArrow step: occurrences (of `units`) and texts per unit and part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            texts: Counter = Counter()
            for text, part in zip(batch.column("text").to_pylist(), batch.column("part").to_pylist()):
                for unit, n in Counter(units(folded(text))).items():
                    counts[unit, part] += n
                    texts[unit, part] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int64()),
                 pa.array(list(counts.values()), pa.int64()), pa.array(list(texts.values()), pa.int64())], schema=_COUNTED,
            )
        release()

    return count


#: Parts of the training rows: label (0, 1) and half (0, 2).
_PARTS = (0, 1, 2, 3)


def _by_part(rows: DataFrame, units) -> DataFrame:
    counts = rows.mapInArrow(_counted(units), "unit string, part long, n long, texts long")
    return counts.groupBy("unit").agg(*[
        F.coalesce(F.sum(F.when(F.col("part") == p, F.col(c))), F.lit(0)).alias(f"{c}{p}") for p in _PARTS for c in ("n", "texts")
    ])


def _lexicon_units(plain: str) -> Iterator[str]:
    """Entries of the different words of a folded text, and an empty unit for each of these words."""
    for word in set(plain.split()):
        yield ""
        yield from entries_of(word)


def _weighed(totals: dict[int, int], halves: tuple[int, ...], least: int) -> tuple[Column, Column]:
    """(log odds or null, likelihood ratio) of a unit, by the counts of these halves."""
    wt, wo = (sum(totals[label + half] for half in halves) for label in (1, 0))
    t, o, texts = (
        sum((F.col(f"{c}{label + half}") for half in halves[1:]), F.col(f"{c}{label + halves[0]}"))
        for c, label in (("n", 1), ("n", 0), ("texts", 1))
    )
    odds = F.log((t + 0.5) / (wt + 1)) - F.log((o + 0.5) / (wo + 1))
    even_t, even_o = (t + o) * (wt / max(1, wt + wo)), (t + o) * (wo / max(1, wt + wo))
    ratio = 2 * (
        F.when(t > 0, t * F.log(t / even_t)).otherwise(F.lit(0.0)) + F.when(o > 0, o * F.log(o / even_o)).otherwise(F.lit(0.0))
    )
    return F.when((texts >= least) & (odds >= MIN_ODDS) & (ratio >= MIN_RATIO), odds), ratio


_DROPPED = pa.schema([("toxic", pa.int64()), ("node", pa.binary())])


def _copies(sets: list[np.ndarray]) -> np.ndarray:
    """Places of the sets that have a Jaccard similarity of at least SIMILAR with an earlier one."""
    size = np.array([len(x) for x in sets], dtype=np.float64)

    def like(some: np.ndarray, others: np.ndarray) -> np.ndarray:
        inter = _overlaps([sets[i] for i in some], [sets[i] for i in others])
        return _similar(inter, size[some], size[others], SIMILAR) & (others[None, :] < some[:, None])

    every = np.arange(len(sets))
    first = np.concatenate([like(every[k : k + 512], every[:1])[:, 0] for k in range(0, len(sets), 512)])
    rest = every[~first]  # most copies are copies of the first, so few are compared with all
    more = [rest[k : k + 512][like(rest[k : k + 512], every).any(axis=1)] for k in range(0, len(rest), 512)]
    return np.concatenate([every[first], *more])


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by label, bucket and key; those similar to an earlier one of their bucket go out."""
    unit, nodes, sets = None, [], []

    def found() -> pa.RecordBatch:
        at = _copies(sets)
        return pa.RecordBatch.from_arrays([pa.array([unit[0]] * len(at), pa.int64()), pa.array([nodes[i] for i in at], pa.binary())], schema=_DROPPED)

    for batch in batches:
        for toxic, bucket, node, grams in zip(*(batch.column(c) for c in ("toxic", "bucket", "node", "grams"))):
            if (own := (toxic.as_py(), bucket.as_py())) != unit:
                if len(sets) > 1:
                    yield found()
                unit, nodes, sets = own, [], []
            nodes.append(node.as_py())
            sets.append(grams.values.to_numpy().copy())
    if len(sets) > 1:
        yield found()
    release()


def _distinct_texts(rows: DataFrame) -> DataFrame:
    """(id, text, toxic, part) without copies: a row goes if a row of its label with a smaller key has the same
    text, or five-word shingles of a Jaccard similarity of at least SIMILAR (found by bands, all verified)."""
    bands, wide = banding(SIMILAR)
    sign = _signature(bands, wide, 5, with_set=True)
    once = rows.groupBy("toxic", "part", "text").agg(F.min("id").alias("id"))
    signed = durable(once.withColumn("node", F.unhex(F.md5("text"))).withColumn("s", sign("text")), "labelled")
    slots = signed.select("toxic", "node", F.explode("s.bands").alias("bucket"))
    shared = slots.join(slots.groupBy("toxic", "bucket").count().where("count > 1"), ["toxic", "bucket"])
    groups = shared.join(signed.select("toxic", "node", "id", F.col("s.grams").alias("grams")), ["toxic", "node"])
    dropped = (
        groups.select("toxic", "bucket", "id", "node", "grams").repartition("toxic", "bucket")
        .sortWithinPartitions("toxic", "bucket", "id", "node").mapInArrow(_dropped, "toxic long, node binary").distinct()
    )
    return signed.join(dropped, ["toxic", "node"], "left_anti").select("id", "text", "toxic", "part")


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    beta, keep = np.zeros(x.shape[1]), ridge * np.diag([0.01] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = TRAIN_ROWS,
) -> Lexicon:
    """Learn from the documents that have a label. `labels` are (key, label 0 or 1)."""
    batches.small(docs.sparkSession)
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.col(label).cast("long")).alias("toxic")
    )
    marks = F.broadcast(about(marks, F.col("id"), bound))  # about `bound` rows of two numbers
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(marks, "id").select("id", "text", "toxic")
    half = F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)) * 2
    rows = _distinct_texts(rows.where("text IS NOT NULL").withColumn("part", half + (F.col("toxic") > 0).cast("long"))).cache()
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    t, o = sum(n for k, n in sizes.items() if k > 0), sizes.get(0, 0)
    if not t or not o:
        share = (t + 0.5) / (t + o + 1) if t + o else 0.01
        rows.unpersist()
        return Lexicon({}, [], (math.log(share / (1 - share)), 0.0, 0.0, 0.0))

    counted = _by_part(rows, _lexicon_units).where(f"texts1 + texts3 >= {MIN_TOXIC - 1}").cache()
    words = counted.where("unit = ''").first()
    totals = {p: int(words[f"n{p}"]) if words else 0 for p in _PARTS}
    (whole, ratio), (even, _), (odd, _) = (
        _weighed(totals, halves, least) for halves, least in (((0, 2), MIN_TOXIC), ((0,), MIN_TOXIC - 1), ((2,), MIN_TOXIC - 1))
    )
    found = (
        counted.where("unit <> ''").select("unit", whole.alias("whole"), even.alias("even"), odd.alias("odd"), ratio.alias("ratio"))
        .where("whole IS NOT NULL OR even IS NOT NULL OR odd IS NOT NULL").orderBy(F.desc("ratio"), "unit").limit(MAX_ENTRIES).collect()
    )
    counted.unpersist()
    weights = {half: {r["unit"]: float(r[half]) for r in found if r[half] is not None} for half in ("whole", "even", "odd")}
    exceptions = _exceptions(rows, Lexicon(weights["whole"]))
    # About `bound` rows of a few numbers; each half is measured with the lexicon of the other.
    x, y = [], []
    for half, own in (("odd", 0), ("even", 2)):
        measured = rows.where(F.col("part").isin(own, own + 1)).select(
            _featured(docs.sparkSession, Lexicon(weights[half], exceptions))("text").alias("x"), "toxic"
        ).collect()
        x += [r["x"] for r in measured]
        y += [float(r["toxic"] > 0) for r in measured]
    rows.unpersist()
    curve = _logistic(np.array(x, dtype=float), np.array(y))
    return Lexicon(weights["whole"], exceptions, tuple(float(b) for b in curve))


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> list[tuple[str, str]]:
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)
    machines: list[Matcher] = []

    def phrases(plain: str) -> set[str]:
        if not machines:
            machines.append(Matcher(sent.value))
        out = set()
        for start in machines[0].hits(plain):
            before = plain[:start].rpartition(" ")[2]
            word, _, after = plain[start + 1 :].partition(" ")
            after = after.partition(" ")[0]
            out |= {f"{before} {word}"} if before else set()
            out |= {f"{word} {after}"} if after else set()
        return out

    toxic, other = F.col("texts1") + F.col("texts3"), F.col("texts0") + F.col("texts2")
    harmless = _by_part(rows, phrases).where((other >= 5) & (other > 10 * toxic)).orderBy(F.desc(other), "unit").limit(MAX_ENTRIES)
    return [tuple(r["unit"].split(" ")) for r in harmless.collect()]


def _featured(spark: SparkSession, lexicon: Lexicon):
    sent = spark.sparkContext.broadcast(lexicon)

    def features(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(sent.value)
        for array in column:
            yield pa.array([list(matcher.features(x.as_py())) for x in array], pa.list_(pa.float64()))

    return F.arrow_udf(features, "array<double>")


def scorer(spark: SparkSession, lexicon: Lexicon):
    """UDF of a text: its score between 0 and 1."""
    batches.small(spark)
    sent = spark.sparkContext.broadcast(lexicon)

    def score(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(sent.value)
        for array in column:
            yield pa.array([matcher.score(x.as_py()) for x in array], pa.float64())
        release()

    return F.arrow_udf(score, "double")


def scores(docs: DataFrame, lexicon: Lexicon, *keep: str | Column, text: str = "text") -> DataFrame:
    """(the kept columns, score, predicted) per input row."""
    rows = docs.select(*keep, scorer(docs.sparkSession, lexicon)(F.col(text)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The input rows that score under one half, all columns kept."""
    score = scorer(docs.sparkSession, lexicon)
    name = spare(docs, "_score")
    return docs.withColumn(name, score(F.col(text))).where(F.col(name) < 0.5).drop(name)
