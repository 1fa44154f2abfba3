"""Vocabulary and term weights of word n-grams.

Terms of a document are counted inside its row, so fitting shuffles one partial row per term
and map task, and transforming shuffles nothing: the fitted vocabulary has a fixed size limit
and travels with the plan.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakemill.functions.fixed import MAX_DF, MAX_TERMS, MIN_DF, NGRAMS


def words(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), F.lit(0)
    )


def _grams_of(tokens: Column, n: int) -> Column:
    # Each gram is a shorter one and the word after it; slicing the words for every gram is slow.
    count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    grams = F.slice(tokens, 1, count)
    for k in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(tokens, k, count), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams of the token list, shorter ones first."""
    lists = [tokens if n == 1 else _grams_of(tokens, n) for n in range(low, high + 1)]
    return lists[0] if len(lists) == 1 else F.concat(*lists)


def add_terms(
    df: DataFrame, text: str, grams: tuple[int, int] = NGRAMS, stop_words: list[str] = []
) -> DataFrame:
    """Add `terms`, the n-grams of the text."""
    df = df.withColumn("_words", words(F.col(text)))
    if stop_words:
        stops = F.array(*[F.lit(w) for w in sorted(set(stop_words))])
        df = df.withColumn("_words", F.filter("_words", lambda w: ~F.array_contains(stops, w)))
    return df.withColumn("terms", ngrams(F.col("_words"), *grams)).drop("_words")


def gather_counts(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document with `counts`, its distinct terms and their numbers `tf`, without a shuffle.

    The sorted term list is cut where a term differs from the one before it; the distance
    between cuts is the count.
    """
    s = F.col("_sorted")
    places = F.filter(
        F.sequence(F.lit(1), F.size(s)),
        lambda i: (i == 1) | (F.element_at(s, i) != F.element_at(s, F.greatest(i - 1, F.lit(1)))),
    )
    ends = F.concat(F.slice(F.col("_at"), 2, F.size("_at")), F.array(F.size(s) + 1))
    pairs = F.zip_with(
        "_at", ends, lambda a, b: F.struct(F.element_at(s, a).alias("term"), (b - a).alias("tf"))
    )
    return (
        df.select(*keep, F.sort_array("terms").alias("_sorted"))
        .withColumn("_at", F.when(F.size(s) > 0, places))
        .select(*keep, pairs.alias("counts"))
    )


def counted_terms(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document and distinct term with its count `tf`, without a shuffle."""
    # Outer: for a plain inline the optimizer adds a size check that repeats the counting.
    return gather_counts(df, keep).select(*keep, F.inline_outer("counts")).where(F.col("term").isNotNull())


def vocabulary(
    df: DataFrame,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    max_terms: int = MAX_TERMS,
) -> DataFrame:
    """(term, df, total_tf, n_docs, idf, idx) fitted on the `terms` of df.

    Terms in fewer than min_df documents or more than max_df of them are left out; of the rest
    the max_terms most used stay, ties by term. `idx` numbers them in term order.
    """
    n_docs = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    stats = (
        counted_terms(df, [])
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("total_tf"))
        .where(F.col("df") >= min_df)
        .select("*", n_docs.alias("n_docs"))
        .where(F.col("df") <= F.col("n_docs") * F.lit(max_df))
    )
    top = stats.orderBy(F.desc("total_tf"), "term").limit(max_terms)
    # At most max_terms rows are numbered.
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("term"))
    idf = F.log((1.0 + F.col("n_docs")) / (1.0 + F.col("df"))) + 1.0
    return top.withColumns({"idf": idf, "idx": place - 1})


@dataclass(frozen=True)
class TermModel:
    """A fitted vocabulary: at most max_terms terms and their weights, in index order."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, **limits) -> TermModel:
        rows = vocabulary(df, **limits).select("term", "idf", "idx").orderBy("idx").collect()
        if not rows:
            raise ValueError("empty vocabulary: no term is within the document-frequency limits")
        return cls(tuple(r["term"] for r in rows), tuple(float(r["idf"]) for r in rows))

    def counts(self, df: DataFrame, out: str = "_counts") -> DataFrame:
        model = CountVectorizerModel.from_vocabulary(list(self.terms), inputCol="terms", outputCol=out)
        return model.transform(df)

    def weights(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Long form (keep..., idx, term, weight), L2-normalised per document."""
        # Parsed from one literal, folded by the optimizer; a literal per entry would be slow to plan.
        idf = F.from_json(F.lit(json.dumps(self.idf)), "array<double>")
        cells = F.unwrap_udt("_counts")
        raw = F.zip_with(
            cells["indices"], cells["values"], lambda i, tf: (1.0 + F.log(tf)) * F.element_at(idf, i + 1)
        )
        norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda acc, w: acc + w * w))
        pairs = F.zip_with(
            "_idx", "_raw", lambda i, w: F.struct(i.alias("idx"), (w / F.col("_norm")).alias("weight"))
        )
        names = F.from_json(F.lit(json.dumps(self.terms)), "array<string>")
        return (
            self.counts(df)
            .select(*keep, cells["indices"].alias("_idx"), raw.alias("_raw"))
            .withColumn("_norm", norm)
            .select(*keep, F.inline_outer(pairs))
            .where(F.col("idx").isNotNull())
            .withColumn("term", F.element_at(names, F.col("idx") + 1))
        )

    def vectors(self, df: DataFrame, out: str = "tfidf") -> DataFrame:
        """Add the sparse, L2-normalised weight vector; unseen terms are ignored."""
        cells = F.unwrap_udt("_counts")
        damped = F.struct(
            cells["type"].alias("type"),
            cells["size"].alias("size"),
            cells["indices"].alias("indices"),
            F.transform(cells["values"], lambda tf: 1.0 + F.log(tf)).alias("values"),
        )
        # A struct becomes a vector through JSON, which keeps the whole step inside the JVM.
        schema = StructType([StructField("v", VectorUDT())])
        vector = F.from_json(F.to_json(F.struct(damped.alias("v"))), schema)["v"]
        df = self.counts(df).withColumn("_damped", vector)
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_damped", outputCol="_scaled"
        )
        norm = Normalizer(p=2.0, inputCol="_scaled", outputCol=out)
        return norm.transform(scale.transform(df)).drop("_counts", "_damped", "_scaled")


def oov_ratio(df: DataFrame, model: TermModel, group: list[str]) -> DataFrame:
    """Share of term uses outside the vocabulary per group, flagged above one fifth."""
    known = F.aggregate(
        F.unwrap_udt("_counts")["values"], F.lit(0.0), lambda acc, v: acc + v
    )
    rows = model.counts(df).select(*group, F.size("terms").alias("_all"), known.alias("_known"))
    ratio = 1 - F.try_divide(F.sum("_known"), F.sum("_all").cast("double"))
    return rows.groupBy(*group).agg(
        F.sum("_all").alias("n_terms"),
        F.round(ratio, 6).alias("oov_ratio"),
        F.coalesce(ratio > 0.2, F.lit(False)).alias("alert"),
    )
