"""Quality rules as a bitmask ledger.

Each rule is evaluated once per document. The ledger row keeps the measurements and one failure
bit per rule; policies are versioned masks over those bits, so a new policy or an ablation reads
the ledger and never the texts again.

Cases: a null or empty text has no words (all counts 0) and fails `few_words`; repeated rows give
repeated ledger rows; an empty table gives an empty ledger; other input columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm import batches
from lakemill.llm.words import Words, mixed, release, steps

#: Counts that the rules read, all over whole texts.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
    "n_marked", "n_stutters",
)

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """`fails` is an SQL condition over the measurements."""

    name: str
    fails: str


#: The position of a rule is its bit; rules are only ever appended.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "4 * n_symbols > n_words"),
    Rule("repeated_lines", "3 * n_dup_lines > n_lines AND n_dup_lines > 2"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("capitals", "2 * n_upper > n_letters AND n_letters > 40"),
    Rule("exclaimed", "3 * n_marked > n_words"),
    Rule("stutters", "100 * n_stutters > 30 * n_words"),
)

#: Version of a policy: the rules that reject.
POLICIES = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "symbols", "repeated_lines", "capitals", "exclaimed", "stutters"),
}


def mask(names: tuple[str, ...] | list[str], rules: tuple[Rule, ...] = RULES) -> int:
    at = {rule.name: bit for bit, rule in enumerate(rules)}
    return sum(1 << at[name] for name in set(names))


def _repeat_words(words: Words) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text."""
    at, window = words.windows(WINDOW)
    if not len(at):
        return np.zeros(len(words), np.int64)
    key = mixed(words.text[at].astype(np.uint64) + np.uint64(1)) ^ window
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = at[counts[inverse] > 1]
    change = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + WINDOW, -1)
    covered = np.cumsum(change)[:-1] > 0
    return np.bincount(words.text[covered], minlength=len(words))


def _line_counts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line."""
    start, end, text = words.lines()
    key = mixed(text.astype(np.uint64) + np.uint64(1)) ^ words.hash(start, end)
    _, first = np.unique(key, return_index=True)
    total = np.bincount(text, minlength=len(words))
    return total, total - np.bincount(text[first], minlength=len(words))


def measured(array: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of a batch of texts."""
    words = Words.of(array)
    data = words.data
    symbol = np.zeros(256, dtype=bool)
    symbol[np.frombuffer(SYMBOLS.encode(), np.uint8)] = True
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    inside = np.zeros(256, dtype=bool)
    inside[:] = True
    inside[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    inside[0x80:0xC0] = False
    lines, dup_lines = _line_counts(words)
    marked = data[words.end - 1] == 0x21 if len(words.end) else np.zeros(0, bool)
    h = words.hashes()
    stutter = np.flatnonzero((h[1:] == h[:-1]) & (words.text[1:] == words.text[:-1])) + 1
    return {
        "n_stutters": np.bincount(words.text[stutter], minlength=len(words)),
        "n_words": words.counts(),
        "word_chars": words.per_text(inside[data]),
        "n_symbols": words.per_text(symbol[data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": _repeat_words(words),
        "n_lines": lines,
        "n_upper": words.per_text(upper),
        "n_letters": words.per_text(upper | lower),
        "n_marked": np.bincount(words.text[marked], minlength=len(words)),
    }


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measure(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for array in column:
        parts = [measured(step) for step in steps(array)] or [measured(array)]
        yield pa.StructArray.from_arrays(
            [pa.array(np.concatenate([p[m] for p in parts]).astype(np.int64)) for m in MEASURES], list(MEASURES)
        )
    release()


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    bits = [F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, rule in enumerate(rules)]
    return sum(bits[1:], bits[0]).cast("long")


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, the measurements, failed): one row per document, `failed` one bit per rule."""
    batches.small(docs.sparkSession)
    rows = docs.select(F.col(key), _measure(F.col(text)).alias("_m")).select(key, "_m.*")
    return rows.withColumn("failed", failure_bits(rules))


def decided(rows: DataFrame, version: str = "v2", rules: tuple[Rule, ...] = RULES) -> Column:
    """True where the policy of that version keeps the document."""
    del rows
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version], rules)).cast("long")) == 0


def ablation(rows: DataFrame, version: str = "v2", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(rule, failed, only, without): documents that fail the rule, that fail no other rule of the
    policy, and that the policy would keep without the rule. One pass of sums over the masks."""
    policy = mask(POLICIES[version], rules)
    hit = F.col("failed").bitwiseAND(F.lit(policy).cast("long"))
    names = [r.name for r in rules if mask([r.name], rules) & policy]

    def count(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0)).alias(name)

    sums = rows.agg(
        *[
            count(c, f"{kind}_{name}")
            for name in names
            for kind, c in (
                ("failed", hit.bitwiseAND(F.lit(mask([name], rules)).cast("long")) != 0),
                ("only", hit == mask([name], rules)),
                ("without", hit.bitwiseAND(F.lit(policy & ~mask([name], rules)).cast("long")) == 0),
            )
        ]
    )
    entries = F.array(*[
        F.struct(F.lit(name).alias("rule"), *[F.col(f"{kind}_{name}").alias(kind) for kind in ("failed", "only", "without")])
        for name in names
    ])
    return sums.select(F.explode(entries).alias("_e")).select("_e.*")
