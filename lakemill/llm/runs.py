"""Periodic runs of words, found as maximal pairs in a tree of LCP intervals.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
`least` words and `exponent` periods long, that no neighbouring word extends. Its first word s and s + q
start equal stretches of length - q words, which differ in the word before (else the run would start
earlier) and in the word after: a maximal pair. So every run is a maximal pair whose distance is at most
1 / (exponent - 1) of its length, and every such pair is a run as it stands.

Suffixes are sorted by prefix doubling, the lengths of common prefixes of neighbours come from the
ranks of every doubling, and intervals are joined bottom-up, longest common prefix first. An interval
keeps its positions in ascending order, with the word on their left as their class. Where two intervals
meet, a pair is looked for between positions of different classes only. Occurrences of one stretch at a
distance below its length stand in steps of its period, so the partner of a run's start is the next
position of the other interval: each position of the smaller interval asks for two neighbours, and no
pairs within a group are listed. A pair whose distance is a multiple of the smallest period has the same
two ends, so the smallest distance of each stretch is kept.

Words are maximal stretches without U+0020 and U+0009 to U+000D and are told apart exactly. Texts in
which no stretch of the shortest possible length occurs twice have no run and skip the sorting; that test
uses hashes and can only let a text through needlessly.

Cases: null, empty and blank texts have no words and no runs, and collapse to an empty text; a very long
text is worked on alone, in memory of some twenty times its size; repeated rows give repeated results; an
empty table gives an empty result; other input columns are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm import batches
from lakemill.llm.words import mixed, release, steps

_TURN = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def repeated(ids: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Texts in which some stretch of `width` words occurs twice."""
    n = len(ids) - width + 1
    if n <= 1:
        return np.zeros(0, np.int64)
    h, size = mixed(ids.astype(np.uint64) + text.astype(np.uint64) * _TURN), 1
    while 2 * size <= width:
        h = mixed(h[:-size] * _TURN + h[size:])
        size *= 2
    if size < width:
        h = mixed(h[:n] * _TURN + h[width - size : width - size + n])
    h = h[:n][text[:n] == text[width - 1 :]]
    owner = text[:n][text[:n] == text[width - 1 :]]
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    return np.unique(owner[order[1:][same]])


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in suffix order, and the rank of every position at each doubling of the prefix."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    ahead = ids[order]
    first = np.maximum.accumulate(np.where(np.append(True, ahead[1:] != ahead[:-1]), np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = first, -1
    levels, width = [rank[:n].copy()], 1
    while True:
        sizes = np.bincount(rank[:n], minlength=n)
        active = np.flatnonzero(sizes[rank[:n]] > 1)
        if not len(active):
            break
        old, later = rank[active], rank[np.minimum(active + width, n)]
        o = np.lexsort((later, old))
        old, later = old[o], later[o]
        at = np.arange(len(o))
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
        new = np.append(True, (old[1:] != old[:-1]) | (later[1:] != later[:-1]))
        rank[active[o]] = old + np.maximum.accumulate(np.where(new, at, 0)) - group
        levels.append(rank[:n].copy())
        width *= 2
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    return order, levels


def common(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix and the next one in order."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    length = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = np.append(levels[k], -1)
        # A suffix that ends here is equal to none, and its place past the end to no other.
        same = (level[np.minimum(a, n)] == level[np.minimum(b, n)]) & (a < n) & (b < n)
        step = same.astype(np.int64) << k
        length += step
        a += step
        b += step
    return length


def maximal_pairs(ids: np.ndarray, left: np.ndarray, least: int, exponent: int) -> dict[tuple[int, int], int]:
    """(start, end) of every run with its smallest period. Equal numbers in `ids` are equal words; `left`
    is the class of the word before each position."""
    order, levels = suffixes(ids)
    lcp = common(order, levels)
    need = -(-least * (exponent - 1) // exponent)
    edges = np.flatnonzero(lcp >= need)
    edges = edges[np.argsort(-lcp[edges], kind="stable")].tolist()
    long, before = lcp.tolist(), left.tolist()
    low: dict[int, int] = {}
    high: dict[int, int] = {}
    held: dict[int, list[int]] = {}
    found: dict[tuple[int, int], int] = {}
    place = order.tolist()
    for k in edges:
        a, e, l = low.get(k, k), high.get(k + 1, k + 1), long[k]
        big, small = held.pop(a, None) or [place[a]], held.pop(k + 1, None) or [place[k + 1]]
        if len(big) < len(small):
            big, small = small, big
        far = l // (exponent - 1)
        for x in small:
            at = bisect_left(big, x)
            if at:
                y = big[at - 1]
                q = x - y
                if q <= far and l + q >= least and before[x] != before[y]:
                    run = (y, x + l)
                    if found.get(run, q) >= q:
                        found[run] = q
            if at < len(big):
                y = big[at]
                q = y - x
                if q <= far and l + q >= least and before[x] != before[y]:
                    run = (x, y + l)
                    if found.get(run, q) >= q:
                        found[run] = q
        if len(small) == 1:
            big.insert(bisect_left(big, small[0]), small[0])
        else:
            big += small
            big.sort()  # two ascending stretches: merged in one pass
        held[a], low[e], high[a] = big, a, e
    return found


def _best(runs: list[tuple[int, int, int]]) -> int | None:
    """Index of the run with the greatest length over period; ties by start, then period."""
    best = None
    for i, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def of_texts(whole: list[bytes], least: int, exponent: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text and its runs (start, length, period), by start and period."""
    words = [t.split() for t in whole]  # bytes are split at exactly the six bytes that end a word
    numbers = _Numbers()
    counts = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
    text = np.repeat(np.arange(len(words)), counts)
    runs: dict[int, list[tuple[int, int, int]]] = {}
    need = -(-least * (exponent - 1) // exponent)
    chosen = repeated(ids, text, need)
    if len(chosen):
        keep = np.isin(text, chosen)
        ids, text = ids[keep], text[keep]
        # Words of different texts are different, and so is what stands before their first words.
        _, ids = np.unique(ids + text * len(numbers), return_inverse=True)
        begins = np.append(True, text[1:] != text[:-1])
        left = np.where(begins, -1 - text, np.append(0, ids[:-1]))
        base = np.flatnonzero(begins)
        of = dict(zip(text[base].tolist(), base.tolist()))
        owner = text.tolist()
        for (start, end), period in maximal_pairs(ids, left, least, exponent).items():
            t = owner[start]
            runs.setdefault(t, []).append((start - of[t], end - start, period))
    for i, one in enumerate(words):
        yield one, sorted(runs.get(i, ()), key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        gone = bytearray(len(words))
        for start, length, period in runs:
            gone[start + period : start + length] = b"\x01" * (length - period)
        words = [w for w, g in zip(words, gone) if not g]
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _finder(key: str, least: int, exponent: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for part in steps(batch.column("text")):
                ids = batch.column(key).slice(at, len(part))
                at += len(part)
                n, runs, best, left = [], [], [], []
                for words, found in of_texts([t or b"" for t in part.cast(pa.binary()).to_pylist()], least, exponent):
                    n.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    top = _best(found)
                    best.append(None if top is None else runs[-1][top])
                    left.append(_collapsed(words, found))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(left, pa.binary()).cast(pa.string())],
                    [key, "n_words", "runs", "best", "collapsed"],
                )
        release()

    return run


def found(docs: DataFrame, least: int = 24, exponent: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs, best, collapsed) of every row: all runs, the one with the greatest exponent,
    and the text with each run cut down to its first period, words joined by one space."""
    if exponent < 2 or least < exponent:
        raise ValueError("a run has at least two periods and as many words")
    batches.small(docs.sparkSession)
    run = "struct<start:bigint,length:bigint,period:bigint>"
    return docs.select(key, F.col(text).alias("text") if key != "text" else F.col(text)).mapInArrow(
        _finder(key, least, exponent),
        f"`{key}` {docs.schema[key].dataType.simpleString()}, n_words long, runs array<{run}>, best {run}, collapsed string",
    )
