"""Benchmark decontamination with SimHash over item-sized windows.

A benchmark item of n words is compared with windows of n words that share five words in a row with
it, and with the whole of each text that has fewer than n. What is compared are bags of words, each
word weighted by how often it occurs: an edited word costs one of n words, where it would cost five
of n - 4 shingles of five words. Fingerprints are 64-bit SimHashes of these bags. The index holds the
fingerprints of the items by eight blocks of eight bits: two fingerprints within a Hamming distance
of 23 differ by at most two bits in some block, so listing every item under all block values within
two bits of its own finds all fingerprints within that radius. What is found is verified by the
weighted Jaccard similarity. An item under five words is found only as a whole.

At a similarity of 0.8 an item of 18 words may have two words replaced, inserted or deleted, one of
nine words one. Two edits leave three runs, of which one has five words if the item has 15.

At a similarity of exactly 0.8 the fingerprints differ by 9.7 bits on average (deviation 2.9), so
the radius misses about two in a million such windows, and fewer of more similar ones.

Words are lower-cased and cut at white space and ASCII punctuation. Cases: items and documents that
are null or empty match nothing; repeated items and rows are each reported; a null item_id is
reported as null; a very long text is searched alone, in memory that grows with its length;
of equally similar windows the first is reported; an empty benchmark gives no matches;
other input columns are left out (`matches`) or kept (`clean`).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm import batches
from lakemill.llm.columns import spare
from lakemill.llm.words import PLAIN, Words, mixed, release, steps

#: Words in a row that a window shares with the item.
SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23
#: Bytes of benchmark text that one index may hold; a larger benchmark is searched in several passes.
INDEX_BYTES = 16 << 20

MATCH = T.ArrayType(
    T.StructType([
        T.StructField("item", T.LongType()), T.StructField("similarity", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
    ])
)

_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_NEAR = [np.flatnonzero(np.bitwise_count(np.arange(256) ^ v) <= 2) for v in range(256)]


def _signs(units: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each word or shingle."""
    return np.where(mixed(units)[:, None] & _BITS[None, :], 1, -1).astype(np.int32)


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.where(sums > 0, _BITS[None, :], np.uint64(0)).sum(axis=1, dtype=np.uint64)


def simhash(bag: np.ndarray) -> int:
    """Fingerprint of a bag; each occurrence counts."""
    return int(_packed(_signs(bag).sum(axis=0, keepdims=True))[0])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags."""
    x, y = Counter(a.tolist()), Counter(b.tolist())
    both = sum((x & y).values())
    return both / (len(a) + len(b) - both)


class _Sized:
    """The items of one size, with the block index of their fingerprints. `shingles` are theirs of five words."""

    def __init__(self, bags: list[tuple[int | None, np.ndarray]], runs: list[np.ndarray] | None = None) -> None:
        self.bags = bags
        self.sets = [np.unique(bag) for _, bag in bags]
        self.runs = [np.unique(x) for x in runs] if runs else self.sets  # shingles of each item
        self.shingles = np.unique(np.concatenate(self.runs))
        self.prints = np.array([simhash(bag) for _, bag in bags], dtype=np.uint64)
        self.blocks: list[list[np.ndarray]] = []
        for block in range(8):
            own = ((self.prints >> np.uint64(8 * block)) & np.uint64(255)).astype(int)
            listed: list[list[int]] = [[] for _ in range(256)]
            for item, value in enumerate(own):
                for near in _NEAR[value]:
                    listed[near].append(item)
            self.blocks.append([np.array(x, dtype=np.int64) for x in listed])

    def within(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of every pair of fingerprints within the radius."""
        pairs = []
        for block in range(8):
            value = ((prints >> np.uint64(8 * block)) & np.uint64(255)).astype(int)
            lists = [self.blocks[block][v] for v in value]
            window = np.repeat(np.arange(len(prints)), [len(x) for x in lists])
            if len(window):
                pairs.append(window * len(self.bags) + np.concatenate(lists))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        window, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.bags))
        near = np.bitwise_count(prints[window] ^ self.prints[item]) <= radius
        return window[near], item[near]


class Index:
    """Benchmark items by size. `items` are (item, text)."""

    def __init__(self, items: list[tuple[int, str | None]], threshold: float = THRESHOLD, radius: int = RADIUS) -> None:
        if radius >= 24:
            raise ValueError("eight blocks within two bits each guarantee a radius of at most 23")
        self.threshold, self.radius = threshold, radius
        words = Words.of(pa.array([t for _, t in items], pa.string()), lower="all", ends=PLAIN)
        hashes = words.hashes()
        windows = {size: words.windows(size, hashes) for size in range(1, SHINGLE + 1)}
        sized: dict[int, list[tuple[int | None, np.ndarray]]] = {}
        shared: dict[int, list[np.ndarray]] = {}
        for i, n in enumerate(words.counts()):
            if n:
                at, shingle = windows[min(int(n), SHINGLE)]
                low, high = np.searchsorted(at, words.first[i : i + 2])
                bag = shingle[low:high] if n < SHINGLE else hashes[words.first[i] : words.first[i + 1]]
                sized.setdefault(int(n), []).append((items[i][0], bag))
                shared.setdefault(int(n), []).append(shingle[low:high])
        self.sizes = {n: _Sized(bags, shared[n]) for n, bags in sorted(sized.items())}
        self.shingles = np.unique(np.concatenate([s.shingles for n, s in self.sizes.items() if n >= SHINGLE] or [np.zeros(0, np.uint64)]))

    @staticmethod
    def _member(table: np.ndarray, values: np.ndarray) -> np.ndarray:
        spot = np.searchsorted(table, values)
        return table[np.minimum(spot, len(table) - 1)] == values if len(table) else np.zeros(len(values), bool)

    def search(self, array: pa.Array) -> list[tuple[int, int | None, float, int, int]]:
        """(text, item, similarity, first word, words) of the best window of each matching item."""
        words = Words.of(array, lower="all", ends=PLAIN)
        hashes = words.hashes()
        every = np.arange(len(hashes))
        at, shingle = words.windows(SHINGLE, hashes)
        run = np.zeros(len(hashes), np.uint64)  # the shingle that begins at each word
        run[at] = shingle
        anchors = np.flatnonzero(self._member(self.shingles, shingle))
        best: dict[tuple[int, int], tuple] = {}
        for size, sized in self.sizes.items():
            if size < SHINGLE:
                few, whole = words.windows(size, hashes)
                start = np.flatnonzero(self._member(sized.shingles, whole))
                for low in range(0, len(start), 4096):
                    self._verified(words, few, whole, start[low : low + 4096], 1, size, sized, best, whole)
                continue
            own = at[anchors[self._member(sized.shingles, shingle[anchors])]]
            if not len(own):
                continue
            self._shorter(words, hashes, own, size, sized, best, run)
            start = np.unique((own[:, None] - np.arange(size - SHINGLE + 1)[None, :]).reshape(-1))
            start = start[(start >= 0) & (start + size <= len(hashes))]
            start = start[words.text[start] == words.text[start + size - 1]]
            for low in range(0, len(start), 4096):
                self._verified(words, every, hashes, start[low : low + 4096], size, size, sized, best, run)
        return [(text, sized_item, *found) for (text, _, sized_item), found in sorted(best.items(), key=lambda x: x[0][:2])]

    def _shorter(self, words: Words, hashes, own, size: int, sized: _Sized, best: dict, run) -> None:
        """Texts with fewer words than the items of this size, as one window each."""
        n = words.counts()
        for text in np.unique(words.text[own]):
            if n[text] >= size or n[text] < self.threshold * size - 1e-9:
                continue
            low, high = words.first[text : text + 2]
            bag = hashes[low:high]
            _, item = sized.within(np.array([simhash(bag)], dtype=np.uint64), self.radius)
            for k in item:
                if not self._member(sized.runs[k], run[low : high - SHINGLE + 1]).any():
                    continue
                value = similarity(bag, sized.bags[k][1])
                key = (int(text), (size, int(k)), sized.bags[k][0])
                if value >= self.threshold and value > best.get(key, (0.0,))[0]:
                    best[key] = (value, 0, int(n[text]))

    def _verified(self, words: Words, at, unit, start, width: int, size: int, sized: _Sized, best: dict, run) -> None:
        """Windows of `width` units, words or shingles, from each start; `at` is the first word of a unit, `run` the shingle there."""
        if not len(start):
            return
        spots = start[:, None] + np.arange(width)[None, :]
        used = np.unique(spots)
        sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_signs(unit[used]), axis=0, dtype=np.int32)])
        first = np.searchsorted(used, start)
        window, item = sized.within(_packed(sums[first + width] - sums[first]), self.radius)
        for k in np.unique(item):
            mine = window[item == k]
            held = self._member(sized.sets[k], unit[spots[mine]].reshape(-1)).reshape(-1, width).sum(axis=1)
            # Counting a unit as often as the window holds it bounds what the two bags share.
            for w in mine[held >= self.threshold * (2 * width - held) - 1e-9]:
                if not self._member(sized.runs[k], run[start[w] : start[w] + max(1, size - SHINGLE + 1)]).any():
                    continue
                value = similarity(unit[spots[w]], sized.bags[k][1])
                text = int(words.text[at[start[w]]])
                key = (text, (size, int(k)), sized.bags[k][0])
                if value >= self.threshold and value > best.get(key, (0.0,))[0]:
                    best[key] = (value, int(at[start[w]] - words.first[text]), size)


def _search(index: Index):
    @F.arrow_udf(MATCH)
    def search(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in column:
            rows: list[list[dict]] = []
            for step in steps(array):
                found: list[list[dict]] = [[] for _ in range(len(step))]
                for text, item, value, first, n in index.search(step):
                    found[text].append({"item": item, "similarity": value, "first_word": first, "n_words": n})
                rows += found
            yield pa.array(rows, pa.list_(pa.struct([
                ("item", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64()),
            ])))
        release()

    return search


def _indexes(benchmark: DataFrame, item: str, text: str, threshold: float, limit: int) -> Iterator[Index]:
    """Indexes of at most about `limit` bytes of items each; their number follows the benchmark's size."""
    rows = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-int(total) // limit))
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part) if parts > 1 else rows
        yield Index([(r["item"], r["text"]) for r in mine.orderBy("item", "text").collect()], threshold)


def found(
    texts: Column, benchmark: DataFrame, item: str = "item_id", text: str = "text", threshold: float = THRESHOLD,
    limit: int = INDEX_BYTES,
) -> Column:
    """The matches (item, similarity, first_word, n_words) of each text as an array, never null."""
    batches.small(benchmark.sparkSession)
    parts = [_search(index)(texts) for index in _indexes(benchmark, item, text, threshold, limit)]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, item, similarity, first_word, n_words): one row per document and item found in it."""
    rows = docs.select(F.col(key), found(F.col(text), benchmark, **options).alias("_m"))
    return rows.select(key, F.explode("_m").alias("_m")).select(key, "_m.*")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The input rows in which no benchmark item is found, all columns kept."""
    name = spare(docs, "_matches")
    return docs.withColumn(name, found(F.col(text), benchmark, **options)).where(F.size(name) == 0).drop(name)
