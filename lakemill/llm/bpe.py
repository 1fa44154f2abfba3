"""Byte-level BPE encoding and decoding.

A piece of text (one match of the split pattern) starts as its bytes. A segment tree over the byte
positions holds in each leaf the rank of the pair that begins there, and in each node the leftmost
smallest rank below it, so the root names the next merge. A merge changes the leaves of the merged
pair, of the pair before it and of the one that vanishes: three point updates up the tree.

Pieces of up to 64 bytes run side by side, one numpy row and tree each, and all do their next merge
at once; longer pieces use the same tree on a flat list, n log n for n bytes however long. A task
remembers the ids of pieces it has met, up to a bound.

Cases: null and empty texts have no ids and decode to no bytes; repeated rows are encoded alike; a
text of one very long piece costs n log n; extra input columns are left out.
"""

from __future__ import annotations

import base64
import itertools
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import batches
from lakemill.llm.words import release, steps

#: White space as Unicode defines it; Python's own notion has four control characters more.
_SPACE = "".join(
    regex.escape(chr(c), literal_spaces=True)
    for c in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
_NONE = np.int64(1) << 40
_SIDE_BY_SIDE = 64
#: Pieces a task remembers.
_CACHE = 300_000


#: A sign that is neither letter nor digit nor white space (private use).
_SIGN = "\ue000"


@lru_cache(maxsize=1)
def _later_signs() -> re.Pattern:
    """Code points that `regex` counts as letters or digits, but which Unicode 15.1 (the tables of the
    library, and of this Python) had not assigned: there they are other signs."""
    kind = regex.compile(r"[\p{L}\p{N}]")
    odd = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn" and kind.match(chr(c))]
    ranges: list[list[int]] = []
    for c in odd:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]" if ranges else r"(?!)")


def splitter(pattern: str) -> regex.Pattern:
    """The split pattern with white space spelled out."""
    spelled = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
    return regex.compile(spelled)


@dataclass
class Ranks:
    """A vocabulary: bytes by id, and for each pair of ids that merges the id of the whole."""

    tokens: list[bytes]
    pairs: np.ndarray
    merged: np.ndarray
    pattern: str

    @property
    def kind(self) -> str:
        """The narrowest unsigned integers that hold the ids."""
        return "<u2" if len(self.tokens) <= 1 << 16 else "<u4"

    @classmethod
    def load(cls, path: str, pattern: str) -> Ranks:
        """Read a rank file: lines of base64 bytes and rank. The rank is the id."""
        with open(path, "rb") as file:
            ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        return cls.of(ids, pattern)

    @classmethod
    def of(cls, ids: dict[bytes, int], pattern: str) -> Ranks:
        tokens = [b""] * (max(ids.values()) + 1)
        for token, at in ids.items():
            tokens[at] = token
        found = {
            ids[token[:k]] * len(tokens) + ids[token[k:]]: at
            for token, at in ids.items() for k in range(1, len(token)) if token[:k] in ids and token[k:] in ids
        }
        pairs = np.array(sorted(found), dtype=np.int64)
        return cls(tokens, pairs, np.array([found[p] for p in pairs.tolist()], dtype=np.int64), pattern)


class Encoder:
    def __init__(self, ranks: Ranks) -> None:
        self.ranks = ranks
        self.ids = {token: at for at, token in enumerate(ranks.tokens) if token}
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        self.split = splitter(ranks.pattern)
        self.known: dict[str, bytes] = {}
        self.single = [np.array([at], ranks.kind).tobytes() for at in range(len(ranks.tokens))]
        self._slots()

    @cached_property
    def lookup(self) -> dict[int, int]:
        return dict(zip(self.ranks.pairs.tolist(), self.ranks.merged.tolist()))

    def _slots(self) -> None:
        """Pairs in a table of slots, each pair in the first free one from its own on."""
        bits = max(4, (4 * len(self.ranks.pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_pair, self.slot_rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int64)
        pair, rank = self.ranks.pairs, self.ranks.merged
        at, self.reach = self._slot(pair), 0
        while len(pair):
            self.reach += 1
            free = self.slot_pair[at] < 0
            _, first = np.unique(at, return_index=True)
            put = np.zeros(len(pair), dtype=bool)
            put[first] = True
            put &= free
            self.slot_pair[at[put]], self.slot_rank[at[put]] = pair[put], rank[put]
            pair, rank, at = pair[~put], rank[~put], (at[~put] + 1) & (len(self.slot_pair) - 1)

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, _NONE if they do not merge (or one of them is -1)."""
        pair = np.where((left >= 0) & (right >= 0), left * len(self.ranks.tokens) + right, -2)
        at = self._slot(pair)
        held = self.slot_pair[at]
        rank = np.where(held == pair, self.slot_rank[at], _NONE)
        # Those whose slot holds another pair look further; an empty slot ends the search.
        rest = np.flatnonzero((held != pair) & (held >= 0))
        for _ in range(self.reach):
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) & (len(self.slot_pair) - 1)
            held = self.slot_pair[at[rest]]
            hit = held == pair[rest]
            rank[rest[hit]] = self.slot_rank[at[rest[hit]]]
            rest = rest[~hit & (held >= 0)]
        return rank

    def _side_by_side(self, pieces: list[bytes], leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of 2 to `leaves` bytes, end to end, and their numbers."""
        n = len(pieces)
        size = np.array([len(p) for p in pieces])
        place = np.arange(leaves)
        symbol = np.full((n, leaves + 1), -1, dtype=np.int64)
        inside = place[None, :] < size[:, None]
        symbol[:, :leaves][inside] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.minimum(place[None, :] + 1, size[:, None])
        after = np.where(after >= size[:, None], leaves, after)
        before = np.broadcast_to(place - 1, (n, leaves)).copy()
        tree = np.full((n, 2 * leaves), _NONE * leaves, dtype=np.int64)
        rank = self._pair(symbol[:, :leaves].reshape(-1), symbol[:, 1:].reshape(-1)).reshape(n, leaves)
        tree[:, leaves:] = np.where(rank < _NONE, rank * leaves + place[None, :], _NONE * leaves)
        for low in (1 << k for k in range(leaves.bit_length() - 2, -1, -1)):
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        live = inside.copy()
        row = np.flatnonzero(tree[:, 1] < _NONE * leaves)
        while len(row):
            whole, left = np.divmod(tree[row, 1], leaves)
            right = after[row, left]
            beyond, ahead = after[row, right], before[row, left]
            symbol[row, left] = whole
            after[row, left] = beyond
            live[row, right] = False
            linked = beyond < leaves
            before[row[linked], beyond[linked]] = left[linked]
            follow = self._pair(whole, np.where(linked, symbol[row, beyond], -1))
            lead = self._pair(np.where(ahead >= 0, symbol[row, np.maximum(ahead, 0)], -1), whole)
            led = ahead >= 0
            for rows, spot, rank in ((row, right, None), (row, left, follow), (row[led], ahead[led], lead[led])):
                value = _NONE * leaves if rank is None else np.where(rank < _NONE, rank * leaves + spot, _NONE * leaves)
                at = spot + leaves
                tree[rows, at] = value
                while (at := at >> 1)[:1].any():
                    tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
            row = row[tree[row, 1] < _NONE * leaves]
        return symbol[:, :leaves][live], live.sum(axis=1)

    def _long(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length, with the tree in a flat list."""
        n = len(piece)
        leaves = 1 << (n - 1).bit_length()
        symbol = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        base, find, none = len(self.ranks.tokens), self.lookup.get, 1 << 62
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            rank = find(symbol[i] * base + symbol[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(at: int, value: int) -> None:
            at += leaves
            tree[at] = value
            at >>= 1
            while at:
                low = min(tree[2 * at], tree[2 * at + 1])
                if tree[at] == low:
                    break
                tree[at] = low
                at >>= 1

        def value(left: int, right: int) -> int:
            rank = find(symbol[left] * base + symbol[right])
            return none if rank is None else rank * leaves + left

        while tree[1] != none:
            whole, left = divmod(tree[1], leaves)
            right = after[left]
            beyond, ahead = after[right], before[left]
            symbol[left], symbol[right], after[left] = whole, -1, beyond
            put(right, none)
            if beyond >= 0:
                before[beyond] = left
            put(left, value(left, beyond) if beyond >= 0 else none)
            if ahead >= 0:
                put(ahead, value(ahead, left))
        return [s for s in symbol if s >= 0]

    def learn(self, pieces: list[str]) -> None:
        """Work out the ids of pieces that are not known yet."""
        kind = self.ranks.kind
        wide = np.dtype(kind).itemsize
        sized: dict[int, tuple[list[str], list[bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            at = self.ids.get(data)
            if at is not None:
                self.known[piece] = self.single[at]
            elif len(data) > _SIDE_BY_SIDE:
                self.known[piece] = np.array(self._long(data), kind).tobytes()
            else:
                names, own = sized.setdefault(max(4, 1 << (len(data) - 1).bit_length()), ([], []))
                names.append(piece)
                own.append(data)
        for leaves, (names, own) in sized.items():
            step = (1 << 19) // leaves
            for low in range(0, len(own), step):
                flat, counts = self._side_by_side(own[low : low + step], leaves)
                data, ends = flat.astype(kind).tobytes(), (np.cumsum(counts) * wide).tolist()
                for piece, a, b in zip(names[low : low + step], [0, *ends], ends):
                    self.known[piece] = data[a:b]

    def pieces(self, text: str) -> list[str]:
        """Matches of the split pattern."""
        if text.isascii() or not _later_signs().search(text):
            return self.split.findall(text)
        # Cut where the pattern matches with plain signs in their place.
        return [text[m.start() : m.end()] for m in self.split.finditer(_later_signs().sub(_SIGN, text))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.pieces(text) for text in texts]
        pieces = set(itertools.chain.from_iterable(cut))
        missing = pieces.difference(self.known)
        if len(self.known) + len(missing) > _CACHE:  # the memory starts anew
            self.known, missing = {}, pieces
        self.learn(list(missing))
        known = self.known
        return [np.frombuffer(b"".join([known[p] for p in pieces]), self.ranks.kind) for pieces in cut]


_WORKER: dict[int, Encoder] = {}


def _encoder(ranks: Ranks) -> Encoder:
    mine = _WORKER.get(id(ranks))
    if mine is None or mine.ranks is not ranks:
        _WORKER.clear()  # one vocabulary at a time, however many jobs a worker serves
        mine = _WORKER[id(ranks)] = Encoder(ranks)
    return mine


def _ids(mine: Encoder, array: pa.Array) -> pa.Array:
    parts = []
    for step in steps(array):
        found = mine.encode([x or "" for x in step.to_pylist()])
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        parts.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32))))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _bytes(ranks: Ranks, array: pa.Array) -> pa.Array:
    token = ranks.tokens.__getitem__
    ids = array.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False)).tolist()
    return pa.array([b"".join(map(token, ids[a:b].tolist())) for a, b in zip([0, *ends], ends)], pa.binary())


def encoder(spark: SparkSession, ranks: Ranks):
    """UDF of a text: its ids."""
    batches.small(spark)
    sent = spark.sparkContext.broadcast(ranks)  # the vocabulary, a few MB whatever the input

    @F.arrow_udf("array<int>")
    def encode(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = _encoder(sent.value)
        for array in column:
            yield _ids(mine, array)
        mine.known = {}
        release()

    return encode


def decoder(spark: SparkSession, ranks: Ranks):
    """UDF of an array of ids: their bytes."""
    batches.small(spark)
    sent = spark.sparkContext.broadcast(ranks)

    @F.arrow_udf("binary")
    def decode(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in column:
            yield _bytes(sent.value, array)
        release()

    return decode


def encoded(docs: DataFrame, ranks: Ranks, *keep: str | Column, text: str = "text") -> DataFrame:
    """(the kept columns, ids) per input row."""
    return docs.select(*keep, encoder(docs.sparkSession, ranks)(F.col(text)).alias("ids"))


def decoded(rows: DataFrame, ranks: Ranks, ids: str = "ids") -> DataFrame:
    """The rows with `decoded`, the bytes of the ids."""
    return rows.withColumn("decoded", decoder(rows.sparkSession, ranks)(F.col(ids)))


def round_trip(docs: DataFrame, ranks: Ranks, *keep: str | Column, text: str = "text") -> DataFrame:
    """(the kept columns, ids, decoded) per input row, both by one worker: ids go to the engine once and
    do not come back to be decoded."""
    batches.small(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def both(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = _encoder(sent.value)
        for array in column:
            ids = _ids(mine, array)
            yield pa.StructArray.from_arrays([ids, _bytes(mine.ranks, ids)], ["ids", "decoded"])
        mine.known = {}
        release()

    return docs.select(*keep, both(F.col(text)).alias("_both")).select("*", "_both.*").drop("_both")
