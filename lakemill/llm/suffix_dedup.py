"""Repeated passages by longest previous factors of a distributed suffix order.

A byte goes if a string of `length` bytes that covers it also starts somewhere else, in another text
or in the same one. The longest previous factor of a position is the longest string that starts there
and at an earlier position; with suffixes in order, the earlier position is the previous or the next
smaller one beside it. Suffixes are compared up to `length` bytes and ties stand in text order, so the
previous smaller position of a suffix that has an earlier copy of `length` bytes is the entry before it,
and a later copy is the entry after it. `keep="first"` removes what has an earlier copy and keeps the
first one; `keep="none"` removes what has an earlier or a later one.

No task sees all suffixes, so those that can be equal must meet. Each string of `length` bytes elects
an anchor, its leftmost k-gram of least hash; equal strings elect equal anchors. Consecutive
strings of one anchor form a strip, at most length - k + 1 strings long.

1. Strips of all texts are reduced to (anchor, content) hashes; anchors that occur once in the whole
   table can hold no repeat and go.
2. A content that occurs twice is a repeat as a whole. Where an anchor stands in different contents,
   one copy of each is cut out of its text; the contents of an anchor are sorted as suffixes by prefix
   doubling in numpy and their factors read off.
3. An anchor with more than `BLOCK` different contents is cut into blocks. A block hands on one copy
   of each of its strings, packed by shares of their digests, and a share finds equal ones: nothing is
   dropped.
4. The marked strings travel back to the texts that hold them, and the covered bytes are cut out there.

Texts move twice, by the hash of the text, and only narrow rows otherwise. Joins are plain equi-joins
of tables, which the engine may split where one key is frequent. Anchors and contents are told apart by
two 64-bit hashes, texts by one (texts with equal hashes stay apart, as contents are looked up in the
text itself).

Cases: null and empty texts and texts under `length` bytes lose nothing; very long texts are worked on in
pieces that overlap, so memory per text is a few times its size; a text is UTF-8 bytes, and what is kept
may cut a character in two, so it is binary; rows without a key come first; rows equal in key and text
count as copies of each other under keep="none" and as one document under keep="first"; an empty table
gives an empty result; other input columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm import batches
from lakemill.llm.merkle import ranked
from lakemill.llm.words import STEP, _Powers, mixed, release, steps, texts
from lakemill.session import durable

#: Different contents of an anchor that one task compares at once.
BLOCK = 512
#: Bytes of contents that are sorted together.
_SORTED = 1 << 20
_PLACE = np.uint64(0xFFFFFFFF)
_SIZE = np.uint64(0xD6E8FEB86659FD93)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


class Strips:
    """Strips of the texts in `data`; text t is `data[at[t]:at[t + 1]]`. Those that begin in `low` to
    `high` count, if a range is given."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int, low: int = 0, high: int | None = None) -> None:
        gram = max(1, length // 3)
        size = len(data)
        self.start = self.count = self.text = np.zeros(0, np.int64)
        self.anchor = self.content = np.zeros(0, np.int64)
        if size < length:
            return
        up, down = _Powers.of(size + 1)
        prefix = np.zeros(size + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:size], out=prefix[1:])
        n = size - gram + 1
        grams = prefix[gram:] - prefix[:-gram]
        grams *= down[:n]
        key = grams * _SIZE
        key &= ~_PLACE
        key |= np.arange(n, dtype=np.uint64)
        place = _least(key, length - gram + 1) & _PLACE
        inside = np.zeros(len(place), bool)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= length:
                inside[a : b - length + 1] = True
        new, last = inside.copy(), inside.copy()
        changed = place[1:] != place[:-1]
        new[1:] &= changed | ~inside[:-1]
        last[:-1] &= changed | ~inside[1:]
        start, end = np.flatnonzero(new), np.flatnonzero(last)
        if high is not None:
            held = (start >= low) & (start < high)
            start, end = start[held], end[held]
        self.start, self.count = start, end - start + 1
        self.text = np.searchsorted(at, start, side="right") - 1
        self.anchor = mixed(grams[place[start].astype(np.int64)]).view(np.int64)
        content = (prefix[end + length] - prefix[start]) * down[start] + self.count.astype(np.uint64) * _SIZE
        self.content = mixed(content).view(np.int64)


def _pieces(data: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[int, Strips]]:
    """(offset, strips) of a step; a text far longer than a step is cut into overlapping pieces."""
    if len(data) <= 4 * STEP:
        yield 0, Strips(data, at, length)
        return
    for low in range(0, len(data), STEP):
        a, b = max(0, low - 1), min(len(data), low + STEP + 2 * length)
        cut = np.unique(np.clip(at, a, b)) - a
        yield a, Strips(data[a:b], cut, length, low - a, low - a + STEP)


def _whole(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, start, count, anchor, content) of all strips of a step."""
    parts = [(a + s.start, s.count, s.anchor, s.content) for a, s in _pieces(data, at, length)]
    start, count, anchor, content = (np.concatenate(x) for x in zip(*parts))
    return np.searchsorted(at, start, side="right") - 1, start, count, anchor, content


def _occurrences(length: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for part in steps(batch.column("text")):
                ids = batch.column("tid").slice(at, len(part)).to_numpy()
                at += len(part)
                text, _, _, anchor, content = _whole(*texts(part), length)
                order = np.lexsort((content, anchor, text))
                text, anchor, content = text[order], anchor[order], content[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[first]), pa.array(content[first]), pa.array(ids[text[first]]), pa.array(times.astype(np.int64))],
                    ["anchor", "content", "tid", "times"],
                )
        release()

    return run


_CUT = "anchor long, content long, block int, blocks int, tid long, place long, body binary"


def _cutter(length: int):
    """Cut the wanted contents out of each text; a text that follows itself is cut once."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in rows:
            at = 0
            for part in steps(batch.column("text")):
                wanted, ids = batch.column("wanted").slice(at, len(part)), batch.column("tid").slice(at, len(part)).to_pylist()
                at += len(part)
                whole = part.to_pylist()
                fresh = np.array([t != (whole[i - 1] if i else before) for i, t in enumerate(whole)])
                before = whole[-1]
                data, edges = texts(part)
                text, start, count, anchor, content = _whole(data, edges, length)
                owner, (a, c, block, blocks) = _listed(wanted, ["anchor", "content", "block", "blocks"])
                found = _matched((owner, a, c), (text, anchor, content))
                # The first place of a content in its text.
                keep = fresh[owner] & (found >= 0)
                raw = data.tobytes()
                which = found[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a[keep]), pa.array(c[keep]), pa.array(block[keep].astype(np.int32)), pa.array(blocks[keep].astype(np.int32)),
                        pa.array([ids[t] for t in text[which]], pa.int64()), pa.array(start[which] - edges[text[which]]),
                        pa.array([raw[s : s + n + length - 1] for s, n in zip(start[which].tolist(), count[which].tolist())], pa.binary()),
                    ],
                    ["anchor", "content", "block", "blocks", "tid", "place", "body"],
                )
        release()

    return run


def _listed(column: pa.Array, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row of each entry of a list column, and fields of the entries as arrays."""
    sizes = np.array([0 if n is None else n for n in pc.list_value_length(column).to_pylist()], np.int64)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), sizes), [flat.field(n).to_numpy(zero_copy_only=False) for n in names]


def _matched(asked: tuple[np.ndarray, ...], there: tuple[np.ndarray, ...]) -> np.ndarray:
    """For each asked (text, anchor, content) the first strip that is it, or -1."""
    out = np.full(len(asked[0]), -1)
    if not len(asked[0]) or not len(there[0]):
        return out
    keys = [np.concatenate(pair) for pair in zip(there, asked)]
    order = np.lexsort((np.arange(len(keys[0])), *keys[::-1]))  # strips before questions, in text order
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    n = len(there[0])
    asks = order >= n
    out[order[asks] - n] = np.where(lead[asks] < n, lead[asks], -1)
    return out


def ranks(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order classes of the first `length` bytes at every position that has them, by prefix doubling:
    two arrays whose pairs compare as the strings do."""
    size, have = 1, data.astype(np.uint64)
    while size < 8 and 2 * size <= length:  # the first steps fit one machine word
        have = (have << np.uint64(8 * size)) | np.append(have, np.zeros(size, np.uint64))[size:]
        size *= 2
    rank = _dense(have)
    while 2 * size <= length:
        later = np.append(rank, np.zeros(size, np.uint64))[size:]
        rank = _dense((rank << np.uint64(32)) | later)
        size *= 2
    n = len(data) - length + 1
    return rank[:n], rank[length - size : length - size + n]


def _dense(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values)
    ahead = values[order]
    new = np.zeros(len(values), np.uint64)
    new[1:] = ahead[1:] != ahead[:-1]
    out = np.empty(len(values), np.uint64)
    out[order] = np.cumsum(new)
    return out


def factors(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(body, offset, earlier, later, class) of every string of `length` bytes inside the bodies.

    earlier: its longest previous factor has `length` bytes; later: the same towards later positions.
    Positions ascend in the order of the bodies.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    first, second = ranks(np.frombuffer(b"".join(bodies), np.uint8), length)
    counts = np.maximum(sizes - length + 1, 0)
    body = np.repeat(np.arange(len(bodies)), counts)
    offset = np.arange(len(body)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = edges[body] + offset
    key = (first[at] << np.uint64(32)) | second[at]
    order = np.argsort(key, kind="stable")  # suffixes in order, ties in text order
    ahead = key[order]
    same = np.concatenate([[False], ahead[1:] == ahead[:-1]])
    earlier, later, cls = np.empty(len(at), bool), np.empty(len(at), bool), np.empty(len(at), np.int64)
    earlier[order] = same
    later[order] = np.append(same[1:], False)
    cls[order] = np.cumsum(~same)
    return body, offset, earlier, later, cls


_MARK = "anchor long, content long, offsets array<int>"
_HANDED = np.dtype([("anchor", "<i8"), ("digest", "<i8"), ("content", "<i8"), ("turn", "<i8"), ("at", "<i8"), ("offset", "<i4")])


def _changes(rows: np.ndarray, *names: str) -> np.ndarray:
    """Whether a row differs from the one before in some field."""
    return np.append(True, np.logical_or.reduce([rows[n][1:] != rows[n][:-1] for n in names]))[: len(rows)]


def _comparer(first: bool):
    """Strings of a share that several blocks hold; all of them, or all but the first."""

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(x, _HANDED) for batch in batches_ for x in batch.column("handed").to_pylist()]
        if not held:
            return
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows["at"], rows["turn"], rows["digest"], rows["anchor"]))]
        new = _changes(rows, "anchor", "digest")
        sizes = np.diff(np.append(np.flatnonzero(new), len(rows)))
        rows = rows[~new if first else np.repeat(sizes > 1, sizes)]
        rows = rows[np.lexsort((rows["content"], rows["anchor"]))]
        begin = np.flatnonzero(_changes(rows, "anchor", "content"))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows["anchor"][begin]), pa.array(rows["content"][begin]),
                pa.ListArray.from_arrays(pa.array(np.append(begin, len(rows)).astype(np.int32)), pa.array(rows["offset"])),
            ],
            ["anchor", "content", "offsets"],
        )

    return run


def _sorter(length: int, first: bool, shares: int):
    """Factors of the contents of each anchor; strings of an anchor in several blocks are handed on, one
    of each, packed by shares of their digests."""
    kind = pa.schema([
        ("anchor", pa.int64()), ("content", pa.int64()), ("offsets", pa.list_(pa.int32())), ("share", pa.int32()), ("handed", pa.binary()),
    ])

    def solved(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        body, offset, earlier, later, cls = factors([r[4] for r in rows], length)
        gone = earlier if first else earlier | later
        hit = np.flatnonzero(gone)
        owner, begin = np.unique(body[hit], return_index=True)
        anchor, content = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor[owner]), pa.array(content[owner]),
                pa.ListArray.from_arrays(pa.array(np.append(begin, len(hit)).astype(np.int32)), pa.array(offset[hit].astype(np.int32))),
                pa.nulls(len(owner), pa.int32()), pa.nulls(len(owner), pa.binary()),
            ],
            schema=kind,
        )
        split = np.array([r[3] > 1 for r in rows])
        lead = np.flatnonzero(split[body] & ~earlier)
        if len(lead):
            raw = (rows[b][4][o : o + length] for b, o in zip(body[lead].tolist(), offset[lead].tolist()))
            handed = np.empty(len(lead), _HANDED)
            handed["digest"] = np.frombuffer(b"".join([hashlib.blake2b(x, digest_size=8).digest() for x in raw]), np.int64)
            turn, place = (np.array([r[i] for r in rows], np.int64)[body[lead]] for i in (6, 5))
            for name, value in zip(("anchor", "content", "turn", "at", "offset"), (anchor[body[lead]], content[body[lead]], turn, place + offset[lead], offset[lead])):
                handed[name] = value
            share = handed["digest"].astype(np.uint64) % np.uint64(shares)
            order = np.argsort(share, kind="stable")
            ends = np.searchsorted(share[order], np.arange(shares + 1))
            some = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), kind.field(2).type),
                    pa.array(some.astype(np.int32)), pa.array([handed[order[ends[k] : ends[k + 1]]].tobytes() for k in some], pa.binary()),
                ],
                schema=kind,
            )

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, before = 0, None
        for batch in batches_:
            for row in zip(*(batch.column(n).to_pylist() for n in ("anchor", "content", "block", "blocks", "body", "place", "turn"))):
                # Blocks of one anchor stay apart: their order is not that of the texts.
                if row[:1] + row[2:3] != before and (size >= _SORTED or rows and rows[-1][3] > 1):
                    yield from solved(rows)
                    rows, size = [], 0
                if not rows or row[:2] != rows[-1][:2]:  # one content cut from two copies of its text
                    rows.append(row)
                    size += len(row[4])
                before = row[:1] + row[2:3]
        if rows:
            yield from solved(rows)
        release()

    return run


_KEPT = "n_bytes long, n_removed long, n_spans long, kept binary"


def _remover(length: int, key: str):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for part in steps(batch.column("text")):
                ids = batch.column(key).slice(at, len(part))
                leads = batch.column("lead").slice(at, len(part)).to_numpy(zero_copy_only=False).astype(bool)
                # Copies follow each other and share their marks: each text is worked on once.
                code = part.dictionary_encode().indices.to_numpy() * 2 + leads
                _, one, of = np.unique(code, return_index=True, return_inverse=True)
                chosen = pa.array(one)
                marks, lead, part_ = batch.column("marks").slice(at, len(part)).take(chosen), leads[one], part.take(chosen)
                at += len(part)
                part = part_
                data, edges = texts(part)
                sizes = np.diff(edges)
                owner, (a, c, mine) = _listed(marks, ["anchor", "content", "mine"])
                gone = np.zeros(len(data), bool)
                if len(owner):
                    text, start, count, anchor, content = _whole(data, edges, length)
                    offsets = marks.flatten().field("offsets")
                    gone = _covered(
                        len(data), length, (text, start, count, anchor, content), (owner, a, c), mine.astype(bool) & lead[owner], offsets
                    )
                total = np.concatenate([[0], np.cumsum(gone)])
                opened = gone.copy()
                opened[1:] &= ~gone[:-1]
                opened[edges[:-1][sizes > 0]] = gone[edges[:-1][sizes > 0]]
                spans = np.concatenate([[0], np.cumsum(opened)])
                raw, left = data[~gone].tobytes(), edges - total[edges]
                kept = [raw[x:y] for x, y in zip(left[:-1].tolist(), left[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(sizes[of]), pa.array(np.diff(total[edges])[of]), pa.array(np.diff(spans[edges])[of]),
                        pa.array([kept[k] for k in of.tolist()], pa.binary()),
                    ],
                    [key, "n_bytes", "n_removed", "n_spans", "kept"],
                )
        release()

    return run


def _covered(size: int, length: int, strips: tuple, asked: tuple, mine: np.ndarray, offsets: pa.Array) -> np.ndarray:
    """Bytes under marked strings. A mark that is `mine` spares the first place of its content but for
    the offsets it lists; every other place goes as a whole."""
    text, start, count, anchor, content = strips
    order = np.lexsort((start, content, anchor, text))
    keys = [k[order] for k in (text, anchor, content)]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    marked, spared = np.zeros(int(new.sum()), bool), np.zeros(int(new.sum()), bool)
    found = _matched(asked, (text, anchor, content))
    hit = found >= 0
    marked[group[found[hit]]] = True
    spared[group[found[hit & mine]]] = True
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    full = np.flatnonzero(marked[group] & ~(spared[group] & first))
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, start[full], 1)
    np.add.at(change, start[full] + count[full] + length - 1, -1)
    part = np.flatnonzero(hit & mine)
    if len(part):
        lists = offsets.take(pa.array(part))
        which = np.repeat(found[part], np.array([n or 0 for n in pc.list_value_length(lists).to_pylist()], np.int64))
        at = start[which] + lists.flatten().to_numpy(zero_copy_only=False)
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0


def removed(docs: DataFrame, length: int = 200, keep: str = "first", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row of `docs`; kept is what is left of the text."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep is 'first' or 'none', not {keep!r}")
    spark, first = docs.sparkSession, keep == "first"
    batches.small(spark)
    sides = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tid")
    )
    long = rows.where(F.octet_length("text") >= length)
    strips = durable(
        long.select("tid", "text").mapInArrow(_occurrences(length), "anchor long, content long, tid long, times long"), "strips"
    )
    # What is joined to a long table is written first, so that both sides of the join are plain shuffles
    # and the engine may split a frequent key of the long one.
    shared = durable(
        strips.groupBy(F.col("anchor").alias("_a"))
        .agg(F.sum("times").alias("n"), (F.min("content") != F.max("content")).alias("varied"))
        .where("n > 1").select("_a", "varied"),
        "anchors",
    )
    seen = durable(strips.join(shared, F.col("anchor") == F.col("_a")).select("anchor", "content", "tid", "times", "varied"), "repeats")
    turn = F.lit(0).cast("long").alias("turn")
    if first:
        oldest = long.groupBy(F.col("tid").alias("_t")).agg(F.min("id").alias("oldest"), F.bool_or(F.col("id").isNull()).alias("blank"))
        oldest = oldest.select("_t", F.when(~F.col("blank"), F.col("oldest")).alias("oldest"))
        turns = ranked(oldest.withColumn("g", F.lit(0).cast("long")), ["oldest", "_t"]).select("_t", "oldest", F.col("at").alias("turn"))
        held = seen.join(turns, F.col("tid") == F.col("_t")).drop("_t")
        lead = F.min(F.struct("turn", "tid"))["tid"]
    else:
        held, lead = seen, F.min("tid")
    contents = durable(
        held.groupBy("anchor", "content").agg(F.sum("times").alias("times"), F.first("varied").alias("varied"), lead.alias("tid")), "contents"
    )
    open_ = contents.where("varied")
    blocks = durable(
        open_.groupBy(F.col("anchor").alias("_a")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks"
    )
    wanted = durable(
        open_.join(blocks, F.col("anchor") == F.col("_a"))
        .withColumn("block", F.pmod(F.xxhash64("content"), "blocks").cast("int"))
        .groupBy("tid").agg(F.collect_list(F.struct("anchor", "content", "block", "blocks")).alias("wanted")),
        "wanted",
    )
    bodies = long.select(F.col("tid").alias("_t"), "text").join(wanted, F.col("tid") == F.col("_t")).select("tid", "text", "wanted")
    cut = bodies.mapInArrow(_cutter(length), _CUT)
    cut = cut.join(turns, F.col("tid") == F.col("_t")).drop("_t") if first else cut.select("*", turn)
    order = ["turn", "place"] if first else ["content"]
    cut = cut.repartition(sides, "anchor", "block").sortWithinPartitions("anchor", "block", *order)
    found = durable(cut.mapInArrow(_sorter(length, first, sides), f"{_MARK}, share int, handed binary"), "factors")
    between = found.where("handed IS NOT NULL").select("share", "handed").repartition(sides, "share").mapInArrow(_comparer(first), _MARK)
    marks = found.where("handed IS NULL").select("anchor", "content", "offsets").unionByName(between)
    marks = marks.groupBy("anchor", "content").agg(F.flatten(F.collect_list("offsets")).alias("offsets"))
    # Of a content that one place spares, the owner's first place loses the listed strings only.
    owner = F.col("tid") if first else F.when(F.col("times") == 1, F.col("tid"))
    verdict = durable(
        contents.join(marks, ["anchor", "content"], "left").where("times > 1 OR offsets IS NOT NULL")
        .select(F.col("anchor").alias("_a"), F.col("content").alias("_c"), owner.alias("owner"), "offsets"),
        "verdicts",
    )
    mine = F.coalesce(F.col("tid") == F.col("owner"), F.lit(False))
    told = durable(
        seen.join(verdict, (F.col("anchor") == F.col("_a")) & (F.col("content") == F.col("_c")))
        .groupBy(F.col("tid").alias("_t"))
        .agg(F.collect_list(F.struct("anchor", "content", mine.alias("mine"), F.when(mine, F.col("offsets")).alias("offsets"))).alias("marks")),
        "marks",
    )
    last = rows.join(told, F.col("tid") == F.col("_t"), "left").drop("_t")
    if first:
        last = last.join(oldest, F.col("tid") == F.col("_t"), "left").withColumn("lead", F.col("id").eqNullSafe(F.col("oldest")))
    else:
        last = last.withColumn("lead", F.lit(True))
    last = last.select(F.col("id").alias(key), "text", "lead", "marks")
    return last.mapInArrow(_remover(length, key), f"`{key}` {docs.schema[key].dataType.simpleString()}, {_KEPT}")
