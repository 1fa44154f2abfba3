"""Language-model scoring with a weighted backoff automaton.

Tokens are the words of a text (A-Z lower-cased) and one end. Every n-gram of the training texts up
to `order` words, seen at least `least` times if longer than one, is a state. Its arcs lead to the
n-grams that extend it, its failure arc to the same n-gram without its first word. With absolute
discounting D, an arc from context v to word w weighs (c(vw) - D) / c(v) plus what the failure arc
leaves for w; the failure arc weighs l(v) = 1 - sum over the arcs of (c - D) / c(v). The state
without words gives (c(w) + 0.1) / (N + 0.1 (V + 1)), so unseen words have a probability too and
the probabilities after any context sum to one.

The n-grams are cut into parts by ranges of their hash, and a shuffle brings the counts of a part,
summed by each task beforehand and packed, into one task. The parts are counted in two rounds over
the texts, so that no more than half of the packed counts is on disk at a time. A last pass over the
training texts fetches the count c of each n-gram and adds 1 - D / c to its context: over all
occurrences that is the sum of c - D over the arcs, so contexts need not travel with the n-grams. An
n-gram seen once has one arc of count 1 at most: if all n-grams are states, its failure arc weighs D
wherever it can be a context, and else 1, so of these n-grams only the hashes are stored.

The automaton grows with the corpus, so it is neither gathered nor broadcast: each part is a sorted
flat file in the shared folder (and one of failure weights). A task scores some MB of texts at a time
in two steps. `Automaton.fetched` reads from each part, in the order of its file, the states that the
texts can reach, and numbers them: a piece of the automaton with counts, failure arcs and failure
weights, in memory. `Piece.walked` traverses it from left to right, for many texts side by side: a
lane carries one state, the longest n-gram that ends at its place. On the next word it takes the
state's arc if there is one, follows the failure arcs to the state without words, adding the share of
each on the way, and goes on from the longest n-gram found. Texts of more than LANE words are cut into
several lanes. A lane that does not begin its text begins `order` - 1 words earlier from the state
without words: no state is longer than that, so at its first own word it is in the state of the whole walk.

Fetching is most of the work, and n-grams seen once are most of the states. A caller may tell which texts were
learned from: if all n-grams are states, one of those texts that is not among the states seen more than
once was seen once, and it is not looked for at all if its context or its end was.

Cases: null and empty texts are one token, the end; without training rows every token has
probability one in the base and in the model; repeated rows count as often as they occur in
training and score alike; a very long text is worked on alone, in memory that grows with its length;
extra input columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm import batches
from lakemill.llm.files import Writer, fresh, mapped
from lakemill.llm.words import Words, mixed, release, steps
from lakemill.session import new_path

#: Of `fit`, unless a caller chooses; the registered query keeps all n-grams up to three words.
ORDER = 2
LEAST = 2
DISCOUNT = 0.5
ADDED = 0.1

BEGIN, END = mixed(np.array([0xBE61, 0xE0D], dtype=np.uint64)) | np.uint64(1)

#: Passes over the texts that count the n-grams, a share of the parts each.
ROUNDS = 2

#: n-grams a task sums before it hands them on.
_HELD = 3_000_000

#: Bytes of text for which the states are fetched at once.
FETCHED = 4 << 20

#: Words of a lane.
LANE = 64


def gathered(arrays: Iterator[pa.Array], limit: int = FETCHED) -> Iterator[pa.Array]:
    """The same texts in arrays of about `limit` bytes; whole texts always."""
    for (texts,) in gathered_rows(((array,) for array in arrays), limit):
        yield texts


def gathered_rows(columns: Iterator[tuple[pa.Array, ...]], limit: int = FETCHED) -> Iterator[tuple[pa.Array, ...]]:
    """The same rows with about `limit` bytes of text, the first column, at once."""
    held, size = [], 0
    for text, *others in columns:
        at = 0
        for step in steps(text, limit):
            n = step.nbytes
            if held and size + n > limit:
                yield tuple(map(pa.concat_arrays, zip(*held)))
                held, size = [], 0
            held.append((step, *(other.slice(at, len(step)) for other in others)))
            size, at = size + n, at + len(step)
    if held:
        yield tuple(map(pa.concat_arrays, zip(*held)))


def read(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first token of each text), cut into words one MB after the other."""
    parts = [tokens(Words.of(step, lower="ascii")) for step in steps(array)]
    n = np.concatenate([np.zeros(0, np.int64), *(np.diff(first) for _, _, first in parts)])
    token = np.concatenate([np.zeros(0, np.uint64), *(token for token, _, _ in parts)])
    return token, np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, text, first token of each text); each text ends with END. Tokens are odd, n-grams even."""
    n = words.counts() + 1
    first = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(first[-1], dtype=np.uint64)
    last = np.zeros(first[-1], dtype=bool)
    last[first[1:] - 1] = True
    out[last], out[~last] = END, words.hashes() | np.uint64(1)
    return out, np.repeat(np.arange(len(n)), n), first


def ngrams(token: np.ndarray, first: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For sizes 1 to `order`: (places, n-gram ending there, its context). BEGIN precedes the first token."""
    place = np.arange(len(token)) - np.repeat(first[:-1], np.diff(first))
    gram = token.copy()
    yield np.arange(len(token)), gram, np.zeros(len(token), np.uint64)
    for size in range(2, order + 1):
        # The n-gram one token earlier; before the first token stands BEGIN, before that nothing.
        context = np.empty_like(gram)
        context[1:] = gram[:-1]
        if size == 2:
            context[place == 0] = BEGIN
        at = np.flatnonzero(place >= size - 2)
        longer = (mixed(context + np.uint64(size)) + token) & ~np.uint64(1)
        yield at, longer[at], context[at]
        gram = longer


def _summed(gram: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams in order, and the sum of the values of each."""
    order = np.argsort(gram, kind="stable")
    gram, value = gram[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
    return gram[first], np.add.reduceat(value, first) if len(first) else value


def part_of(gram: np.ndarray, parts: int) -> np.ndarray:
    """Part of each n-gram; parts follow the order of the n-grams."""
    return ((gram >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the values, the lowest of all first: what the values have in common compresses well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _values(data: bytes, kind: str) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(wide, -1).T).view(kind).reshape(-1)


PACKED = "part int, grams binary, values binary"


class _Sums:
    """Sums values by n-gram and packs them by part, a bounded number at a time."""

    def __init__(self, parts: int, kind: str) -> None:
        self.parts, self.kind, self.held, self.n = parts, kind, [], 0

    def add(self, gram: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(_summed(gram, value))
        self.n += len(self.held[-1][0])
        if self.n > _HELD:
            yield from self.packed()

    def packed(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            gram, value = _summed(*(np.concatenate(x) for x in zip(*self.held)))
            self.held, self.n = [], 0
            part = part_of(gram, self.parts)
            cuts = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
            for at in range(0, len(cuts), 64):
                spans = [(a, b) for a, b in zip(cuts[at : at + 64], [*cuts[at + 1 : at + 65], len(gram)][: len(cuts[at : at + 64])])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(part[a]) for a, _ in spans], pa.int32()),
                        pa.array([_planes(np.diff(gram[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()),
                        pa.array([_planes(value[a:b].astype(self.kind)) for a, b in spans], pa.binary()),
                    ],
                    ["part", "grams", "values"],
                )


def _unpacked(batches: Iterator[pa.RecordBatch], kind: str, wide: str) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of a part in order, with the sums of their values."""
    grams, values = [np.zeros(0, np.uint64)], [np.zeros(0, wide)]
    for batch in batches:
        for gram, value in zip(batch.column("grams"), batch.column("values")):
            grams.append(np.cumsum(_values(gram.as_py(), "<u8"), dtype=np.uint64))
            values.append(_values(value.as_py(), kind).astype(wide))
    return _summed(np.concatenate(grams), np.concatenate(values))


def _counter(order: int, parts: int, low: int, high: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(parts, "<u4")
        for given in batches:
            for step in steps(given.column("text")):
                token, _, first = tokens(Words.of(step, lower="ascii"))
                grams = [gram for _, gram, _ in ngrams(token, first, order)] + [np.full(len(step), BEGIN)]
                every = np.concatenate(grams)
                part = part_of(every, parts)
                every = every[(part >= low) & (part < high)]
                yield from sums.add(every, np.ones(len(every), np.int64))
        yield from sums.packed()
        release()

    return count


FILES = "part int, path string, rows long, once long, width long, total long, distinct long, texts long"


def _count_writer(folder: str, least: int, low: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, n = _unpacked(batches, "<u4", "<i8")
        word = (gram & np.uint64(1)).astype(bool)
        kept = word | (n >= least)
        gram, n, word = gram[kept], n[kept], word[kept]
        if len(gram):
            once = n == 1
            file = Writer(fresh(folder, ".counts"))
            width = 4 if n.max() < 1 << 32 else 8
            file.add(gram[~once].astype("<u8"))
            file.add(gram[once].astype("<u8"))
            file.add(n[~once].astype(f"<u{width}"))
            file.close()
            word &= gram != BEGIN  # stands before texts, but is no token
            row = {
                "part": low + TaskContext.get().partitionId(), "path": file.path, "rows": int((~once).sum()), "once": int(once.sum()), "width": width, "total": int(n[word].sum()),
                "distinct": int(word.sum()), "texts": int(n[gram == END].sum()),
            }
            yield pa.RecordBatch.from_pylist([row], _FILES)

    return write


_FILES = pa.schema([("part", pa.int32()), ("path", pa.string())] + [(c, pa.int64()) for c in ("rows", "once", "width", "total", "distinct", "texts")])


def _spender(counts: Automaton, parts: int):
    """For each context seen twice or more the sum over its arcs of c - D, from the occurrences of the n-grams."""

    def spend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(parts, "<f8")
        for texts in gathered(given.column("text") for given in batches):
            piece = counts.fetched(texts, np.ones(len(texts), bool))
            for size in range(2, counts.order + 1):
                arc, source = piece.arcs(size)
                level, below = piece.levels[size], piece.levels[size - 1]
                more = below.count[source] > 1
                spent = np.bincount(source[more], 1 - counts.discount / level.count[arc[more]], len(below.gram))
                used = np.flatnonzero(spent)
                yield from sums.add(below.gram[used], spent[used])
        yield from sums.packed()
        _OPEN.clear()
        release()

    return spend


def _left_writer(folder: str, counted: dict[int, tuple[str, int, int, int]]):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, spent = _unpacked(batches, "<f8", "<f8")
        part = TaskContext.get().partitionId()
        if part in counted:
            path, rows, once, width = counted[part]
            gram, n = mapped(path, "<u8", rows), mapped(path, f"<u{width}", rows, 8 * (rows + once))
            left = np.ones(rows)
            spot = np.searchsorted(gram, context)
            left[spot] = np.maximum(0, 1 - spent / n[spot])
            file = Writer(fresh(folder, ".left"))
            file.add(left.astype("<f4"))
            file.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": file.path, "rows": rows}], _FILES)

    return write


@dataclass
class _Level:
    """The n-grams of one size that occur in some texts, in the order of their hashes. Their places are their numbers.

    The last entry, number -1, is no state. The one before it is BEGIN at size 1, else it stands for every
    n-gram that is known to be seen once without a look: count and failure weight are all a walk needs.
    """

    gram: np.ndarray
    count: np.ndarray  # 0: no state
    left: np.ndarray  # weight of the failure arc
    at: np.ndarray  # number of the n-gram that ends at each token


@dataclass
class Piece:
    """The part of the automaton that some texts can reach."""

    token: np.ndarray
    first: np.ndarray
    levels: dict[int, _Level]  # by size
    root: np.ndarray  # probability of each token in the state without words
    discount: float

    @property
    def order(self) -> int:
        return len(self.levels)

    @property
    def begin(self) -> int:
        """Number of the state before the first token; -1 without training texts."""
        number = len(self.levels[1].gram) - 2
        return number if self.levels[1].count[number] else -1

    def arcs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram of `size` words, its context), by number, at each token where both are states."""
        arc, source = self.levels[size].at, np.full(len(self.token), -1)
        source[1:] = self.levels[size - 1].at[:-1]
        source[self.first[:-1]] = self.begin if size == 2 else -1
        both = (self.levels[size].count[arc] > 0) & (self.levels[size - 1].count[source] > 0)
        return arc[both], source[both]

    def walked(self) -> np.ndarray:
        """Probability of each token, from left to right; a lane carries its state from token to token."""
        n = np.diff(self.first)
        lanes = -(-n // LANE)
        text = np.repeat(np.arange(len(n)), lanes)
        own = self.first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
        stop = np.minimum(own + LANE, self.first[text + 1])
        top = self.order - 1
        place = np.maximum(own - top, self.first[text])
        # A state is a size and the number of an n-gram of that size; size 0 is the state without words.
        state = np.full((top + 1, len(own)), -1)  # by size: the state and the states its failure arcs lead to
        if top:
            state[1, place == self.first[text]] = self.begin
        weight = np.ones(len(self.token))
        for _ in range(LANE + top):
            lane = np.flatnonzero(place < stop)
            if not len(lane):
                break
            here = place[lane]
            share, reach = np.zeros(len(lane)), np.ones(len(lane))
            for size in range(top, 0, -1):  # the longest state first, then along its failure arcs
                spot = np.flatnonzero(state[size, lane] >= 0)
                source, arc = state[size, lane[spot]], self.levels[size + 1].at[here[spot]]
                share[spot] += reach[spot] * np.maximum(self.levels[size + 1].count[arc] - self.discount, 0) / self.levels[size].count[source]
                reach[spot] *= self.levels[size].left[source]
            mine = here >= own[lane]
            weight[here[mine]] = (share + reach * self.root[here])[mine]
            for size in range(top, 0, -1):  # an n-gram is reached from the state that is its context, or from none
                arc = self.levels[size].at[here]
                reached = self.levels[size].count[arc] > 0
                if size > 1:
                    reached &= state[size - 1, lane] >= 0
                state[size, lane] = np.where(reached, arc, -1)
            place[lane] += 1
        return weight


@dataclass
class Automaton:
    """Where the states are, and the totals of the training tokens."""

    order: int
    parts: int
    files: dict[int, tuple[str, int, int, int, str | None]]  # by part: path, states seen more than once and once, bytes of a count, path of failure weights
    total: int
    distinct: int
    discount: float = DISCOUNT
    left_once: float = 1.0  # weight of the failure arc of states seen once
    whole: bool = False  # all n-grams of the training texts are states

    def _parts(self, grams: np.ndarray) -> Iterator[tuple[slice, tuple]]:
        """(where they are among the n-grams, given in order; arrays of the part that may hold them)."""
        part = part_of(grams, self.parts).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(grams)]):
            if (held := self.files.get(int(part[a]))) is not None:
                yield slice(a, b), _opened(*held)

    def find(self, grams: np.ndarray, sure: np.ndarray | bool = False, rare: np.ndarray | bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(count, weight of the failure arc) of each of the n-grams, given in order; 0 and 1 where there is no state.

        `sure`: certainly a state, so it is seen once if it is not among those seen more than once;
        `rare`: certainly not seen more than once."""
        count, left = np.zeros(len(grams), np.int64), np.ones(len(grams), np.float32)
        sure, rare = (np.broadcast_to(flag, len(grams)) for flag in (sure, rare))
        at = np.flatnonzero(~rare)
        looked = grams[at]
        for span, (keys, _, counts, lefts) in self._parts(looked):
            spot, hit = _places(keys, looked[span])
            there = at[span][hit]
            count[there] = counts[spot]
            if lefts is not None:
                left[there] = lefts[spot]
        once = (count == 0) & sure
        at = np.flatnonzero((count == 0) & ~sure)
        looked = grams[at]
        for span, (_, keys, _, _) in self._parts(looked):
            once[at[span]] = _places(keys, looked[span])[1]
        count[once], left[once] = 1, self.left_once
        return count, left

    def fetched(self, array: pa.Array, learned: np.ndarray | None = None) -> Piece:
        """The states that the texts can reach, size by size: what no shorter state leads to is not looked for.

        `learned` tells which texts are among the training texts. If all n-grams of those are states, none of
        them is looked for among the states seen once, and none at all whose context or end was seen once."""
        token, first = read(array)
        known = np.zeros(len(token), bool) if learned is None or not self.whole else np.repeat(learned, np.diff(first))
        levels: dict[int, _Level] = {}
        for size, (at, gram, _) in enumerate(ngrams(token, first, self.order), 1):
            once, most = at[:0], np.full(len(at), 2)
            if size > 1:  # an n-gram is seen as often as its context and its end at most
                below = levels[size - 1]
                seen = below.count[below.at]
                before = np.concatenate([[0], seen[:-1]])
                before[first[:-1]] = below.count[-2] if size == 2 else 0
                most = np.minimum(before, seen)[at]
                alone = (most == 1) & known[at]
                once, looked = at[alone], (most > 0) & ~alone
                at, gram, most = at[looked], gram[looked], most[looked]
            unique, inverse = np.unique(gram, return_inverse=True)
            sure, rare = np.zeros(len(unique), bool), np.zeros(len(unique), bool)
            sure[inverse[known[at]]] = True
            rare[inverse[most == 1]] = True
            count, left = self.find(unique, sure, rare)
            spot = np.full(len(token), -1)
            spot[at], spot[once] = inverse, len(unique)
            if size == 1:
                last, (n, weight) = BEGIN, self.find(np.array([BEGIN], dtype=np.uint64))
            else:
                last, n, weight = np.uint64(0), [1], [np.float32(self.left_once)]
            levels[size] = _Level(
                np.append(unique, [last, np.uint64(0)]), np.concatenate([count, n, [0]]), np.concatenate([left, weight, [np.float32(1)]]), spot
            )
        root = (levels[1].count[levels[1].at] + ADDED) / (self.total + ADDED * (self.distinct + 1))
        return Piece(token, first, levels, root, self.discount)

    def measured(self, array: pa.Array, learned: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, base score and score of the model."""
        piece = self.fetched(array, learned)
        n = np.diff(piece.first)
        text = np.repeat(np.arange(len(n)), n)
        known = piece.levels[1].count[piece.levels[1].at] > 0
        return {
            "n_tokens": n,
            "n_known": np.bincount(text[known], minlength=len(n)),
            "base_score": np.bincount(text, np.log10(piece.root), minlength=len(n)),
            "score": np.bincount(text, np.log10(piece.walked()), minlength=len(n)),
        }


def _opened(path: str, n: int, once: int, width: int, lefts: str | None) -> tuple:
    if (path, lefts) not in _OPEN:
        _OPEN[path, lefts] = (
            np.asarray(mapped(path, "<u8", n)), np.asarray(mapped(path, "<u8", once, 8 * n)),
            np.asarray(mapped(path, f"<u{width}", n, 8 * (n + once))), np.asarray(mapped(lefts, "<f4", n)) if lefts else None,
        )
    return _OPEN[path, lefts]


def _places(keys: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each n-gram that is among the keys, whether it is)."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(len(grams), bool)
    spot = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    hit = keys[spot] == grams
    return spot[hit], hit


#: Files that the running task has opened.
_OPEN: dict[tuple[str, str | None], tuple] = {}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def fit(
    docs: DataFrame, text: str = "text", order: int = ORDER, least: int = LEAST, discount: float = DISCOUNT, parts: int | None = None,
) -> Automaton:
    """Count the n-grams of all rows and write the states to the shared folder."""
    spark = docs.sparkSession
    batches.small(spark)
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(text).alias("text"))
    folder = new_path(spark, "automaton")

    def dealt(rows: DataFrame, step, low: int = 0, high: int = parts) -> list:
        with _tidy(spark):
            return rows.repartitionById(high - low, F.col("part") - low).mapInArrow(step, FILES).collect()  # one row per part

    cuts = [parts * k // ROUNDS for k in range(ROUNDS + 1)]
    made = [
        row for low, high in zip(cuts, cuts[1:]) if low < high
        for row in dealt(texts.mapInArrow(_counter(order, parts, low, high), PACKED), _count_writer(folder, least, low), low, high)
    ]
    files = {r["part"]: (r["path"], r["rows"], r["once"], r["width"], None) for r in made}
    totals = sum(r["total"] for r in made), sum(r["distinct"] for r in made)
    counts = Automaton(order, parts, files, *totals, discount, discount if least <= 1 else 1.0, least <= 1)
    sized = {part: held[:4] for part, held in files.items()}
    spent = dealt(texts.mapInArrow(_spender(counts, parts), PACKED), _left_writer(folder, sized))
    return replace(counts, files=files | {r["part"]: (*files[r["part"]][:4], r["path"]) for r in spent})


SCORES = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
])


def _scorer(model: Automaton):
    @F.arrow_udf(SCORES)
    def score(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, learned in gathered_rows(columns):
            found = model.measured(texts, learned.to_numpy(zero_copy_only=False))
            yield pa.StructArray.from_arrays([pa.array(found[f]) for f in SCORES.names], SCORES.names)
        _OPEN.clear()
        release()

    return score


def scored(
    docs: DataFrame, model: Automaton, *keep: str | Column, text: str = "text", learned: Column | None = None,
) -> DataFrame:
    """(the kept columns, n_tokens, n_known, base_score, score) per input row.

    `learned` may tell which rows the model was fitted on, whose n-grams need fewer looks; the scores are the same."""
    batches.small(docs.sparkSession)
    known = F.lit(False) if learned is None else F.coalesce(learned, F.lit(False))
    return docs.select(*keep, _scorer(model)(F.col(text), known).alias("_s")).select("*", "_s.*").drop("_s")
