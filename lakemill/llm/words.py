"""Words, word windows and lines of a batch of texts as flat numpy arrays.

Everything is computed on the UTF-8 bytes of a whole batch at once: a word is a byte range, its
identity a 64-bit hash of the bytes, a window a hash over word hashes. Nothing loops over words.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step works on; a longer text is a step of its own.
STEP = 1 << 20

#: What ends a word: U+0020 and U+0009 to U+000D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: What ends a word if punctuation does, too: white space and ASCII punctuation.
PLAIN = SPACE.copy()
PLAIN[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def release() -> None:
    """Give freed memory back; workers live on between tasks and would hold what the last one needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


_LIBC = ctypes.CDLL(None)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the hash base and of its inverse, as many as were ever needed."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = max(n, STEP + 1)
            cls.up, cls.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base))]) for base in (_BASE, _BACK)
            )
        return cls.up[:n], cls.down[:n]


def texts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each starts (one more entry than texts). Null is empty."""
    array = pc.fill_null(array, "")
    if not pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole, at - at[0]


def steps(array: pa.Array, limit: int = STEP) -> Iterator[pa.Array]:
    """Slices of a text column with about `limit` bytes each; whole texts always."""
    sizes = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(array):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield array.slice(at, stop - at)
        at = stop


@dataclass
class Words:
    """Words of a batch. `first[i]:first[i + 1]` are the words of text i."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    _prefix: np.ndarray | None = None

    @classmethod
    def of(cls, array: pa.Array, lower: str | None = None, ends: np.ndarray = SPACE) -> Words:
        """lower: None, "ascii" (A-Z only) or "all" (every cased letter)."""
        if lower == "all":
            array = pc.utf8_lower(array)
        data, at = texts(array)
        if lower == "ascii":
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        inside = ~ends[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[at] = True
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return cls(data, at, start, end, np.searchsorted(at, start, side="right") - 1, np.searchsorted(start, at))

    def __len__(self) -> int:
        return len(self.at) - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.at[1:]] - total[self.at[:-1]]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range."""
        up, down = _Powers.of(len(self.data) + 1)
        if self._prefix is None:
            self._prefix = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self._prefix[1:])
        sums = (self._prefix[end] - self._prefix[start]) * down[start]
        return mixed(sums + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.hash(self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every window of `size` words inside one text."""
        h = self.hashes() if hashes is None else hashes
        n = len(h) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        whole = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        total = h[whole]
        for k in range(1, size):
            total = mixed(total) + h[whole + k]
        return whole, mixed(total)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of every line that holds a word; a line ends at a line feed."""
        cuts = np.flatnonzero(self.data == 0x0A)
        start = np.unique(np.concatenate([self.at[:-1], cuts + 1]))
        start = start[start < len(self.data)]
        end = np.minimum(
            np.append(cuts, len(self.data))[np.searchsorted(cuts, start)],
            self.at[np.searchsorted(self.at, start, side="right").clip(max=len(self.at) - 1)],
        )
        held = np.searchsorted(self.start, end) > np.searchsorted(self.start, start)
        start, end = start[held], end[held]
        return start, end, np.searchsorted(self.at, start, side="right") - 1


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct shingle of each text, sorted by both.

    A text with fewer words than `size` has one shingle, all its words; one without words has none.
    """
    h = words.hashes()
    at, shingle = words.windows(size, h)
    text = words.text[at]
    few = np.flatnonzero((words.counts() > 0) & (words.counts() < size))
    if len(few):
        short = np.array([h[words.first[t] : words.first[t + 1]].sum() for t in few], dtype=np.uint64)
        short = mixed(short + np.uint64(1) * words.counts()[few].astype(np.uint64))
        text, shingle = np.concatenate([text, few]), np.concatenate([shingle, short])
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    return text[new], shingle[new]
