import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemill.llm.words import Words, shingle_sets, steps

WORD = re.compile(r"[^\x20\x09-\x0D]+")
some_texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té\x85!A", max_size=40)), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(some_texts)
def test_words_are_those_of_the_pattern(texts):
    words = Words.of(pa.array(texts, pa.string()))
    got = [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)]
    want = [WORD.findall(t or "") for t in texts]
    assert got == [w for ws in want for w in ws]
    assert words.counts().tolist() == [len(ws) for ws in want]
    by_word = {}
    for word, h in zip(got, words.hashes().tolist()):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=200, deadline=None)
@given(some_texts, st.integers(1, 4))
def test_windows_and_shingles(texts, size):
    words = Words.of(pa.array(texts, pa.string()))
    want = [WORD.findall(t or "") for t in texts]
    at, window = words.windows(size)
    assert np.bincount(words.text[at], minlength=len(texts)).tolist() == [max(0, len(w) - size + 1) for w in want]
    text, _ = shingle_sets(words, size)
    sets = [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set() for w in want]
    assert np.bincount(text, minlength=len(texts)).tolist() == [len(s) for s in sets]


@settings(max_examples=100, deadline=None)
@given(some_texts)
def test_lines(texts):
    words = Words.of(pa.array(texts, pa.string()))
    got = [(t, bytes(words.data[a:b]).decode()) for a, b, t in zip(*words.lines())]
    assert got == [(i, line) for i, t in enumerate(texts) for line in (t or "").split("\n") if WORD.search(line)]


def test_steps_cover_every_text_once():
    array = pa.array(["a" * 10, None, "b" * 100, "", "c"] * 7)
    for limit in (1, 15, 10_000):
        assert sum((s.to_pylist() for s in steps(array, limit)), []) == array.to_pylist()
