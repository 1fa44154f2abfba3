import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemill.llm import bpe
from lakemill.llm.queries import byte_ranks


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def mine():
    return bpe.Encoder(byte_ranks())


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet=" \n\t\x1c\x1d\x85\xa0\u2003'stre0é½", max_size=60)))
def test_ids_equal_the_library(library, mine, text):
    assert mine.encode([text])[0].tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("piece", ["x" * 5000, "the" * 400, "é" * 700, "abcdefghij" * 100, "?!" * 900, "a" * 64, "b" * 65])
def test_long_pieces(library, mine, piece):
    assert mine.encode([piece])[0].tolist() == library.encode_ordinary(piece)
    data = piece.encode()
    if 2 <= len(data) <= 64:
        assert mine._long(data) == mine._side_by_side([data], 64)[0].tolist() == library.encode_ordinary(piece)


def test_a_forgetful_worker_encodes_alike(library, monkeypatch):
    monkeypatch.setattr(bpe, "_CACHE", 3)
    mine = bpe.Encoder(byte_ranks())
    texts = ["one two three", "four five six seven", "one two eight"]
    assert [x.tolist() for x in mine.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_documents(spark, docs, texts, odd_docs, no_docs, library):
    ranks = byte_ranks()
    for r in bpe.decoded(bpe.encoded(docs, ranks, "doc_id"), ranks).collect():
        assert r.ids == library.encode_ordinary(texts[r.doc_id])
        assert hashlib.sha256(r.decoded).digest() == hashlib.sha256(texts[r.doc_id].encode()).digest()
    odd = bpe.decoded(bpe.encoded(odd_docs, ranks, "doc_id", "text"), ranks).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in odd)
    both = bpe.round_trip(odd_docs, ranks, "doc_id", "text")
    assert both.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(map(str, both.collect())) == sorted(map(str, odd))
    assert bpe.encoded(no_docs, ranks, "doc_id").count() == bpe.round_trip(no_docs, ranks, "doc_id").count() == 0


def test_every_code_point_is_split_as_the_library_does(library, mine):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1 {chr(c)}{chr(c)}b" for c in points[low : low + 512]) for low in range(0, len(points), 512)]
    assert bpe._later_signs().search("\u0558") and not bpe._later_signs().search("Aé1\u4e2d\U0001f600")
    for text, ids in zip(texts, mine.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text)
