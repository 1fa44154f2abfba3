import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lakemill.llm import token_files
from lakemill.llm.files import mapped

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_round_trip_through_the_files(spark, docs, texts, folder):
    made = token_files.written(docs, f"{folder}/a", PATH, 2, shards=5)
    tokenizer = Tokenizer.from_file(PATH)
    start, rows = 0, {r.doc_id: r for r in token_files.read(spark, made).collect()}
    for i in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    shards = sorted(spark.read.parquet(f"{made}/manifest").collect(), key=lambda r: r.shard)
    assert len(shards) > 1 and shards[0].width == 2
    for a, b in zip(shards, shards[1:]):
        assert mapped(a.offsets, "<i8", a.docs + 1)[-1] == mapped(b.offsets, "<i8", b.docs + 1)[0] == b.base


def test_words_one_by_one_equal_whole_texts():
    odd = ["a\x1cb\x1dc d", "don't <|endoftext|> we'LL", " e\u0301 \u0301x\u00a0y\u2003z\x85w", "İSTANBUL ﬁ Σας", "", "12 3a_b--c", "x" * 5000]
    direct = Tokenizer.from_file(PATH)
    got = token_files.WordEncoder(PATH).encode(odd)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [direct.encode(t, add_special_tokens=False).ids for t in odd]


def test_odd_documents(spark, odd_docs, no_docs, folder):
    rows = token_files.read(spark, token_files.written(odd_docs, f"{folder}/b", PATH, 2)).orderBy("start").collect()
    assert len(rows) == odd_docs.count() and rows[0].doc_id is None and rows[0].start == 0
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert token_files.read(spark, token_files.written(no_docs, f"{folder}/c", PATH, 2)).count() == 0
