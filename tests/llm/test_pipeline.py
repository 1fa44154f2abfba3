import base64
import re

import public_tokenizers
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from tests.llm.test_jaccard import brute
from tests.llm.test_pii import brute as base_spans

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stage = dict(pipeline.STAGES)
    first = stage["toxicity"](spark, docs, FOLDER)
    assert first.columns == docs.columns and 0 < first.count() <= docs.count()

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    second = stage["near_duplicates"](spark, docs, FOLDER)
    assert {r.doc_id for r in second.collect()} == {c for _, c, _ in brute(rows)}

    norm = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    items = [norm(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    third = stage["decontamination"](spark, docs, FOLDER)
    assert {r.doc_id for r in third.collect()} == {i for i, t in rows if not any(f" {x} " in f" {norm(t)} " for x in items)}

    fourth = stage["pii"](spark, docs, FOLDER)
    for r in fourth.collect():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if not base_spans(dict(rows)[r.doc_id]):
            assert r.text == dict(rows)[r.doc_id] or "<" in r.text

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in stage["byte_bpe"](spark, docs, FOLDER).collect():
        assert r.ids == library.encode_ordinary(dict(rows)[r.doc_id])


def test_run_chains_the_stages(spark):
    got = {r.doc_id for r in contract.queries()["pipeline"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert got and got <= {r.doc_id for r in docs.collect()}
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "byte_bpe"]


def test_every_operator_has_its_query():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
