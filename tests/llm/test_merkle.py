import hashlib
import random
import zlib

import pytest

from lakemill.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(nodes, fan):
    """(top, siblings of each node upwards) of a list of digests."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fan] for i in range(0, len(nodes), fan)]
        for k, i in enumerate(at):
            run, slot = runs[i // fan], i % fan
            paths[k].append((run[:slot], run[slot + 1 :]))
        at, nodes = [i // fan for i in at], [h(*run) for run in runs]
    return nodes[0], paths


def brute(rows, fan, changed):
    """{leaf place: (leaf, subroot, root, proof, folded)} for rows (doc_id, source, lang, n_chars, text)."""
    order = lambda v: (v is not None, v if v is not None else 0)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    named = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done, tops = [], []
    for name in named:
        held = sorted(groups[name], key=lambda r: (order(r[0]), leaf(r)))
        top, paths = grow([leaf(r) for r in held], fan)
        tops.append(top)
        done.append((held, paths))
    root, above = grow(tops, fan)
    out = []
    for (held, paths), top, suffix in zip(done, tops, above):
        for r, path in zip(held, paths):
            folded = leaf((*r[:4], changed(r)))
            for left, right in [*path, *suffix]:
                folded = h(*left, folded, *right)
            proof = h(*(x for left, right in [*path, *suffix] for x in (*left, *right)))
            out.append((r[0], leaf(r), top, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def collected(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, n int, at string, leaf long, suffix int"


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_trees_of_many_sizes(spark, fan):
    rng = random.Random(fan)
    rows = []
    for g, size in enumerate((1, 2, 3, 9, 17, 70)):
        rows += [(rng.randrange(10_000), [None, "é", "a", "B", "b", "ab"][g], rng.choice(["en", None]), i, f"text {i} of {g}") for i in range(size)]
    rows += [(5, "b", None, None, None), (5, "b", None, None, None), (None, "b", "en", 1, ""), (6, "", "en", 2, "Ä" * 5)]
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    shown = {"text": queries.F.upper("text")}
    got = collected(merkle.manifest(docs, COLUMNS, shown=shown, fan=fan))
    assert got == brute(rows, fan, lambda r: r[4].upper() if r[4] is not None else None)
    assert len({r[3] for r in got}) == 1


def test_blocks_of_more_than_one_sweep(spark):
    rows = [(i, "s", None, None, str(i)) for i in range(300)]  # 2 ** 3 leaves a block: three sweeps and more
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    got = collected(merkle.manifest(docs, COLUMNS, fan=2))
    assert got == brute(rows, 2, lambda r: r[4]) and all(r[-1] for r in got)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = collected(merkle.manifest(odd_docs, ["doc_id", "source", "lang", "n_chars", "text"]))
    assert len(rows) == odd_docs.count() and all(r[-1] for r in rows)
    assert len({r[1] for r in rows}) == odd_docs.distinct().count()
    assert merkle.manifest(no_docs, ["doc_id", "text"]).count() == 0


def test_query_against_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]

    def changed(r):
        low = zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if low else r[4]

    got = collected(queries.op13_merkle_manifest(spark, "/root/testdata/sf0.001"))
    assert got == brute(rows, 16, changed)
    assert 0 < sum(not r[-1] for r in got) < len(got)
