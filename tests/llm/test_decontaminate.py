import random
from collections import Counter

import numpy as np
import pyarrow as pa

from lakemill.llm import decontaminate
from lakemill.llm.decontaminate import Index, simhash


def test_exact_and_near_passages_are_found_and_clean_texts_left(spark, no_docs, odd_docs):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    items = [(k, [word() for _ in range(rng.randint(5, 60))]) for k in range(40)]
    docs, want = [], set()
    for d in range(120):
        body = [word() for _ in range(rng.randint(0, 300))]
        if d % 3 == 0:
            k, passage = items[rng.randrange(40)]
            passage = list(passage)
            if d % 2 and len(passage) > 8:
                passage[0] = "CHANGED"
            cut = rng.randint(0, len(body))
            body = body[:cut] + [w.upper() + "," for w in passage] + body[cut:]
            want.add((d, k))
        docs.append((d, " ".join(body)))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(99, None), (98, ""), (97, "too few words here")], "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item) for r in decontaminate.matches(rows, benchmark).collect()}
    assert got == want
    assert {(r.doc_id, r.item) for r in decontaminate.matches(rows, benchmark, limit=2000).collect()} == want
    assert {r.doc_id for r in decontaminate.clean(rows, benchmark).collect()} == set(range(120)) - {d for d, _ in want}
    assert decontaminate.clean(odd_docs, benchmark).count() == odd_docs.count()
    assert decontaminate.clean(odd_docs, benchmark).columns == odd_docs.columns
    assert decontaminate.matches(no_docs, benchmark).count() == 0
    assert decontaminate.clean(rows, benchmark.limit(0)).count() == rows.count()


def test_the_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(4)
    bags = [(k, rng.integers(0, 1 << 62, 30).astype(np.uint64)) for k in range(50)]
    sized = decontaminate._Sized(bags)
    prints = np.concatenate([sized.prints, rng.integers(0, 1 << 62, 500).astype(np.uint64)])
    for _ in range(12):
        prints = np.concatenate([prints, prints[:50] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))])
    window, item = sized.within(prints, 23)
    every = np.bitwise_count(prints[:, None] ^ sized.prints[None, :]) <= 23
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(every))))
    assert simhash(bags[0][1]) == int(sized.prints[0])


def test_a_window_counts_repeated_shingles(spark):
    item = "one two three four five one two three four five one two three four five"
    found = Index([(1, item)]).search(pa.array([item, "one two three four five six seven"]))
    assert [(f[0], f[1], f[2]) for f in found] == [(0, 1, 1.0)]


def test_texts_shorter_than_an_item_and_items_under_five_words():
    words = [f"w{i}" for i in range(16)]
    index = Index([(1, " ".join(words)), (2, "three short words"), (3, "One"), (4, None)])
    docs = ["other text of eight words that stays clean", " ".join(words[:-1]), " ".join(words[1:-1]), " ".join(words[:12]), None, "and three, Short words!", "one"]
    found = index.search(pa.array(docs))
    assert [(t, i, round(v, 6), first, n) for t, i, v, first, n in found] == [
        (1, 1, round(15 / 16, 6), 0, 15), (2, 1, round(14 / 16, 6), 0, 14), (5, 2, 1.0, 1, 3), (6, 3, 1.0, 0, 1),
    ]


def edited(rng, words, kind, times, word):
    words = list(words)
    for spot in sorted(rng.sample(range(1, len(words) - 1), times), reverse=True):
        if kind == "replaced":
            words[spot] = word()
        elif kind == "inserted":
            words.insert(spot, word())
        else:
            del words[spot]
    return words


def brute(item, text, threshold=0.8):
    """Best (similarity, first word) over all windows of the item's size, or the whole text if it is shorter."""
    n, best = len(item), None
    fives = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for at in range(max(1, len(text) - n + 1)):
        window = text[at : at + n]
        both = sum((Counter(item) & Counter(window)).values())
        value = both / (n + len(window) - both)
        if value >= threshold and fives(item) & fives(window) and (best is None or value > best[0]):
            best = value, at
    return best


def test_edited_passages_equal_brute_force_over_all_windows():
    rng = random.Random(8)
    common = [f"c{i}" for i in range(60)]  # items and texts share words
    word = lambda: rng.choice(common) if rng.random() < 0.5 else f"r{rng.randrange(5000)}"
    items = [[word() for _ in range(rng.randint(5, 40))] for _ in range(30)]
    items.append(items[0][:4] + items[0][4:][::-1])
    texts = []
    for k in range(240):
        item = items[k % len(items)]
        passage = edited(rng, item, ("replaced", "inserted", "deleted")[k % 3], min(k % 4, len(item) - 2), word)
        texts.append([word() for _ in range(rng.choice([0, 0, 3, 20]))] + passage + [word() for _ in range(rng.choice([0, 4, 20]))])
    texts.append(items[1] * 3)
    found = Index([(k, " ".join(x)) for k, x in enumerate(items)]).search(pa.array([" ".join(t) for t in texts]))
    want = {
        (t, k, round(b[0], 9), b[1]) for t, text in enumerate(texts) for k, item in enumerate(items) if (b := brute(item, text))
    }
    assert {(t, k, round(v, 9), first) for t, k, v, first, _ in found} == want and len(want) > 150


def test_items_of_16_to_64_words_are_found_after_one_and_two_edits():
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [[word() for _ in range(n)] for n in range(16, 65)]
    index = Index([(k, " ".join(x)) for k, x in enumerate(items)])
    around = lambda: [word() for _ in range(50)]
    for times in (1, 2):
        for kind in ("replaced", "inserted", "deleted"):
            texts = [" ".join(around() + edited(rng, x, kind, times, word) + around()) for x in items]
            caught = {t for t, k, *_ in index.search(pa.array(texts)) if t == k}
            assert len(caught) >= (1.0 if times == 1 else 0.9) * len(items), (kind, times)
    assert not index.search(pa.array([" ".join(around() * 4) for _ in range(200)]))


def test_a_null_item_and_repeated_items_are_reported(spark):
    benchmark = spark.createDataFrame([(None, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g")], "item_id long, text string")
    docs = spark.createDataFrame([(7, "x a b c d e f g y")], "doc_id long, text string")
    assert sorted((r.item or 0) for r in decontaminate.matches(docs, benchmark).collect()) == [0, 1, 1]
