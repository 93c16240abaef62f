from __future__ import annotations

import random
import re

import numpy as np

from millrace.llm import contamination
from millrace.llm._shared import Scratch


def shingles(text, k=5):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def brute(docs, items, least=0.8):
    """(doc, item): best weighted similarity over all windows of the item's length."""
    out = {}
    for d, text in docs.items():
        s = shingles(text)
        for i, item in items.items():
            own = shingles(item)
            n, best = len(own), 0.0
            for a in range(max(1, len(s) - n + 1)) if n and s else []:
                w = s[a : a + n]
                keys = set(w) | set(own)
                best = max(best, sum(min(w.count(x), own.count(x)) for x in keys) / sum(max(w.count(x), own.count(x)) for x in keys))
            if best >= least:
                out[d, i] = round(best, 9)
    return out


def world():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(800)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = {i: text(rng.randint(15, 60)) for i in range(30)} | {90: None, 91: "", 92: "too few words", 93: "same same same same same same same same same same"}
    docs = {i: text(rng.choice([3, 30, 400])) for i in range(60)}
    for i in range(30):
        a, b = text(rng.randint(0, 90)), text(rng.randint(0, 90))
        own = items[i].split()
        if i % 3 == 1:  # one word changed, near an end
            own[rng.choice([0, 1, -1])] = "changed"
        docs[100 + i] = f"{a}\n{', '.join(own).upper() if i % 3 == 2 else ' '.join(own)}. {b}"
    docs |= {200: None, 201: "", 202: items[0], 203: items[0] + " " + items[1], 204: "é" * 50_000, 205: text(20_000) + " " + items[2], 206: items[93]}
    return docs, items


def test_finds_what_brute_force_finds(spark):
    docs, items = world()
    d = spark.createDataFrame([(k, v, "x") for k, v in docs.items()], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    small = {k: v for k, v in docs.items() if len(v or "") < 5000 and k != 204}
    want = brute(small, items) | {(205, 2): 1.0}
    got = {(r.id, r.item_id): round(r.similarity, 9) for r in contamination.contaminated(d, b).collect()}
    assert {k: v for k, v in got.items() if v == 1} == {k: v for k, v in want.items() if v == 1}
    assert set(got) <= set(want)
    # edited items are found but for the tail of the fingerprints' errors
    assert len(got) >= 0.95 * len(want)


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(1)
    items = contamination.Items(list(range(70)), [" ".join(f"w{rng.integers(0, 10**6)}" for _ in range(30)) for _ in range(70)], 5, contamination.RADIUS)
    for groups in items.tables().values():
        for own, table in groups:
            for bit, item in enumerate(own):
                for far in (0, 5, items.radius):
                    flips = rng.choice(64, far, replace=False)
                    p = int(items.prints[item]) ^ sum(1 << int(f) for f in flips)
                    assert any(int(table[b][p >> (16 * b) & 0xFFFF]) >> bit & 1 for b in range(contamination.BLOCKS))


def test_decontaminate_and_empty_tables(spark):
    docs, items = world()
    d = spark.createDataFrame([(k, docs[k]) for k in (0, 202, 200)], "doc_id long, text string")
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {r.doc_id for r in contamination.decontaminate(d, b, Scratch(spark, "t")).collect()} == {0, 200}
    assert contamination.contaminated(d.limit(0), b).count() == 0
    assert contamination.contaminated(d, b.limit(0)).count() == 0


def random_texts(seed):
    rng = random.Random(seed)
    return rng, lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]


def searched(items, docs):
    """{(doc, item)} that the search of one slice finds, without Spark."""
    own = contamination.Items(list(items), [" ".join(t) for t in items.values()], 5, contamination.RADIUS)
    frame = contamination.pa.table({"id": list(docs), "text": [" ".join(t) for t in docs.values()]}).to_batches()
    run = contamination.search(own, contamination.SIMILARITY)
    return {(i, j) for b in run(iter(frame)) for i, j in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}


def test_long_items_verbatim_and_edited():
    rng, text = random_texts(11)
    items = {100 * n + i: text(n) for n in (250, 300, 500, 600, 2000) for i in range(6)}
    # repeated words, whose counts pass 255
    items |= {7: text(1) * 600, 8: text(3) * 300}
    docs = {}
    for k, own in items.items():
        docs[2 * k] = text(rng.randint(0, 99)) + own + text(rng.randint(0, 99) + 2500)
        edited = list(own)
        for at in range(40, len(own), 100):  # five shingles in a hundred
            edited[at] = "changed"
        docs[2 * k + 1] = text(rng.randint(0, 99)) + edited + text(rng.randint(0, 99) + 2500)
    got = searched(items, docs)
    assert {(2 * k, k) for k in items} <= got
    assert {(2 * k + 1, k) for k in items if k > 8} <= got


def test_items_of_every_length_as_only_and_as_last_text():
    rng, text = random_texts(12)
    items = {n: text(n + 4) for n in range(1, 61)}
    # of every length from 1 to 60 shingles; a text of the item alone, in a table of one row
    assert {n for n in items if (0, n) in searched({n: items[n]}, {0: items[n]})} == set(items)
    # last, after a text that ends at an even or odd shingle; and between short texts
    for before in (9, 10, 11, 12):
        assert {n for n in items if (1, n) in searched({n: items[n]}, {0: text(before), 1: items[n]})} == set(items)
        assert {n for n in items if (1, n) in searched({n: items[n]}, {0: text(before), 1: items[n], 2: text(5), 3: text(5)})} == set(items)


def test_short_items_verbatim_at_every_place():
    rng, text = random_texts(13)
    items = {100 * n + i: text(n + 4) for n in range(1, 20) for i in range(40)}
    docs = {k: text(rng.randint(0, 60)) + own + text(rng.randint(0, 60)) for k, own in items.items()}
    assert {(k, k) for k in items} <= searched(items, docs)


def test_items_shorter_than_a_shingle_match_texts_of_just_their_words(spark):
    docs = spark.createDataFrame([(1, "Yes, it is"), (2, "yes it is so"), (3, "yes it"), (4, "it is yes")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "yes it is")], "item_id long, text string")
    assert [(r.id, r.item_id, r.similarity) for r in contamination.contaminated(docs, items).collect()] == [(1, 7, 1.0)]


def test_parts_of_the_benchmark_find_what_all_of_it_finds(spark, monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(8 + i)) for i in range(7)]
    docs = spark.createDataFrame([(i, "before " + t + " after") for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    key = lambda df: sorted((r.id, r.item_id, r.similarity) for r in df.collect())
    whole = key(contamination.contaminated(docs, items))
    monkeypatch.setattr(contamination, "ITEMS_A_PART", 3)
    assert key(contamination.contaminated(docs, items)) == whole and len(whole) == 7


def test_rows_without_an_id(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    big = 2**60 + 1
    rows = [(None, f"before {item} after", "x"), (big, item, "x"), (None, "a clean text of some words that nobody tests", "x"), (5, None, "x"), (big, "the same id but another text that is clean", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string").coalesce(1)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = contamination.contaminated(docs, benchmark).collect()
    assert sorted((str(r.id), r.item_id) for r in got) == [(str(big), 1), ("None", 1)]
    left = contamination.decontaminate(docs, benchmark, Scratch(spark, "test"))
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(str(r) for r in docs.collect() if r.text is None or item not in r.text)
