from __future__ import annotations

import hashlib
import random

from millrace.llm import minhash
from millrace.llm._shared import Scratch, roots


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def brute(texts, k):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    component = {i: i for i in sets}
    changed = True
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(component[i], component[j])
            if component[i] != low or component[j] != low:
                component[i] = component[j] = low
                changed = True
    return {i: (len(sets[i]), component[i], component[i] == i) for i in sets}


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        out.append(" ".join(base))
        for _ in range(12):
            w = base.copy()
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(words)
            out.append("  ".join(w).title() if rng.random() < 0.3 else " ".join(w))
    return out


EDGES = [None, "", " \t\n", "one", "ONE", "one two", "a b", "é É", "One\x0bTwo", "x " * 5000, "x " * 4000 + "y"]


def test_matches_brute_force(spark):
    texts = dict(enumerate(EDGES + corpus()))
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in texts.items()], "doc_id long, text string, id string, class int")
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, f=minhash.Forest(shingle=2)).collect()}
    assert got == brute(texts, 2)


def test_crowded_regions_are_whole(spark):
    """Many copies of one text, edited until some link with few others: a window of two sees only part."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(150):
        w = base.copy()
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            w[rng.randrange(60)] = f"e{rng.randrange(40)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    f = minhash.Forest(shingle=2, window=2, block=16, rare=2)
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, f=f).collect()}
    assert got == brute(texts, 2)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    rows = minhash.near_duplicates(df).collect()
    assert sorted((r.id, r.component_id) for r in rows) == [(3, 3), (5, 3), (5, 3)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    a, b = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen"
    first, other = sorted((a, b), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    df = spark.createDataFrame([(5, a), (5, b), (6, first), (7, other), (None, a), (None, None)], "doc_id long, text string")
    got = sorted((-1 if r.id is None else r.id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, None, True), (-1, None, True), (5, 5, True), (5, 5, True), (6, 5, False), (7, 7, True)]


def test_roots_of_chains_and_stars(spark):
    """A chain of 40 links, a star, and a chain that a later link joins to both."""
    chain = [(i + 1, i) for i in range(40)]
    star = [(100 + i, 100) for i in range(1, 30)]
    tail = [(202, 200), (205, 202)]
    df = spark.createDataFrame(chain + star + tail, "id long, above long")
    scratch = Scratch(spark, "test")
    labels = roots(scratch, df)
    got = {r.id: r.component for r in labels.collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 202: 200, 205: 200}
    assert labels.count() == len(got)
    more = spark.createDataFrame([(40, 205, True), (110, 205, True), (300, 301, True), (5, 301, False)], "u long, v long, linked boolean")
    merged = minhash._joined(scratch, labels, more).collect()
    assert len(merged) == len(got) + 2
    assert {r.id: r.component for r in merged} == {i: 0 for i in got} | {300: 300, 301: 300}
    none = roots(scratch, spark.createDataFrame([], "id long, above long"))
    assert none.count() == 0 and minhash._joined(scratch, none, more.filter("not linked")).count() == 0
