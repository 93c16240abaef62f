from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from millrace.llm import toxicity
from millrace.llm._shared import Scratch, strings


def kernel(a, b):
    """The truncated subsequence kernel by its definition."""

    def parts(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, min(i + toxicity.REACH, len(w) - 1) + 1):
                for k in range(j + 1, min(j + toxicity.REACH, len(w) - 1) + 1):
                    if all(x.isalpha() for x in (w[i], w[j], w[k])):
                        key = (w[i], w[j], w[k])
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i)
        return out

    x, y = parts(a), parts(b)
    dot = sum(v * y.get(k, 0) for k, v in x.items())
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return dot / norm if norm else 0.0


def test_kernel_is_that_of_the_definition():
    names = ["stupid", "moron", "worthless", "banana"]
    words = ["stupid", "s.t.u.p.i.d", "stxupid", "mooron", "worthles", "table", "", "ab", "bananas", "anana"]
    some, values = toxicity.Landmarks([n.encode() for n in names]).kernel(pa.array([w.encode() for w in words], pa.large_binary()))
    got = dict(zip(some.tolist(), values))
    for i, w in enumerate(words):
        for j, n in enumerate(names):
            k = kernel(w, n)
            assert abs((got[i][j] if i in got else 0.0) - (k if k >= toxicity.FLOOR else 0.0)) < 1e-5, (w, n, k)


def test_spelt_out_words_are_one():
    distinct, place, first = toxicity.words(strings(pa.array(["you i d i o t now", "A b", None, "x" * 200])))
    names = distinct.to_pylist()
    assert [names[i] for i in place[first[0] : first[1]]] == [b"you", b"i d i o t", b"now"]
    assert first.tolist()[2] == first.tolist()[3]
    assert {names[i] for i in place[first[3] : first[4]]} == {b"x" * toxicity.LONGEST, b"x" * (200 % toxicity.LONGEST), b"x" * (200 % toxicity.LONGEST + toxicity.LONGEST // 2)}


def test_long_runs_are_covered_by_overlapping_words():
    rng = np.random.default_rng(4)
    for n in (47, 48, 49, 95, 97, 144, 500):
        run = "".join(rng.choice(list("abcé")) for _ in range(n))
        distinct, place, first = toxicity.words(strings(pa.array(["one", run, "two"])))
        names = [x.decode() for x in distinct.to_pylist()]  # no character is cut
        pieces = [names[i] for i in place[first[1] : first[2]]]
        half = toxicity.LONGEST // 2 // 2
        assert all(any(run[k : k + half] in p for p in pieces) for k in range(n - half + 1))
        assert [names[i] for i in place[: first[1]]] == ["one"] and [names[i] for i in place[first[2] :]] == ["two"]


def corpus(rng, n):
    calm = ["table", "river", "window", "garden", "because", "morning", "letter", "simple", "number", "orange", "travel", "market"]
    rude = ["stupid", "moron", "worthless", "pathetic"]
    rows = []
    for i in range(n):
        w = [rng.choice(calm) for _ in range(rng.randint(5, 40))]
        y = int(i % 5 == 0)
        if y:
            w.insert(rng.randrange(len(w)), rng.choice(rude))
        rows.append((i, " ".join(w), y))
    return rows


def test_held_out_accuracy_and_gapped_insults(spark):
    rng = random.Random(5)
    df = spark.createDataFrame(corpus(rng, 400), "doc_id long, text string, label int")
    model = toxicity.train(df.filter("doc_id < 300"), Scratch(spark, "t"))
    out = toxicity.score(df.filter("doc_id >= 300"), model).collect()
    assert sum(r.predicted == r.label for r in out) >= 0.97 * len(out)
    odd = ["the table is s.t.u.p.i.d today", "you mo-ron of a river", "so s t u p i d a window", "a stuupid letter", "a table by the river", "", None, "river " * 20_000]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(odd + odd)], "doc_id long, text string, score double"), model).collect()}
    assert [got[i].predicted for i in range(8)] == [1, 1, 1, 1, 0, 0, 0, 0]
    assert all(got[i].score == got[i + 8].score for i in range(8))


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "a text", 0), (2, None, 1)], "doc_id long, text string, label int")
    model = toxicity.train(df, Scratch(spark, "t"))
    assert [r.predicted for r in toxicity.score(df, model).collect()] == [0, 0]
    assert toxicity.score(df.limit(0), model).count() == 0
    assert toxicity.train(df.limit(0), Scratch(spark, "t")).names == []


def test_machine_parts_two_clouds():
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(0, 1, (200, 4)), rng.normal(3, 1, (50, 4))]
    w, c = toxicity._machine(x, np.r_[np.zeros(200), np.ones(50)])
    assert (((x @ w + c) > 0) == np.r_[np.zeros(200), np.ones(50)]).mean() > 0.97
