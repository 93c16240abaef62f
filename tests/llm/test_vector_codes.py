"""Codes, errors and codebooks against Lloyd's rounds over all vectors, one by one."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, row string, part string, id long"


def brute(rows, parts=4, entries=256, rounds=4):
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    dim = max((len(r[1]) for r in good), default=0)
    width = (dim + -dim % parts) // parts
    cut = []
    for r in good:
        most = vector_codes.MOST
        x = [math.floor(min(max(1024 * float(np.float32(v)), -most), most)) for v in r[1]] + [0] * (parts * width - len(r[1]))
        cut.append((r[0], r[2], [x[p * width : p * width + width] for p in range(parts)]))
    first = sorted(cut, key=lambda c: (c[0] is None, c[0] or 0, c[2]))[:entries]
    books = [[c[2][p] for c in first] for p in range(parts)]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((d(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [(near(c[2][p], books[p])[1], c[2][p]) for c in cut]
            for e in range(len(books[p])):
                if mine := [x for i, x in own if i == e]:
                    books[p][e] = [sum(v) // len(mine) for v in zip(*mine)]
    out = []
    for key, label, x in cut:
        found = [near(x[p], books[p]) for p in range(parts)]
        out.append((str(key), str(label), [i for _, i in found], sum(s for s, _ in found)))
    return sorted(out), books


def some(n, dim, seed=4):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() for _ in range(dim)], i % 3) for i in range(n)]
    rows += [(n + i, rows[0][1], 0) for i in range(n // 3)]
    rows += [(900, None, 1), (901, [], None), (902, [float("nan")] * dim, 1), (903, [None] * dim, 0), (904, [float("-inf")] * dim, 2)]
    rows += [(None, [0.25] * dim, None), (3, [0.5] * dim, 1), (905, [0.5] * (dim - 3), None), (906, [1e30, -1e30] + [0.0] * (dim - 2), 1)]
    return [(*r, "r", "p", 1) for r in rows]


@pytest.mark.parametrize(("n", "dim", "entries"), [(40, 8, 5), (30, 10, 256), (12, 4, 1)])
def test_compress_is_lloyd(spark, n, dim, entries):
    rows = some(n, dim)
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), entries=entries)
    want, known = brute(rows, entries=entries)
    assert [b.tolist() for b in books] == known
    assert sorted((str(r.id), str(r.part), list(r.codes), r.error) for r in got.collect()) == want


def test_decompress(spark):
    rows = [(i, [i / 8, -i / 8, 0.5, 0.25], 0, "", "", 0) for i in range(6)]
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.id, list(r.vector)) for r in vector_codes.decompress(got, books).collect()) == [(r[0], r[1]) for r in rows]


def test_tables_without_usable_rows(spark):
    for rows in ([], [(1, None, None, "", "", 1)], [(1, [], None, "", "", 1)]):
        got, _ = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
        assert [(r.id, r.error) for r in got.collect()] == [(1, 0)] * bool(rows and rows[0][1] is not None)


def test_large_values_are_exact():
    rng = np.random.default_rng(1)
    x, book = rng.integers(-vector_codes.MOST, vector_codes.MOST, (50, 16)), rng.integers(-vector_codes.MOST, vector_codes.MOST, (7, 16))
    at, error = vector_codes.nearest(x, book)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book)) for v in x]
    assert [(int(e), int(i)) for i, e in zip(at, error)] == want
    assert vector_codes.nearest(np.array([[1]]), np.array([[0], [2]]))[0].tolist() == [0]


def test_query(spark, tmp_path):
    rows = [r for r in some(40, 8) if r[0] is not None and (not r[1] or len(r[1]) == 8)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = vector_codes.op12_vector_codes(spark, str(tmp_path)).collect()
    want, books = brute(rows)
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got) == sorted((k, "".join(f"{c:02x}" for c in codes), e, sums[label]) for k, label, codes, e in want)
    assert {r.codebooks_sha256 for r in got} == {vector_codes.digest([np.array(b) for b in books])}


def test_a_value_of_many_vectors_is_split(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(0.5), F.lit(0.25), F.lit(0.5), F.lit(0.1))).otherwise(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: F.rand(3) + k)).cast("array<float>").alias("embedding"), F.lit(0).alias("label"))
        out, _ = vector_codes.compress(rows.repartition(16), entries=2, rounds=1)
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in names:
            spark.conf.unset(k)
