from __future__ import annotations

import numpy as np
import pytest

from millrace.llm import embedding_dedup


def brute(rows, cosine):
    n = len(rows)
    usable = [r[2] is not None and v_ok(r[1]) for r in rows]
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and usable[i] and usable[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                link[i, j] = x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine
    ids = [r[0] for r in rows]
    component = ids.copy()
    for _ in range(n):
        component = [min([component[i], *(component[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
    return {ids[i]: (int(link[i].sum()), component[i], component[i] == ids[i]) for i in range(n)}


def v_ok(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1, None):
        for _ in range(6):
            base = rng.normal(size=16)
            for _ in range(12):
                rows.append([len(rows), (base + rng.normal(size=16) * 0.12).tolist(), label])
    rows += [[len(rows) + k, rows[3][1], 0] for k in range(5)]  # copies
    rows += [[len(rows), [2 * x for x in rows[4][1]], 0]]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 8, [1.0] * 8, [1e-300] * 16, [1e300] * 16]
    rows += [[len(rows) + k, v, 0] for k, v in enumerate(odd)]
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("block", [4, 64])
def test_matches_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, part string")
    got = {r.id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, cosine=0.95, block=block).collect()}
    assert got == brute(rows, 0.95)


def test_empty_and_unusable_tables(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [0.0], None)], "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(df).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_rows_without_an_id_have_no_links(spark):
    v = [[1.0, 0.0], [1.0, 0.01], [1.0, 0.02], [0.0, 1.0]]
    rows = [(None, v[0], 1), (None, v[0], 1), (None, v[3], 1), (2**60 + 1, v[1], 1), (2**60 + 3, v[2], 1), (7, v[2], 2)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((str(r.id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted(
        [("None", 0, "None", True)] * 3 + [(str(2**60 + 1), 1, str(2**60 + 1), True), (str(2**60 + 3), 1, str(2**60 + 1), False), ("7", 0, "7", True)]
    )
