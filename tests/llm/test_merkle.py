"""Manifests against the definition, node by node."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, row string, i long, h string, path string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def climb(nodes, width):
    """(last node, for each node its siblings from below as (before, after))."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, k in zip(paths, at):
            run = nodes[k - k % width : k - k % width + width]
            p.append(("".join(run[: k % width]), "".join(run[k % width + 1 :])))
        nodes, at = [h(*nodes[k : k + width]) for k in range(0, len(nodes), width)], [k // width for k in at]
    return nodes[0], paths


def brute(rows, width=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        low[g] = climb([leaf(r) for r in groups[g]], width)
    root, high = climb([low[g][0] for g in names], width) if names else (None, [])
    return sorted((str(r[0]), leaf(r), low[g][0], root, tuple(p + q)) for g, q in zip(names, high) for r, p in zip(groups[g], low[g][1]))


def some(n):
    rows = [(k * 7 % 100003, f"s{k % 3}", ["en", "en", "de", None, ""][k % 5] if k % 11 else "x", k, f"text é {k} " * (k % 4), "r", 1, "h", "p") for k in range(n)]
    return rows + [(None, None, None, None, None, None, None, None, None), (None, "", "en", 0, "", None, None, None, None), rows[3], rows[3], (rows[4][0], "other", rows[4][2], None, "tie", "r", 1, "h", "p")] + [(5, "a", "lone", 1, "b" * 200_000, "", 0, "", "")]


@pytest.mark.parametrize(("n", "width", "stride"), [(60, 2, 6), (61, 2, 1), (45, 3, 2), (8, 16, 1)])
def test_manifest_is_the_definition(spark, n, width, stride):
    df = spark.createDataFrame(some(n), SCHEMA).repartition(5)
    got = merkle.manifest(df, "lang", ["doc_id"], merkle.COLUMNS, width=width, stride=stride)
    found = sorted((str(r.row.doc_id), r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.path)) for r in got.collect())
    assert found == brute(some(n), width)
    assert got.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()


def test_one_row_and_none(spark):
    one = spark.createDataFrame(some(9)[:1], SCHEMA)
    r = merkle.manifest(one, "lang", ["doc_id"], merkle.COLUMNS).first()
    assert r.leaf == r.subroot == r.root and r.path == []
    assert merkle.manifest(one.limit(0), "lang", ["doc_id"], merkle.COLUMNS).collect() == []


def test_tampered_rows_don_t_verify(spark, tmp_path):
    rows = some(80)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    counts = {r[0]: r[3] for r in rows}
    for r in got:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and counts[r.doc_id] is not None
        assert r.verified == (not hit) == (r.folded_root == r.root)
    assert {r.verified for r in got} == {True, False}
    paths = {(d, x): p for d, x, _, _, p in brute(rows)}
    assert all(r.proof_sha256 == h(*[a + b for a, b in paths[str(r.doc_id), r.leaf]]) for r in got if r.doc_id not in (rows[3][0], None))


def test_values_don_t_run_together(spark):
    a, b, c = spark.createDataFrame([(1, "ab", "c"), (2, "a", "bc"), (3, None, "-")], "k int, x string, y string").select(merkle.leaf([F.col("x"), F.col("y")])).collect()
    assert len({a, b, c}) == 3


def test_levels_share_a_shuffle(spark):
    nodes = spark.range(500).select((F.col("id") % 2).cast("string").alias("g"), F.col("id").alias("i"), F.lit("h").alias("h"), F.lit(500).cast("long").alias("n"), F.struct("id").alias("row"))
    plan = merkle.climb(nodes, 2, 6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window ") == 6
