"""Fingerprints against order MinHash written number by number."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import order_minhash as om

M64, M32 = (1 << 64) - 1, (1 << 32) - 1
SCHEMA = "doc_id long, text string, id string, bucket long, guest string"


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


def brute(text):
    if not text:
        return ""
    k = min(om.K, len(text))
    seen, grams = Counter(), []
    for p in range(len(text) - k + 1):
        h = k
        for c in text[p : p + k]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) & M64
        h = mix(h) >> 20
        grams.append((p, h, mix((h + seen[h] * 0xD6E8FEB86659FD93) & M64) >> 32))
        seen[h] += 1
    out = []
    for i in range(1, om.TUPLES + 1):
        a = (mix(i) >> 32) | 1
        first = sorted(grams, key=lambda g: ((g[2] * a) & M32, g[0]))[: om.LENGTH]
        t = 0
        for _, h, _ in sorted(first):
            t = mix((t * 0xC2B2AE3D27D4EB4F + h) & M64)
        out.append(f"{t >> 32:08x}")
    return "".join(out)


def like(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 8 * om.TUPLES, 8)) / om.TUPLES


def texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé漢🙂") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    return ["", "a", "abcde", "abcdef", "🙂", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "abc " * 30] + [" ".join(rng.choice(words) for _ in range(n)) for n in (2, 5, 30, 60, 90)]


def raw(text):
    return np.frombuffer(text.encode(), np.uint8)


def test_fingerprints(spark):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts())] + [(None, None, None, None, None), (3, "abcdef", "", 0, "")]
    got = om.fingerprints(spark.createDataFrame(rows, SCHEMA), "doc_id")
    assert sorted((str(r.id), r.fingerprint) for r in got.collect()) == sorted((str(r[0]), brute(r[1])) for r in rows)
    assert om.fingerprints(spark.createDataFrame([], SCHEMA), "doc_id").collect() == []


@pytest.mark.parametrize(("chunk", "counted", "block"), [(7, 40, 16), (16, 1 << 20, 5), (1 << 20, 1 << 20, 3)])
def test_chunks_and_readings_don_t_show(monkeypatch, chunk, counted, block):
    monkeypatch.setattr(om, "CHUNK", chunk)
    monkeypatch.setattr(om, "COUNTED", counted)
    monkeypatch.setattr(om, "BLOCK", block)
    for t in texts():
        cut = raw(t)
        assert om.text_of(om.fingerprint([cut])) == brute(t)
        assert om.text_of(om.fingerprint([cut[:9], cut[9:10], cut[10:]])) == brute(t)
        assert om.n_points(cut) == len(t)
        for n in (0, 1, 5, len(t) // 3, len(t), len(t) + 4):
            assert om.head(cut, n).tobytes().decode() == t[:n]


def test_order_shows_where_sets_don_t():
    rng = random.Random(5)
    words = [f"word{rng.randint(0, 10**6)}" for _ in range(200)]
    a = " ".join(words)
    turned = " ".join(words[100:] + words[:100])
    edited = a[:600] + "XY" + a[603:]
    prints = [om.fingerprint([raw(t)]) for t in (a, turned, edited)]
    assert om.likeness(prints[0], prints[2]) > 0.9 > 0.7 > om.likeness(prints[0], prints[1]) > 0.2


def pairs(rows):
    """Each row with the next one, as `edited` defines it; the text's hash decides in Spark only, so ids are distinct here."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, r in enumerate(order):
        yield r[0], r[1] or "", order[(k + 1) % len(order)][1] or ""


@pytest.mark.parametrize("n", [1, 2, 3, 60])
def test_edited(spark, n, monkeypatch):
    pool = texts()
    rows = [(k * 17 % 101, pool[(k * 5) % len(pool)] if k % 9 else None, "a", 1, "b") for k in range(n)]
    rows = rows + [(None, "the one without an id " * 9, "", 0, "")] if n == 60 else rows
    got = om.edited(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want = []
    for key, own, after in pairs(rows):
        t = own[: len(own) - len(own) // 3] + after[: len(own) // 3]
        a, b, c = brute(own), brute(t), brute(after)
        want.append((str(key), len(own), hashlib.sha256(t.encode()).hexdigest(), a, b, like(a, b), like(a, c)))
    assert sorted((str(r.id), *r[1:]) for r in got.collect()) == sorted(want)


def test_ties_and_empty_tables(spark):
    assert om.edited(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(k % 2, f"text {k % 7} " * 20, "", 0, "") for k in range(200)]
    got = om.edited(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r.id, r.fingerprint) for r in got) == Counter((r[0], brute(r[1])) for r in rows)
    # all but the last of equal rows are followed by one like themselves
    assert sum(r.near_next == 1.0 for r in got) == 200 - 14


def test_a_hot_id_has_many_buckets(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    placed = om.cyclic(rows, "doc_id", "text")
    sizes = [r["count"] for r in placed.filter("not guest").groupBy("bucket").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500
    assert [r["count"] for r in placed.filter("guest").groupBy("bucket").count().collect()] == [1] * len(sizes)


def test_likeness_of_columns(spark):
    prints = [brute(t) for t in texts()]
    rows = spark.createDataFrame([(a, b, like(a, b)) for a in prints for b in prints[:4]], "a string, b string, like double")
    assert rows.filter(om.likeness_of("a", "b") != F.col("like")).isEmpty()


def test_query(spark, tmp_path):
    rows = [(k, t, "", 0, "") for k, t in enumerate(texts())]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in om.op13_order_minhash(spark, str(tmp_path)).collect()}
    assert {k: r.fingerprint for k, r in got.items()} == {r[0]: brute(r[1]) for r in rows}
