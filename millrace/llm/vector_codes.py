"""Compressed vectors: each part of a vector is replaced by the nearest of a few codebook entries.

Components become integers, floor(SCALE * x), and vectors are cut into equal
parts. Equal integer parts of one position are one weighted row, so that Lloyd's
rounds run over distinct values: each task assigns its values and adds up their
sums by entry, and only these partial sums, a bounded number a task, are
shuffled. Codebooks, of entries x dimension integers, are what reaches the driver
and goes back out with the tasks. At the end, codes and errors are joined to the
vectors by position and value; a value that very many vectors share is a
skewed side of a join of two written tables, which Spark splits.

All arithmetic is on integers, so results don't depend on partitioning. Distances
are computed in doubles where their parts stay below 2^53, else in 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import Scratch, mapped

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Scaled components are at most this far from 0, so that no sum or squared distance overflows.
MOST = 1 << 24


def usable(df: DataFrame, vector: str):
    """The rows whose vector isn't null and has neither null nor non-finite components."""
    finite = F.forall(F.col(f"`{vector}`"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return df.filter(F.col(f"`{vector}`").isNotNull()).filter(finite)


def scaled(vector: str, parts: int, dim: int):
    """An array of `parts` arrays of integers, padded by zeros up to dim components."""
    x = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda x: F.floor(F.least(F.greatest(x * SCALE, F.lit(float(-MOST))), F.lit(float(MOST)))).cast("int"))
    if dim:
        x = F.concat(x, F.array_repeat(F.lit(0), F.lit(dim) - F.size(x)))
    width = dim // parts
    return F.array(*[F.slice(x, k * width + 1, width) for k in range(parts)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def nearest(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each value's nearest entry, the first of equally near ones."""
    top = max([1, *(int(np.abs(x).max()) for x in (values, book) if x.size)])
    kind = np.float64 if 4 * top * top * max(1, values.shape[1]) < 1 << 53 else np.int64
    x, c = values.astype(kind), book.astype(kind)
    apart = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    at = apart.argmin(axis=1)
    return at, apart[np.arange(len(x)), at].astype(np.int64)


def assigned(values: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """values (position, part, weight) with the code and the error of each."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, position = _matrix(b.column(1), width), b.column(0).to_numpy()
            code, error = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
            for p, book in enumerate(books):
                own = position == p
                code[own], error[own] = nearest(x[own], book)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code), pa.array(error)], names=[*b.schema.names, "code", "error"])

    return mapped(values.select("position", "part", "weight"), run, "position int, part array<int>, weight long, code int, error long")


def moved(values: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks whose entries are the floored means of the values nearest to them; entries without values stay."""
    width, entries = books[0].shape[1], len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(books), entries, width), np.int64), np.zeros((len(books), entries), np.int64)
        for b in batches:
            x, position, weight = _matrix(b.column(1), width), b.column(0).to_numpy(), b.column(2).to_numpy()
            for p, book in enumerate(books):
                own = position == p
                code, _ = nearest(x[own], book)
                np.add.at(sums[p], code, x[own] * weight[own, None])
                np.add.at(counts[p], code, weight[own])
        p, e = np.nonzero(counts)
        found = pa.FixedSizeListArray.from_arrays(pa.array(sums[p, e].ravel()), width) if width else pa.array([[]] * len(p), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), found.cast(pa.list_(pa.int64()))], names=["position", "entry", "n", "sums"])

    parts = mapped(values.select("position", "part", "weight"), run, "position int, entry int, n long, sums array<long>")
    total = parts.groupBy("position", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
    out = [b.copy() for b in books]
    for p, e, n, sums in total.collect():  # as many rows as there are entries
        out[p][e] = [s // n for s in sums]
    return out


def seeds(rows: DataFrame, parts: int, width: int, entries: int) -> list[np.ndarray]:
    """For each position, the parts of the `entries` smallest ids."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "parts").select("parts").limit(entries).collect()
    return [np.array([r.parts[p] for r in first], np.int64).reshape(len(first), width) for p in range(parts)]


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", group: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scratch: Scratch | None = None) -> tuple[DataFrame, list[np.ndarray]]:
    """((id, part, codes, error) for each usable row of df, the codebook of each position).

    Rows whose vector is null or holds a null or non-finite component are left
    out; a vector without components is not. Vectors shorter than the longest one
    count as padded by zeros, as is one whose length `parts` doesn't divide.
    Components beyond MOST / SCALE count as that. Rows with a null key are
    encoded too, but seed codebooks only if there are too few others; of rows with
    one key, that with the smaller vector comes first. With fewer than `entries`
    rows the codebooks are that much smaller. Equally near entries: the first. `part`
    is the group, which may be null. An empty table gives an empty one and empty
    codebooks. Further columns aren't read, whatever their names.
    """
    scratch = scratch or Scratch(df.sparkSession, "codes")
    good = usable(df, vector)
    dim = good.agg(F.max(F.size(F.col(f"`{vector}`")))).first()[0] or 0
    dim += -dim % parts
    rows = good.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("id"), F.col(f"`{group}`").alias("part"), scaled(vector, parts, dim).alias("parts"))
    rows = scratch.cut(rows, "rows")  # fixes row
    each = rows.select("row", F.posexplode("parts").alias("position", "part"))
    values = scratch.cut(each.groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight")), "values")
    books = seeds(rows, parts, dim // parts, entries)
    if not len(books[0]):
        return rows.select("id", "part", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")), books
    for _ in range(rounds):
        books = moved(values, books)
    coded = scratch.cut(assigned(values, books).select("position", "part", "code", "error"), "coded")
    own = each.join(coded, ["position", "part"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("position", "code"))).alias("codes"), F.sum("error").alias("error"))
    out = rows.select("row", "id", "part").join(own, "row")
    return out.select("id", "part", F.col("codes.code").alias("codes"), "error"), books


def decompress(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """coded with `vector`: what the codes stand for, as doubles."""
    entries = [F.from_json(F.lit(str(b.tolist())), "array<array<int>>") for b in books]
    parts = [F.get(e, F.get("codes", F.lit(p))) for p, e in enumerate(entries)]
    return coded.withColumn("vector", F.transform(F.concat(*parts), lambda x: x / SCALE))


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: all usable vectors in four bytes each."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    scratch = Scratch(spark, "codes")
    found, books = compress(vectors, scratch=scratch)
    found = scratch.cut(found, "found")
    sums = scratch.cut(found.groupBy(F.col("part").alias("label")).agg(F.sum("error").alias("label_error")), "sums")
    code = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))).alias("code")
    out = found.join(sums, F.col("part").eqNullSafe(F.col("label")))
    return out.select(F.col("id").alias("vec_id"), code, "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same over all parts, entry by entry."""
    near = """
a{k} AS MATERIALIZED (SELECT s.vec_id, s.p, any_value(s.x) AS x, arg_min(b.e, {{'d': {d}, 'e': b.e}}) AS e, min({d})::BIGINT AS d
  FROM s JOIN b{k} b ON b.p = s.p GROUP BY s.vec_id, s.p)"""
    move = """
b{n} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (SELECT p, e, list(v ORDER BY i) AS x FROM (
  SELECT p, e, i, floor(sum(x[i]) / count(*)) AS v FROM a{k}, range(1, 17) r(i) GROUP BY p, e, i) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""
    d = "list_sum(list_transform(list_zip(s.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(near.format(k=k, d=d))
        if k < ROUNDS:
            steps.append(move.format(k=k, n=k + 1))
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT vec_id, p, x[p * 16 + 1 : p * 16 + 16] AS x FROM v, range({PARTS}) r(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM s
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {ENTRIES})),
{','.join(steps)},
h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: y::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) AS h FROM b{ROUNDS}),
c AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT c.vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
FROM c JOIN v ON v.vec_id = c.vec_id, h
"""


QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLE = {"op12_vector_codes": _sql()}
