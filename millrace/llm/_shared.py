"""Helpers that the operators of this subpackage share.

* ``Scratch``, of ``millrace.scratch``, cuts lineage by written tables.
* ``components`` labels connected components without collecting any edge.
* ``slices``, ``flat`` and the ``word_*`` functions work on the bytes of an
  Arrow string column, so that a batch is tokenised and hashed by numpy.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch, is_local, shared_dir

U64 = np.uint64
#: Odd base of the polynomial word hash; fixed, so hashes agree between runs.
BASE = 0x9E3779B97F4A7C15
#: A worker holds some fifty bytes for each byte of a slice.
SLICE_BYTES = 1 << 20
#: Most bytes of an Arrow batch, of which the JVM and the worker hold one each.
BATCH_BYTES = 4 << 20


_kept: dict[tuple[str, str], dict] = {}


def kept(module: str, what: str = "") -> dict:
    """What tasks of a module keep in a Python worker for its later tasks.

    Workers outlive queries and stages, so it is emptied when tasks of another module come.
    """
    return _kept.setdefault((module, what), {})


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which first forgets what other modules keep in this worker, and at its end gives freed memory back to the system."""
    own = run.__module__

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(own)
        yield from run(batches)
        trim()

    return whole


def forget(own: str) -> None:
    others = [d for (module, _), d in _kept.items() if module != own and d]
    for d in others:
        d.clear()
    if others:
        gc.collect()
        trim()


def trim() -> None:
    """Allocators keep freed pages for later; a worker that waits for its next task needs none."""
    pa.default_memory_pool().release_unused()
    free = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if free is not None:
        free(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow in batches of bounded size; lowers the session's bound on them if it is larger."""
    conf = df.sparkSession.conf
    now = conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(lean(run), schema)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(id, component) for every endpoint of edges (u, v).

    Alternates large-star and small-star steps, which shrink any graph to
    stars around the smallest id in about log² rounds; every round is two
    grouped minima and two joins, and only two numbers reach the driver.
    The first minima are written before they are joined: a hub's edges are then
    a skewed side of a join of two plain shuffles, which Spark splits.
    """
    e = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v")
        .distinct()
    )
    e, before = scratch.cut(e, "edges"), None
    while True:
        n, mark = e.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))
        ).first()
        if (n, mark) == before or n == 0:
            break
        before = (n, mark)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # a node with very many smaller neighbours is a skewed key here, which isn't split, in one
        # round: after it, these neighbours are joined to the smallest of them
        second = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(second, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(second)
        old, e = e, scratch.cut(small.filter("u <> v").distinct(), "edges")
        scratch.drop(old, low)
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    centres = e.select(F.col("v").alias("u")).distinct()
    return stars.union(centres.select("u", "u")).groupBy(F.col("u").alias("id")).agg(
        F.min("component").alias("component")
    )


def roots(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(id, component) for every node of a forest of links (id, above), where each id is named once and above is smaller.

    Every round replaces what stands above a node by what stands above that, so
    a chain of n links takes about log n rounds of one join. Its other side has a
    row an id, and both are plain shuffles, so Spark splits a node with many below it.
    """
    e = scratch.cut(links.select("id", F.col("above").alias("component"), F.lit(True).alias("moved")), "above")
    while not e.filter("moved").isEmpty():
        up = e.select(F.col("id").alias("component"), F.col("component").alias("next"))
        old = e
        e = scratch.cut(e.join(up, "component", "left").select("id", F.coalesce("next", "component").alias("component"), F.col("next").isNotNull().alias("moved")), "above")
        scratch.drop(old)
    tops = e.select("component").distinct()
    return scratch.cut(e.select("id", "component").union(tops.select("component", "component")), "labels")


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A null-free large_string array of the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the offset of each text, of a strings() array."""
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch whose texts have about `limit` bytes, one text at least."""
    if not batch.num_rows:
        return
    column = strings(batch.column(batch.schema.get_field_index(text)))
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        yield batch.slice(at, end - at), column.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n, kept by the worker up to 4 MB of text."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        made = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(size, base, dtype=U64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        if size > 4 << 20:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def word_runs(is_word: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of word bytes, and the first word of each text.

    A run never reaches over the end of a text.
    """
    n = len(is_word)
    start = is_word.copy()
    start[1:] &= ~is_word[:-1]
    inner = off[:-1][off[:-1] < n]
    start[inner] = is_word[inner]
    end = np.zeros(n + 1, bool)
    end[1:] = is_word
    end[:n] &= ~is_word
    cut = off[1:][off[1:] > 0]
    end[cut] |= is_word[cut - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    # an end that another text's word follows at once was masked above
    first = np.searchsorted(starts, off)
    return starts, ends, first


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends], equal for equal bytes."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    total[1:] = data
    total[1:] += U64(1)
    total[1:] *= up[: len(data)]
    np.cumsum(total[1:], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; the last k - 1 are meaningless."""
    h = words.copy()
    for j in range(1, k):
        h[:-j] = h[:-j] * U64(0xC2B2AE3D27D4EB4F) + words[j:]
        h[:-j] ^= h[:-j] >> U64(29)
    return mix(h)
