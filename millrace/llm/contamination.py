"""Benchmark decontamination: SimHash windows the size of the items.

Items and documents become words (letters and digits, A-Z in lower case) and
shingles of SHINGLE words. An item of n shingles is looked for in all windows
of about n shingles of each document, every STEP shingles (more for long ones;
an item of fewer than SHORT in all windows of exactly n, so a copy has its bits):

1. The SimHash of a window has a bit for each of 64 hash bits, set where most
   of the window's shingles, counted as often as they occur, have it. Windows
   share running sums, so one costs a few dozen byte operations; below LONG
   shingles the sums are bytes, from there on they are of 32 bits.
2. The 64 bits are four blocks of 16. A fingerprint within RADIUS bits of an
   item's is within RADIUS // 4 bits of it in at least one block, so a table of
   2^16 sets of items for each block finds all items within the radius.
3. A candidate is verified exactly: the best window of the item's length near
   by must have a weighted similarity (smaller over larger counts, summed over
   shingles) of SIMILARITY or more.

Items go to all tasks as arrays, sent with the function, so their number is
bounded: a benchmark of more than ITEMS_A_PART items is taken in parts, with
one pass over the documents each, whose result is written before the next part
is fetched.

A text of fewer words than a shingle is one shingle, of the whole sequence: an
item that is so short matches just the documents that consist of its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import batched, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import BASE, LOWER, U64, Scratch, flat, mapped, mix, shingle_hashes, slices, strings, word_hashes, word_runs

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 4
STEP = 2
#: Windows below this size have every length, and start at every shingle.
SHORT = 16
#: Windows of this size or more start at every second block.
WIDE = 24
#: Windows of this size or more, whose counts a byte can't hold, are of blocks of LONG_STEP.
LONG = 256
LONG_STEP = 8
#: Window sizes grow by this factor; an item has the nearest one.
RATIO = 1.15
ITEMS_A_PART = 2000
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def shingled(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, offsets): the shingles of each text of a strings() array.

    A text of fewer words than a shingle is one shingle, with its own hash.
    """
    data, off = flat(column)
    starts, ends, first = word_runs(WORD[data], off)
    words = word_hashes(LOWER[data], starts, ends)
    n = np.diff(first)
    many = shingle_hashes(words, k)
    last = np.ones(len(words), bool)
    # a text's last k - 1 words begin no shingle
    for j in range(1, k):
        at = first[1:] - j
        last[at[(n >= j)]] = False
    count = np.where(n >= k, n - k + 1, n > 0)
    off = np.concatenate([[0], np.cumsum(count)])
    short = np.flatnonzero((n > 0) & (n < k))
    if not len(short):
        return many[last], off
    whole = n[short].astype(U64)  # the length keeps it apart
    for j in range(k - 1):
        some = n[short] > j
        whole[some] = mix(whole[some] * U64(31) + words[first[short[some]] + j])
    out = np.empty(off[-1], U64)
    rest = np.ones(off[-1], bool)
    rest[off[short]] = False
    out[off[short]], out[rest] = whole, many[last]
    return out, off


def ladder(largest: int) -> np.ndarray:
    """Window sizes up to the largest item, of whole blocks each."""
    sizes = list(range(1, SHORT + 1))
    while sizes[-1] < largest:
        step = block_of(int(sizes[-1] * RATIO))
        sizes.append(max(sizes[-1] // step * step + step, step * round(sizes[-1] * RATIO / step)))
    return np.array(sizes)


def block_of(size: int) -> int:
    """Shingles a block, for windows of this size."""
    return 1 if size < SHORT else STEP if size < LONG else LONG_STEP


def stride_of(size: int) -> int:
    """Shingles from one window of this size to the next: about 1/32 of long ones."""
    if size < LONG:
        return 1 if size < SHORT else STEP if size < WIDE else 2 * STEP
    return size // LONG * LONG_STEP


def block_sums(shingles: np.ndarray, block: int = STEP) -> np.ndarray:
    """Running sums of each hash bit over blocks of shingles, modulo 256 but for the blocks of long windows."""
    n = len(shingles) // block
    bits = np.unpackbits(shingles[: n * block].view(np.uint8)).reshape(n, block, 64)
    one = bits[:, 0]
    for j in range(1, block):
        one = one + bits[:, j]
    out = np.zeros((n + 1, 64), np.uint32 if block == LONG_STEP else np.uint8)
    np.cumsum(one, axis=0, dtype=out.dtype, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of `size` shingles, one each stride; sums are of the blocks of this size."""
    w, every = size // block_of(size), stride_of(size) // block_of(size)
    if len(sums) <= w:
        return np.zeros(0, U64)
    count = sums[w:][::every] - sums[:-w][::every]
    return np.packbits(count > size // 2, axis=1).view(U64).ravel()


def simhash(shingles: np.ndarray) -> np.uint64:
    """The fingerprint of a whole item."""
    bits = np.unpackbits(shingles.view(np.uint8)).reshape(-1, 64).sum(axis=0)
    return np.packbits(bits > len(shingles) // 2).view(U64)[0]


class Items:
    """Benchmark items, ready for search: plain arrays, sent with the function."""

    def __init__(self, ids: list[int], texts: list[str | None], shingle: int, radius: int):
        self.shingle, self.radius, self.ids, self.shingles = shingle, radius, [], []
        hashes, off = shingled(strings(pa.array(texts, pa.large_string())), shingle)
        for i, a, b in zip(ids, off[:-1], off[1:]):
            if b > a:
                self.ids.append(i)
                self.shingles.append(hashes[a:b])
        self.prints = np.array([simhash(s) for s in self.shingles], U64)
        sizes = ladder(max([len(s) for s in self.shingles], default=0))
        lengths = np.array([len(s) for s in self.shingles])
        nearest = np.abs(sizes[None] - lengths[:, None]).argmin(axis=1) if len(lengths) else np.zeros(0, int)
        self.by_size = {int(sizes[k]): np.flatnonzero(nearest == k) for k in sorted(set(nearest.tolist()))}
        #: Marks, by 20 bits of the hash, the shingles that any item has.
        self.known = np.zeros(1 << 20, np.uint8)
        if self.shingles:
            self.known[(np.concatenate(self.shingles) >> U64(44)).astype(np.int64)] = 1

    def tables(self) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
        """size: for each 64 items, their numbers and a table of each block's 2^16 values."""
        near = np.bitwise_count(np.arange(1 << 16, dtype=np.uint16)) <= self.radius // BLOCKS
        out = {}
        for size, members in self.by_size.items():
            out[size] = []
            for at in range(0, len(members), 64):
                own = members[at : at + 64]
                table = np.zeros((BLOCKS, 1 << 16), U64)
                for bit, item in enumerate(own):
                    for b in range(BLOCKS):
                        part = int(self.prints[item] >> U64(16 * b)) & 0xFFFF
                        table[b][np.flatnonzero(near) ^ part] |= U64(1) << U64(bit)
                out[size].append((own, table))
        return out


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Smaller over larger counts of all shingles."""
    if not len(a) or not len(b):
        return 0.0
    values, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(inverse[: len(a)], minlength=len(values))
    y = np.bincount(inverse[len(a) :], minlength=len(values))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def best_window(doc: np.ndarray, item: np.ndarray, at: int, slack: int, least: float) -> tuple[float, int]:
    """(similarity, start) of the best window of the item's length within slack of `at`; 0 if below least."""
    n = len(item)
    low = max(0, at - slack)
    high = min(max(0, len(doc) - n), at + slack)
    hits = np.isin(doc[low : high + n], item).astype(np.int32)
    sums = np.concatenate([[0], np.cumsum(hits)])
    starts = np.arange(low, max(low, high) + 1)
    inside = sums[np.minimum(starts - low + n, len(hits))] - sums[starts - low]
    best = (0.0, int(starts[0]))
    # the similarity is below inside / n, so starts with fewer hits can't be better
    for k in np.argsort(-inside, kind="stable"):
        if inside[k] < max(best[0], least) * n - 1e-9:
            break
        s = weighted_similarity(doc[starts[k] : starts[k] + n], item)
        if s > best[0]:
            best = (s, int(starts[k]))
    return best


def candidates_in(items: Items, tables: dict, shingles: np.ndarray, off: np.ndarray, similarity: float = SIMILARITY) -> Iterator[tuple[int, int, int]]:
    """(text, item, start) of windows whose fingerprint is within the radius of an item's.

    Windows run over the ends of texts, and past the last one into padding; one
    is a candidate for each text that it overlaps and that is long enough for
    the similarity, so its start may lie before the text's.
    """
    lengths = np.diff(off)
    longest = int(lengths.max(initial=0))
    least = {item: similarity * len(items.shingles[item]) - 1e-9 for groups in tables.values() for own, _ in groups for item in own}
    tables = {size: groups for size, groups in tables.items() if longest and any(least[item] <= longest for own, _ in groups for item in own)}
    sums = {}
    for block in {block_of(size) for size in tables}:
        # padding as noise: equal bits would outvote those of a text shorter than the window
        more = max(size for size in tables if block_of(size) == block)
        pad = mix(np.arange(1, more + -(len(shingles) + more) % block + 1, dtype=U64) * U64(BASE))
        sums[block] = block_sums(np.concatenate([shingles, pad]), block)
    marks = np.concatenate([[0], np.cumsum(items.known[(shingles >> U64(44)).astype(np.int64)], dtype=np.int64)])
    for size, groups in tables.items():
        found = fingerprints(sums[block_of(size)], size)[: -(-len(shingles) // stride_of(size))]
        parts = found.view(np.uint16).reshape(-1, BLOCKS)
        for own, table in groups:
            mask = table[0][parts[:, 0]]
            for b in range(1, BLOCKS):
                mask |= table[b][parts[:, b]]
            some = np.flatnonzero(mask)
            mask = mask[some]
            for bit, item in enumerate(own):
                at = some[(mask >> U64(bit)) & U64(1) == 1]
                at = at[np.bitwise_count(found[at] ^ items.prints[item]) <= items.radius] * stride_of(size)
                if not len(at):
                    continue
                # the marked shingles around bound the similarity from above
                n, slack = len(items.shingles[item]), size
                low, high = np.maximum(at - slack, 0), np.minimum(at + n + slack, len(shingles))
                at = at[marks[high] - marks[low] >= 0.5 * n]
                fit = np.flatnonzero(lengths >= least[item])
                first = np.searchsorted(off[fit + 1], at, side="right").tolist()
                last = np.searchsorted(off[fit], at + size, side="left").tolist()
                for x, a, b in zip(at.tolist(), first, last):
                    for i in fit[a:b].tolist():
                        yield i, int(item), x


FOUND = "item_id long, similarity double, start int, n_shingles int"


def search(items: Items, similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of matches(), from batches of (id, text) to (id, FOUND) rows."""
    held: dict[str, dict] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held.setdefault("tables", items.tables()) if "tables" not in held else held["tables"]
        for whole in batches:
            for batch, column in slices(whole, limit=1 << 20):
                shingles, off = shingled(column, items.shingle)
                best: dict[tuple[int, int], tuple[float, int]] = {}
                done: set[tuple[int, int, int]] = set()
                for i, item, at in candidates_in(items, tables, shingles, off, similarity):
                    doc, own = shingles[off[i] : off[i + 1]], items.shingles[item]
                    slack = len(own)
                    # windows half an item apart see the same places
                    spot = (i, item, (at - off[i]) // max(1, slack // 2))
                    if spot in done:
                        continue
                    done.add(spot)
                    s, start = best_window(doc, own, int(at - off[i]), 2 * slack, similarity)
                    if s >= similarity and s > best.get((i, item), (0.0, 0))[0]:
                        best[i, item] = (s, start)
                rows = sorted(best)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([i for i, _ in rows], pa.int64())),
                        pa.array([items.ids[j] for _, j in rows], pa.int64()),
                        pa.array([best[x][0] for x in rows], pa.float64()),
                        pa.array([best[x][1] for x in rows], pa.int32()),
                        pa.array([len(items.shingles[j]) for _, j in rows], pa.int32()),
                    ],
                    names=["id", "item_id", "similarity", "start", "n_shingles"],
                )

    return run


def matches(docs: DataFrame, key: str, text: str, items: Items, similarity: float) -> DataFrame:
    """(id, FOUND) rows: the best place of each item that a document holds; start counts shingles, id is the key, of any type."""
    own = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return mapped(own, search(items, similarity), f"id {own.schema['id'].dataType.simpleString()}, {FOUND}")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS, scratch: Scratch | None = None) -> DataFrame:
    """(id, FOUND) rows for all documents and items, one for each pair that matches.

    Keys are handed through as they are: a document without one is reported with a null.
    Empty and null items have no shingle and match nothing, and so do such
    documents; long texts are read whole; repeated rows of documents give
    repeated results, those of items don't; of places of equal similarity one
    is reported; empty tables give an empty result; other columns are not read.
    """
    own = benchmark.select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("t")).filter("t is not null").distinct()
    # Spark sorts the items; the driver has one part of them at a time
    parts = batched(own.orderBy("i", "t").toLocalIterator(), ITEMS_A_PART)
    part, more = next(parts, ()), next(parts, None)

    def one(part: tuple) -> DataFrame:
        return matches(docs, key, text, Items([r["i"] for r in part], [r["t"] for r in part], shingle, radius), similarity)

    if more is None:
        return one(part)
    scratch = scratch or Scratch(docs.sparkSession, "items")
    found = scratch.cut(one(part), "found")
    for part in chain([more], parts):
        found = found.unionByName(scratch.cut(one(part), "found"))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents that hold no benchmark item, whatever their ids: the digest of a text tells which ones do."""
    known = F.sha2(F.col("text").cast("binary"), 256)
    bad = scratch.cut(contaminated(docs.select(known.alias("digest"), "text"), benchmark, key="digest").select("id").distinct(), "leaks")
    return docs.join(bad.select(F.col("id").alias("_leak")), known == F.col("_leak"), "left_anti")


def op1_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, similarity: the documents that hold benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.round("similarity", 9).alias("similarity"), "start", "n_shingles")


QUERIES = {"op1_simhash_windows": op1_simhash_windows}
ORACLE: dict[str, str] = {}
