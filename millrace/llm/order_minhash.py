"""Document fingerprints: order MinHash.

The k-mers of a text are numbered by occurrence, so that the second "banana" of
a text isn't its first. For each of m random orders of these numbered k-mers the
LENGTH first ones are selected, put back into the order of the text, and hashed
as a tuple. Two texts share a tuple only if they share the selected k-mers and
these come in one order, so the share of equal tuples falls with the edit
distance, where plain MinHash doesn't see rearranged text.

A text is read in chunks. One too long for the counts of its k-mers to stay in
memory is read several times, each time for a part of the k-mers; selections of
chunks and parts merge, so the fingerprint is the same.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import U64, flat, mapped, mix, strings

K = 6
LENGTH = 2
TUPLES = 64
#: Bytes of text that are hashed at once.
CHUNK = 1 << 20
#: Numbered k-mers that are put in order at once: TUPLES x BLOCK numbers stay in the cache.
BLOCK = 1 << 12
#: A k-mer's hash has 44 bits, so that it and a place in a chunk make one number to sort by.
PLACE = U64(20)
#: Bytes of text whose k-mers are counted in one reading.
COUNTED = 4 << 20

_TIMES, _NUMBER, _TUPLE = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93), U64(0xC2B2AE3D27D4EB4F)
#: x -> a x modulo 2^32 for odd a is an order of all 32-bit numbers.
A = (mix(np.arange(1, TUPLES + 1, dtype=U64)) >> U64(32)).astype(np.uint32)[:, None] | np.uint32(1)
LAST = np.uint32(0xFFFFFFFF)


def code_points(pieces: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The code points of consecutive pieces of UTF-8, chunk by chunk."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for piece in pieces:
        for at in range(0, len(piece), CHUNK):
            if text := decoder.decode(piece[at : at + CHUNK].tobytes()):
                yield np.frombuffer(text.encode("utf-32-le"), np.uint32)


def kmers(pieces: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(place of the first, hashes) of a text's k-mers, chunk by chunk; a text shorter than k is one."""
    held, at, found = np.zeros(0, np.uint32), 0, False
    for chunk in code_points(pieces):
        held = np.concatenate([held, chunk]) if len(held) else chunk
        n = len(held) - K + 1
        if n > 0:
            found = True
            yield at, _hashes(held, n, K)
            at += n
            held = held[n:]
    if not found and len(held):
        yield 0, _hashes(held, 1, len(held))


def _hashes(points: np.ndarray, n: int, k: int) -> np.ndarray:
    h = np.full(n, k, U64)
    for j in range(k):
        h *= _TIMES
        h += points[j : j + n]
    return mix(h) >> PLACE


def occurrences(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of equal hashes before each, distinct hashes in order, how often each is there)."""
    both = h << PLACE
    both |= np.arange(len(h), dtype=U64)
    both.sort()
    by = both >> PLACE
    first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
    n = np.diff(np.append(first, len(h)))
    number = np.empty(len(h), np.int64)
    number[both & U64((1 << 20) - 1)] = np.arange(len(h)) - np.repeat(first, n)
    return number, by[first], n


class Selection:
    """The first LENGTH numbered k-mers of each order: rank and place in one number, and the k-mer's hash."""

    room = np.empty((TUPLES, BLOCK), np.uint32)

    def __init__(self):
        self.keys, self.hashes = np.zeros((TUPLES, 0), U64), np.zeros((TUPLES, 0), U64)

    def add(self, places: np.ndarray, h: np.ndarray, number: np.ndarray) -> None:
        x = (mix(h + number.astype(U64) * _NUMBER) >> U64(32)).astype(np.uint32)
        rows = np.arange(TUPLES)
        for at in range(0, len(x), BLOCK):
            some = x[at : at + BLOCK]
            rank = np.multiply(some, A, out=self.room[:, : len(some)])
            keys, hashes = [self.keys], [self.hashes]
            for _ in range(min(LENGTH, rank.shape[1])):
                best = rank.argmin(axis=1)
                keys.append((rank[rows, best].astype(U64) << U64(32) | places[at + best].astype(U64))[:, None])
                hashes.append(h[at + best][:, None])
                rank[rows, best] = LAST
            keys, hashes = np.concatenate(keys, axis=1), np.concatenate(hashes, axis=1)
            if keys.shape[1] > LENGTH:
                keep = np.argsort(keys, axis=1)[:, :LENGTH]
                keys, hashes = np.take_along_axis(keys, keep, 1), np.take_along_axis(hashes, keep, 1)
            self.keys, self.hashes = keys, hashes

    def tuples(self) -> np.ndarray:
        """A 32-bit hash of each order's k-mers, as they follow each other in the text."""
        order = np.argsort(self.keys & U64(LAST), axis=1)
        out = np.zeros(TUPLES, U64)
        for j in range(order.shape[1]):
            out = mix(out * _TUPLE + np.take_along_axis(self.hashes, order[:, j : j + 1], 1)[:, 0])
        return (out >> U64(32)).astype(np.uint32)


def fingerprint(pieces: list[np.ndarray]) -> np.ndarray:
    """The tuples' hashes of the text that the pieces of UTF-8 make; none of an empty one."""
    total = sum(map(len, pieces))
    if not total:
        return np.zeros(0, np.uint32)
    if total <= CHUNK:
        pieces = [np.concatenate(pieces)]
    readings, found = -(-total // COUNTED), Selection()
    for r in range(readings):
        known, counts = np.zeros(0, U64), np.zeros(0, np.int64)
        for at, h in kmers(pieces):
            places = np.arange(at, at + len(h))
            if readings > 1:
                own = np.flatnonzero(h % U64(readings) == U64(r))
                places, h = places[own], h[own]
                if not len(h):
                    continue
            number, distinct, n = occurrences(h)
            if total > CHUNK:  # more chunks than one
                where = np.searchsorted(known, distinct)
                old = np.zeros(len(distinct), np.int64)
                seen = np.flatnonzero(where < len(known))
                seen = seen[known[where[seen]] == distinct[seen]]
                old[seen] = counts[where[seen]]
                counts[where[seen]] += n[seen]
                number = number + old[np.searchsorted(distinct, h)]
                new = np.ones(len(distinct), bool)
                new[seen] = False
                known, counts = np.insert(known, where[new], distinct[new]), np.insert(counts, where[new], n[new])
            found.add(places, h, number)
    return found.tuples()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuples; 1 for two empty texts, 0 for one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def text_of(tuples: np.ndarray) -> str:
    return tuples.astype(">u4").tobytes().hex()


def likeness_of(a: Column | str, b: Column | str) -> Column:
    """likeness() of two columns of fingerprints."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    equal = F.aggregate(F.sequence(F.lit(0), F.lit(TUPLES - 1)), F.lit(0), lambda n, k: n + (F.substring(a, k * 8 + 1, F.lit(8)) == F.substring(b, k * 8 + 1, F.lit(8))).cast("int"))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(equal / TUPLES)


def fingerprints(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(id, fingerprint) for each row of df: TUPLES hashes of eight hex digits, or an empty string for a null or empty text.

    Repeated rows and ids give a row each, an empty table none; ids may be null;
    further columns aren't read. Whole texts are read, by chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(strings(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([text_of(fingerprint([data[i:j]])) for i, j in zip(off[:-1], off[1:])], pa.string())], names=["id", "fingerprint"])

    own = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return mapped(own, run, f"id {own.schema['id'].dataType.simpleString()}, fingerprint string")


def n_points(data: np.ndarray) -> int:
    return sum(int(((data[i : i + CHUNK] & 0xC0) != 0x80).sum()) for i in range(0, len(data), CHUNK))


def head(data: np.ndarray, n: int) -> np.ndarray:
    """The first n code points of UTF-8, or all."""
    for i in range(0, len(data), CHUNK):
        starts = np.flatnonzero((data[i : i + CHUNK] & 0xC0) != 0x80)
        if n < len(starts):
            return data[: i + int(starts[n])]
        n -= len(starts)
    return data


def cyclic(df: DataFrame, key: str, text: str) -> DataFrame:
    """(bucket, guest, id, text), so that in a bucket, ordered, each row is followed by the next of all: descending ids, then the largest.

    Two passes over ids and text hashes: Spark's range partitioning cuts the
    order into buckets, whose largest entries, a bounded number, reach the driver;
    then each row finds its bucket among them, and the first text of each bucket is
    also a guest at the end of the one before. So texts move once. Texts follow
    their hash among rows of one id, so that these may have many buckets too.
    """
    spark = df.sparkSession
    own = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    own = own.withColumn("key", F.struct("id", F.xxhash64("text").alias("t")))
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = own.select("key").repartitionByRange(n, F.desc("key")).groupBy(F.spark_partition_id()).agg(F.max("key").alias("key"))
    bounds = sorted((tuple(r.key) for r in ranges.collect()), key=lambda k: (k[0] is not None, k), reverse=True)
    wide = max(1, int(len(bounds) ** 0.5))
    entries = [{"id": i, "t": t} for i, t in bounds]
    groups = [entries[i : i + wide] for i in range(0, len(entries), wide)]
    array = "array<struct<id: bigint, t: bigint>>"
    own = own.withColumn("low", F.from_json(F.lit(json.dumps([g[0] for g in groups])), array)).withColumn("group", F.expr("size(filter(low, b -> b >= key)) - 1"))
    own = own.withColumn("low", F.get(F.from_json(F.lit(json.dumps(groups)), f"array<{array}>"), "group")).withColumn("at", F.expr("size(filter(low, b -> b >= key)) - 1"))
    own = own.select((F.col("group") * wide + F.col("at")).alias("bucket"), "id", "text", "key", (F.get("low", "at") == F.col("key")).alias("first"))
    guests = own.filter("first").groupBy("bucket").agg(F.max("text").alias("text"), F.max("key").alias("key"))
    before = F.pmod(F.col("bucket") - 1, F.lit(max(1, len(bounds)))).cast("int")
    both = own.select("bucket", F.lit(False).alias("guest"), "id", "text", "key").unionByName(guests.select(before.alias("bucket"), F.lit(True).alias("guest"), "key.id", "text", "key"))
    return both.repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc("key"), F.desc("text")).select("bucket", "guest", "id", "text")


EDITED = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """EDITED rows: each text beside one whose last third is replaced by the beginning of the next.

    Next is the row with the next smaller key; rows of one key follow by the hash
    of their text, then their text, descending; null keys come last, and after the last row the
    first. A single row follows itself. Null texts are empty. An empty table
    gives no rows; further columns aren't read. Rows alike in key and text
    stand in one bucket, where they take time but no memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose next one isn't read yet
        for b in batches:
            out = []
            data, off = flat(strings(b.column(3)))
            for k, (bucket, guest, key) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                own = data[off[k] : off[k + 1]]
                prints = fingerprint([own]) if held is None or len(own) != len(held[2]) or (own != held[2]).any() else held[4]
                if held is not None and held[0] == bucket:
                    out.append(compared(held, own, prints))
                held = None if guest else (bucket, key, own, n_points(own), prints)
            if held is not None and len(held[2]) < len(data):  # lets go of the batch
                held = (*held[:2], held[2].copy(), *held[3:])
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    def compared(held: tuple, after: np.ndarray, prints: np.ndarray) -> dict:
        _, key, own, n, mine = held
        pieces = [head(own, n - n // 3), head(after, n // 3)]
        sha = hashlib.sha256()
        for p in pieces:
            sha.update(p)
        other = fingerprint(pieces)
        return {
            "id": key,
            "n_chars": n,
            "edited_sha256": sha.hexdigest(),
            "fingerprint": text_of(mine),
            "edited_fingerprint": text_of(other),
            "near_edited": likeness(mine, other),
            "near_next": likeness(mine, prints),
        }

    kind = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return mapped(cyclic(df, key, text), run, EDITED)


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for all documents."""
    return edited(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).withColumnRenamed("id", "doc_id")


QUERIES = {"op13_order_minhash": op13_order_minhash}
#: SQL has none of the hashes; the tests compute them number by number.
ORACLE: dict[str, str] = {}
