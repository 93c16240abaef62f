"""Token ids in a binary format, with Elias-Fano coded document boundaries.

A store is a Parquet table whose rows are segments, in ascending order of
document ids: (shard, seq, first, n_docs, n_tokens, block); `first` counts the
tokens of the shard before the segment. Parquet gives atomic commits on any file
system; the format itself is the self-contained block:

    4 bytes   b"MRT1"
    40 bytes  five little-endian int64: documents, documents with a null id
              (they come first), tokens, first id, bytes of an id (2 or 4)
    Elias-Fano sequence of the document ids less the first id
    Elias-Fano sequence of the documents' ends in the id array
    the concatenated ids, little-endian

An Elias-Fano sequence of n values up to u takes n * (2 + log2(u / n)) bits:
the low bits of each value packed, the high bits as a bit vector in which
select(i) finds value i. Its select structure is one 32-bit count of ones for
each 512 bits.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import Scratch, flat, kept, mapped, slices

MAGIC = b"MRT1"
RANKED = 512
#: Tokens after which a segment ends; a longer document is one segment.
SEGMENT = 1 << 20
END_ID = 2


class EliasFano:
    """A non-decreasing sequence of values from 0 to `most`."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        words = np.pad(high, (0, -len(high) % (RANKED // 8))).reshape(-1, RANKED // 8)
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.uint32)
        self.ranks = np.concatenate([[0], np.cumsum(ones, dtype=np.uint32)]).astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n, most = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (most // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        high = np.zeros(n + (most >> low_bits) + 1, np.uint8)
        high[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, low_bits, low, np.packbits(high, bitorder="little"))

    def select(self, i: int) -> int:
        """Value i, from a few dozen bytes of the sequence."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        word = int(np.searchsorted(self.ranks, i, side="right")) - 1
        at = word * (RANKED // 8)
        inside = np.flatnonzero(np.unpackbits(self.high[at : at + RANKED // 8], bitorder="little"))
        high = word * RANKED + int(inside[i - int(self.ranks[word])]) - i
        value = high << self.low_bits
        for b in range(self.low_bits):
            p = i * self.low_bits + b
            value |= (int(self.low[p >> 3]) >> (p & 7) & 1) << b
        return value

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return high | low

    def pack(self) -> bytes:
        return struct.pack("<4q", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def unpack(cls, data: memoryview) -> tuple["EliasFano", int]:
        """The sequence at the start of data, and its bytes."""
        n, low_bits, low, high = struct.unpack_from("<4q", data)
        end = 32 + low + high
        return cls(n, low_bits, np.frombuffer(data[32 : 32 + low], np.uint8), np.frombuffer(data[32 + low : end], np.uint8)), end


def pack_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    head = struct.pack("<5q", len(doc_ids), len(doc_ids) - len(known), int(lengths.sum()), base, width)
    ends = EliasFano.of(np.cumsum(lengths)).pack()
    return b"".join([MAGIC, head, EliasFano.of(known.astype(object) - base if len(known) else known).pack(), ends, ids.astype(f"<u{width}").tobytes()])


class Block:
    """A segment read back; documents are numbered from 0 in it."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a token block")
        self.n, self.nulls, self.n_tokens, self.base, self.width = struct.unpack_from("<5q", data, 4)
        self.keys, used = EliasFano.unpack(data[44:])
        self.ends, more = EliasFano.unpack(data[44 + used :])
        self.ids = np.frombuffer(data[44 + used + more :], f"<u{self.width}")
        if len(self.ids) != self.n_tokens:
            raise ValueError("a token block is cut short")

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.base + int(k) for k in self.keys.all()]

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def tokens(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.ids[a:b]


#: Distinct pieces of text that a worker keeps with their ids.
KEPT = 1_000_000
ENCODE_SLICE = 16 << 20


class PieceEncoder:
    """Encodes texts by the library, each distinct piece once.

    The byte-level tokenizer's own splitting never joins what stands before and
    after a single blank between two characters that are no white space, so
    texts are cut there, and equal pieces have equal ids wherever they stand.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = pa.array([], pa.large_binary())
        self.ids, self.n = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    @staticmethod
    def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Ascending offsets of the pieces' starts, and the end of the data."""
        mark = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            at = np.flatnonzero(data[1:-1] == 32) + 1
            # beside the blank: printable ASCII, or letters of U+00C0 to U+07FF
            before, after, lead = data[at - 1], data[at + 1], data[np.maximum(at - 2, 0)]
            ok = ((before > 32) & (before < 127)) | ((before >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF))
            ok &= ((after > 32) & (after < 127)) | ((after >= 0xC3) & (after <= 0xDF))
            mark[at[ok]] = True
        mark[off] = True
        return np.flatnonzero(mark)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number by text) of a strings() array."""
        data, off = flat(column)
        cut = self.cuts(data, off)
        if len(cut) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        distinct, which = coded.dictionary, coded.indices.to_numpy()
        known = pc.index_in(distinct, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(known < 0)
        fresh = distinct.take(pa.array(new))
        found = [e.ids for e in self.tokenizer.encode_batch_fast(fresh.cast(pa.large_string()).to_pylist(), add_special_tokens=False)]
        fresh_n = np.fromiter(map(len, found), np.int64, len(found))
        fresh_ids = np.fromiter((i for f in found for i in f), np.uint32, int(fresh_n.sum()))
        known[new] = len(self.n) + np.arange(len(new))
        n, ids = np.concatenate([self.n, fresh_n]), np.concatenate([self.ids, fresh_ids])
        first = np.concatenate([[0], np.cumsum(n)])
        if len(n) <= KEPT:
            self.words, self.ids, self.n = pa.concat_arrays([self.words, fresh]), ids, n
        piece = known[which]
        count = n[piece]
        to = np.concatenate([[0], np.cumsum(count)])
        out = ids[np.repeat(first[piece] - to[:-1], count) + np.arange(to[-1])]
        return out, np.diff(to[np.searchsorted(cut, off)])


_held: dict[str, PieceEncoder] = kept(__name__)


def loaded(spec: str) -> PieceEncoder:
    """The encoder, kept by the worker."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _held:
        _held.clear()
        _held[name] = PieceEncoder(spec)
    return _held[name]


SEGMENTS = "shard int, seq int, first long, n_docs long, n_tokens long, block binary"


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID, segment: int = SEGMENT) -> None:
    """Writes a store of docs to `path`, which may be in any file system of Spark.

    A null text is an empty one, of the end id alone; null ids come first;
    repeated rows are stored each; an empty table gives an empty store; other
    columns are not read. Rows are sorted by id, rows of one id by their text's
    hash, which also parts an id of very many rows; equal rows are in any order,
    which can't be told. A long text is one segment, however long.
    """
    from tokenizers import Tokenizer

    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one file of fixed size
    most = max(Tokenizer.from_str(spec.value).get_vocab_size() - 1, end_id)
    width = 2 if most < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, seq = loaded(spec.value), TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        lengths: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = done = 0

        def made() -> pa.RecordBatch:
            n, ids = np.concatenate(lengths), np.concatenate(parts)
            block = pack_block(keys, n, ids, width)
            columns = [pa.array([x], t) for x, t in ((shard, pa.int32()), (seq, pa.int32()), (done, pa.int64()), (len(keys), pa.int64()), (len(ids), pa.int64()), (block, pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "seq", "first", "n_docs", "n_tokens", "block"])

        for whole in batches:
            for batch, column in slices(whole, limit=ENCODE_SLICE):
                ids, n = encoder.encode(column)
                ids = np.insert(ids, np.cumsum(n), end_id)
                n = n + 1
                own = batch.column(0).to_pylist()
                ends = np.cumsum(n)
                at = 0
                while at < len(own):
                    begin = int(ends[at - 1]) if at else 0
                    stop = max(at + 1, int(np.searchsorted(ends, begin + segment - held, side="right")))
                    keys += own[at:stop]
                    lengths.append(n[at:stop])
                    parts.append(ids[begin : ends[stop - 1]])
                    held += int(ends[stop - 1]) - begin
                    at = stop
                    if held >= segment or at < len(own):
                        yield made()
                        done += held
                        keys, lengths, parts, held, seq = [], [], [], 0, seq + 1
        if keys:
            yield made()

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    ordered = own.repartitionByRange(F.asc_nulls_first("id"), F.xxhash64("text")).sortWithinPartitions(F.asc_nulls_first("id"), F.xxhash64("text"))
    mapped(ordered, run, SEGMENTS).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a store, with `base`: tokens of all segments before."""
    store = spark.read.schema(SEGMENTS).parquet(path)
    # one row a shard, that is, a task of the writer
    shards = store.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    # a number for each of these is sent to all tasks, so no block moves
    return store.join(F.broadcast(before), "shard").withColumn("base", F.col("before") + F.col("first")).drop("before")


def documents(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the blocks."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = Block(data.as_buffer())
                ends = b.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = b.ids.astype("<u4")
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array(b.doc_ids(), pa.int64()), pa.array(starts + base), pa.array(ends - starts), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(starts, ends[-1:]).astype(np.int32), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return mapped(segments.select("base", "block"), run, schema)


def op7_elias_fano_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'tokens').root}/store"
    write(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path)
    return documents(read(spark, path))


QUERIES = {"op7_elias_fano_store": op7_elias_fano_store}
ORACLE: dict[str, str] = {}
