"""Toxicity by a string-subsequence kernel machine with Nyström landmarks.

Two words are alike by the subsequences of three letters that they share, each
weighted by DECAY to the power of the length it spans in either word, so gaps
and inserted characters cost a little each; the kernel is normalised. Letters
spelt out with blanks between them are one word. A run of more than LONGEST
bytes without a blank is covered by words of LONGEST bytes, each half over the
next and cut between characters, so that any subsequence, and any insult of up
to half as many bytes, is whole in one of them. Letters other than a-z count by
their code point modulo 37, so a few of them are taken for one another.

Landmarks are words of labelled texts, of three characters or more, as shorter
ones have no subsequence: of those that tell the labels apart most,
the ones that cover the toxic texts, each where those before do not. A text is mapped to its
largest kernel value with each landmark, whitened by the inverse root of the
landmarks' own kernel matrix, and a linear support vector machine, trained on
labelled texts, decides; a logistic curve makes its margin a score.

Kernel values below FLOOR count as none. By Cauchy and Schwarz a word can reach
no more than the root of the share of its squared weights that is on subsequences
which any landmark has, so most words need no kernel.

About SAMPLE labelled rows at most, drawn by a hash of their ids, fit the model;
the driver gets LANDMARKS numbers for each of them. All rows are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import Scratch, flat, kept, mapped, slices, word_runs
from .language import code_points, lowered
from .minhash import SPACE

DECAY = 0.7
REACH = 3  # letters of a subsequence are at most so far apart
FLOOR = 0.45
SAMPLE = 20_000
LANDMARKS = 96
#: Words among which the landmarks are chosen.
TELLING = 2000
COVER = 2
LONGEST = 48
#: Symbols: none for what is no letter, a-z, other letters by their code point modulo the rest.
SYMBOLS = 64


def words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, the word of each place, the first place of each text)."""
    data, off = flat(column)
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    space = SPACE[low]
    if len(low) > 4:
        # a blank between two single characters joins them: a spelt-out word
        one = np.zeros(len(low), bool)
        edge = np.concatenate([[True], space, [True]])
        one[:] = ~space & edge[:-2] & edge[2:]
        joined = np.zeros(len(low), bool)
        joined[1:-1] = (low[1:-1] == 32) & one[:-2] & one[2:]
        space &= ~joined
    starts, ends, first = word_runs(~space, off)
    if not len(starts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), first
    n = -(-(ends - starts) // LONGEST)
    if n.max() == 1:
        coded = _taken(low, starts, ends).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy().astype(np.int64), first
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    parts, texts = [], []
    # pieces side by side, and pieces over their borders
    for many, shift in ((n, 0), (n - 1, LONGEST // 2)):
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        a = np.repeat(starts, many) + inside * LONGEST + shift
        last = np.repeat(ends, many)
        b = np.minimum(a + LONGEST, last)
        for _ in range(3):  # back to a character's first byte
            a -= (low[a] & 0xC0) == 0x80
            b -= (b < last) & ((low[np.minimum(b, len(low) - 1)] & 0xC0) == 0x80)
        parts.append(_taken(low, a, b))
        texts.append(np.repeat(text, many))
    texts = np.concatenate(texts)
    order = np.argsort(texts, kind="stable")
    coded = pa.concat_arrays(parts).take(pa.array(order)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(texts[order], np.arange(len(first)))


def _taken(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[starts:ends] of ascending pieces that don't overlap."""
    # offsets for Arrow: pieces and the gaps between them, in turn
    bounds = np.stack([starts, ends], axis=1).ravel()
    if not len(bounds):
        return pa.array([], pa.large_binary())
    pieces = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
    return pieces.take(pa.array(np.arange(0, len(bounds) - 1, 2)))


_held: dict[str, np.ndarray] = kept(__name__)


def symbols() -> np.ndarray:
    """The symbol of each code point, 0 for what is no letter; kept by the worker."""
    if "s" not in _held:
        low = lowered()
        _held["s"] = np.where(low == 0, 0, np.where((low >= 97) & (low <= 122), low - 96, 27 + low % (SYMBOLS - 27))).astype(np.uint8)
    return _held["s"]


def subsequences(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of all weighted subsequences of large_binary words, equal ones of a word added up."""
    _, off, data = distinct.buffers()
    off = np.frombuffer(off, np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    points, first = code_points(data, off - off[0])
    points = np.minimum(points, 0x10FFFF)
    s = symbols()[points].astype(np.int32)
    word = np.repeat(np.arange(len(distinct)), np.diff(first))
    # only words with a letter twice can have a subsequence twice
    each = np.sort(word * SYMBOLS + s)
    twice = np.zeros(len(distinct), bool)
    again = each[1:][(each[1:] == each[:-1]) & (each[1:] % SYMBOLS > 0)]
    twice[again // SYMBOLS] = True
    out = []
    for a in range(1, REACH + 1):
        for b in range(1, REACH + 1):
            d = a + b
            if len(s) <= d:
                continue
            ok = np.flatnonzero((word[d:] == word[:-d]) & (s[:-d] > 0) & (s[a : len(s) - b] > 0) & (s[d:] > 0))
            code = s[ok] * (SYMBOLS * SYMBOLS) + s[ok + a] * SYMBOLS + s[ok + d]
            out.append((word[ok], code, np.full(len(ok), DECAY**d, np.float32)))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.float32)
    w, c, v = (np.concatenate(x) for x in zip(*out))
    many = twice[w]
    w, c, v = (np.concatenate(x) for x in zip((w[~many], c[~many], v[~many]), _merged(w[many], c[many], v[many])))
    order = np.argsort(w, kind="stable")
    return w[order], c[order], v[order]


def _merged(w: np.ndarray, c: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal codes of a word added up."""
    key, inverse = np.unique(w * SYMBOLS**3 + c, return_inverse=True)
    return key // SYMBOLS**3, key % SYMBOLS**3, np.bincount(inverse, v, len(key)).astype(np.float32)


class Landmarks:
    def __init__(self, names: list[bytes]):
        self.names = names
        w, c, v = subsequences(pa.array(names, pa.large_binary()))
        codes = np.unique(c)
        self.row = np.zeros(SYMBOLS**3, np.int32)
        self.row[codes] = np.arange(1, len(codes) + 1)
        self.matrix = np.zeros((len(codes) + 1, len(names)), np.float32)
        self.matrix[self.row[c], w] = v
        self.matrix /= np.maximum(np.sqrt((self.matrix**2).sum(axis=0)), 1e-9)

    def kernel(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words with values of FLOOR or more, their values)."""
        w, c, v = subsequences(distinct)
        n = len(distinct)
        rows = self.row[c]
        known = rows > 0
        v2 = v * v
        share = np.bincount(w[known], v2[known], n) / np.maximum(np.bincount(w, v2, n), 1e-9)
        some = np.flatnonzero(share >= FLOOR * FLOOR - 1e-5)
        if not len(some):
            return some, np.zeros((0, len(self.names)), np.float32)
        at = np.full(n, -1)
        at[some] = np.arange(len(some))
        keep = at[w] >= 0
        w, c, v = at[w[keep]], c[keep], v[keep]
        norm = np.sqrt(np.bincount(w, v * v, len(some)))
        values = np.empty((len(some), len(self.names)), np.float32)
        hit = self.row[c]
        w, hit, v = w[hit > 0], hit[hit > 0], v[hit > 0]
        first = np.searchsorted(w, np.arange(len(some) + 1))
        for a in range(0, len(some), 2048):
            b = min(a + 2048, len(some))
            x, y = first[a], first[b]
            # words by subsequences, times subsequences by landmarks
            used, column = np.unique(hit[x:y], return_inverse=True)
            dense = np.zeros((b - a, len(used)), np.float32)
            dense[w[x:y] - a, column] = v[x:y]
            values[a:b] = dense @ self.matrix[used]
        values /= np.maximum(norm, 1e-9)[:, None]
        strong = values.max(axis=1) >= FLOOR
        values = values[strong]
        values[values < FLOOR] = 0
        return some[strong], np.minimum(values, 1)

    def texts(self, column: pa.Array) -> np.ndarray:
        """The largest value with each landmark over the words of each text."""
        distinct, place, first = words(column)
        out = np.zeros((len(column), len(self.names)), np.float32)
        if not len(place) or not self.names:
            return out
        some, values = self.kernel(distinct)
        at = np.full(len(distinct), -1)
        at[some] = np.arange(len(some))
        row = at[place]
        text = np.repeat(np.arange(len(column)), np.diff(first))
        hit = row >= 0
        pairs = np.unique(text[hit] * max(len(some), 1) + row[hit])
        text, row = pairs // max(len(some), 1), pairs % max(len(some), 1)
        begin = np.flatnonzero(np.diff(text, prepend=-1))
        for a in range(0, len(begin), 512):
            b = min(a + 512, len(begin))
            x, y = begin[a], begin[b] if b < len(begin) else len(text)
            out[text[begin[a:b]]] = np.maximum.reduceat(values[row[x:y]], begin[a:b] - x, axis=0)
        return out


@dataclass
class Model:
    names: list[bytes]
    weights: np.ndarray
    constant: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        margin = features.astype(np.float64) @ self.weights + self.constant
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, pos, neg): labelled texts of either label with the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, column in slices(whole):
                label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                distinct, place, first = words(column)
                text = np.repeat(np.arange(len(column)), np.diff(first))
                pairs = np.unique(place * len(column) + text) if len(place) else np.zeros(0, np.int64)
                word, y = pairs // max(len(column), 1), label[pairs % max(len(column), 1)] if len(pairs) else pairs
                n = np.bincount(word, minlength=len(distinct))
                p = np.bincount(word, y, minlength=len(distinct)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([distinct.cast(pa.binary()), pa.array(p), pa.array((n - p).astype(np.int64))], names=["word", "pos", "neg"])

    return mapped(rows, run, "word binary, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _covering(has: np.ndarray, clean: np.ndarray, most: int) -> list[int]:
    """Words that together are in the most toxic texts, one after the other.

    has: toxic texts by words; clean: clean texts with the word. A word counts
    for the texts that no word before is in, so a text with many copies doesn't
    fill the list with its words.
    """
    left, taken = np.full(len(has), COVER), []
    price = 1.0 * clean * max(len(has), 1) / max(len(has) + clean.max(initial=0), 1)
    while len(taken) < most and (left > 0).any():
        gain = has[left > 0].sum(axis=0) - price
        gain[taken] = -1
        best = int(gain.argmax())
        if gain[best] < 2:
            break
        taken.append(best)
        left -= has[:, best]
    return taken


def _machine(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 600) -> tuple[np.ndarray, float]:
    """A linear support vector machine: squared hinge loss, both labels of equal weight, by accelerated descent."""
    a, sign = np.c_[x, np.ones(len(x))], np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    step = 1 / (2 * np.linalg.norm(a * np.sqrt(weight)[:, None], 2) ** 2 + ridge)
    w = z = np.zeros(a.shape[1])
    for k in range(rounds):
        gap = np.maximum(0, 1 - sign * (a @ z))
        g = -2 * a.T @ (weight * sign * gap) + ridge * np.append(z[:-1], 0)
        new = z - step * g
        z, w = new + k / (k + 3) * (new - w), new
    return w[:-1], float(w[-1])


def drawn(labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """About `sample` of the labels, by a hash of the key; all of them if there are no more."""
    n = labels.count()
    return labels if n <= sample else labels.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * sample / n))


def train(labelled: DataFrame, scratch: Scratch, text: str = "text", label: str = "label", landmarks: int = LANDMARKS) -> Model:
    """A model from rows with a label of 0 or 1; rows without one, or without text, are left out.

    The rows must be a bounded sample, such as `drawn` gives.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label")).filter("text is not null and label in (0, 1)")
    rows = scratch.cut(rows.dropDuplicates(), "labelled")
    counts = scratch.cut(_word_counts(rows), "words")
    totals = rows.agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")).first()
    p, q = totals["p"] or 0, totals["q"] or 0
    if not p or not q:
        return Model([], np.zeros(0), 1.0 if p else -1.0)
    odds = F.log((F.col("pos") + 0.5) / (p - F.col("pos") + 0.5)) - F.log((F.col("neg") + 0.5) / (q - F.col("neg") + 0.5))
    deviation = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    telling = counts.filter("pos >= 2 and length(cast(word as string)) >= 3").withColumn("z", odds / deviation).orderBy(F.desc("z"), "word").limit(TELLING).collect()
    vocabulary = [bytes(r["word"]) for r in telling]

    def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_binary())
        for whole in batches:
            for batch, column in slices(whole):
                distinct, place, first = words(column)
                at = pc.index_in(distinct, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)[place]
                found = [np.unique(at[x:y][at[x:y] >= 0]).astype(np.int32) for x, y in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["w"])

    toxic = mapped(rows.filter("label = 1"), which, "w array<int>").collect()
    has = np.zeros((len(toxic), len(vocabulary)), bool)
    for i, r in enumerate(toxic):
        has[i, r["w"]] = True
    names = [vocabulary[i] for i in _covering(has, np.array([r["neg"] for r in telling], float), landmarks)]
    if not names:
        return Model([], np.zeros(0), -1.0)
    held = Landmarks(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, column in slices(whole):
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([r.tobytes() for r in held.texts(column)], pa.binary())], names=["label", "x"])

    got = mapped(rows, run, "label int, x binary").collect()  # of the sample
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got]).astype(np.float64)
    y = np.array([r["label"] for r in got], float)
    own = held.matrix.T @ held.matrix
    value, vector = np.linalg.eigh(own.astype(np.float64) + 1e-3 * np.eye(len(own)))
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    w, constant = _machine(x @ root, y)
    weights = root @ w
    slope, shift = _logistic(x @ weights + constant, y)
    return Model(names, weights * slope, constant * slope + shift)


def _logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """(slope, shift) of the curve from margins to probabilities, by Newton's method."""
    a, w = np.c_[margin, np.ones(len(y))], np.array([1.0, 0.0])
    for _ in range(rounds):
        s = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (s * (1 - s))[:, None]) + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, a.T @ (s - y) + 1e-3 * w), -2, 2)
    return float(max(w[0], 1e-3)), float(w[1])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with `score` and `predicted` in place of the text.

    A null or empty text has the score of a text without any landmark; a text of
    any length is read whole. Repeated rows get equal scores; a score of just 0.5
    is predicted as 1; an empty table gives an empty one; columns named like the
    new ones are replaced.
    """
    keep = [c for c in docs.columns if c not in (text, "score", "predicted")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = packed.select("row", F.lit(0.0).alias("score")).schema
    held = Landmarks(model.names) if model.names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, column in slices(whole):
                x = held.texts(column) if held else np.zeros((len(column), 0))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], names=["row", "score"])

    out = mapped(packed, run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op9_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out("doc_id")).select("doc_id", F.col("toxic").alias("label"))
    # SAMPLE rows of two numbers, whatever the input
    model = train(docs.join(F.broadcast(drawn(labels)), "doc_id"), Scratch(spark, "toxicity"))
    return score(docs.withColumn("held_out", held_out("doc_id")), model)


QUERIES = {"op9_string_kernel_toxicity": op9_string_kernel_toxicity}
ORACLE: dict[str, str] = {}
