"""Language identification by hyperdimensional profiles.

Every letter has a random vector of DIMENSIONS signs, drawn from its code point.
A trigram binds (multiplies) its letters' vectors, permuted by place; a text
bundles (adds) its trigrams; a language's prototype bundles the unit vectors of
its texts. All vectors lose what the languages share, their mean prototype. The
prototype with the largest cosine names the language.

Learning is one pass and one grouped sum of vectors: languages x DIMENSIONS
numbers reach the driver. Prediction is a map over the documents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import flat, kept, mapped, slices

DIMENSIONS = 512
#: Letters whose vectors a worker keeps; trigrams that are bound at a time.
KEPT, PART = 20_000, 4096
UNKNOWN = "und"
#: Texts of so many letters are rejected below MARGIN times the least cosine of held-out ones.
LETTERS = 100
MARGIN = 0.75


_held: dict[str, np.ndarray] = kept(__name__)
_vectors: dict[int, np.ndarray] = kept(__name__, "vectors")


def lowered() -> np.ndarray:
    """The lower-case letter of each code point, 0 for what is no letter; kept by the worker."""
    if "l" not in _held:
        low = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                low[c] = ord(chr(c).lower()[0])
        _held["l"] = low
    return _held["l"]


def vectors_of(letters: np.ndarray) -> np.ndarray:
    """A vector of signs for each code point; 0, a blank, has one too."""
    if len(_vectors) > KEPT:
        _vectors.clear()
    for c in letters.tolist():
        if c not in _vectors:
            _vectors[c] = np.random.default_rng((5, c)).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1
    return np.stack([_vectors[c] for c in letters.tolist()])


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, and where each text's begin."""
    first = (data & 0xC0) != 0x80
    at = np.flatnonzero(first)
    b0 = data[at].astype(np.int32)
    more = [np.where(at + j < len(data), data[np.minimum(at + j, len(data) - 1)], 0).astype(np.int32) & 0x3F for j in (1, 2, 3)] if len(data) else [b0] * 3
    points = np.select(
        [b0 < 0x80, b0 < 0xE0, b0 < 0xF0],
        [b0, (b0 & 0x1F) << 6 | more[0], (b0 & 0x0F) << 12 | more[0] << 6 | more[1]],
        (b0 & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2],
    )
    return points, np.searchsorted(at, off)


def profiles(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The bundled, unit-length vector of each text; None for a text without a letter."""
    return (v for v, _ in counted_profiles(column))


def counted_profiles(column: pa.Array) -> Iterator[tuple[np.ndarray | None, int]]:
    """(profile, letters) of each text."""
    points, off = code_points(*flat(column))
    low = lowered()[np.minimum(points, 0x10FFFF)]
    # symbols: the letters of these texts, numbered, and 0 for a blank
    letters = np.unique(np.append(low, 0))
    s, k = np.searchsorted(letters, low), len(letters)
    base = vectors_of(letters)
    vectors = [np.roll(base, 2 - place, axis=1) for place in range(3)]
    for a, b in zip(off[:-1], off[1:]):
        letters_in = int(np.count_nonzero(s[a:b]))
        if not letters_in:
            yield None, 0
            continue
        own = np.concatenate([[0], s[a:b], [0]])
        code = own[:-2] * (k * k) + own[1:-1] * k + own[2:]
        # long texts have each trigram often: counts by table instead of sorting
        if len(code) > 30_000 and k**3 <= 1 << 20:
            n = np.bincount(code, minlength=k**3)
            code = np.flatnonzero(n)
            n = n[code]
        else:
            code, n = np.unique(code, return_counts=True)
        at = code // k % k != 0  # a blank in the middle tells nothing
        code, n = code[at], n[at].astype(np.float32)
        total = np.zeros(DIMENSIONS, np.float32)
        for i in range(0, len(code), PART):
            c = code[i : i + PART]
            bound = vectors[0][c // (k * k)] * vectors[1][c // k % k] * vectors[2][c % k]
            total += n[i : i + PART] @ bound.astype(np.float32)
        yield total / max(float(np.sqrt(total @ total)), 1e-12), letters_in


@dataclass
class Model:
    languages: list[str]
    mean: np.ndarray
    prototypes: np.ndarray  # unit rows, without the mean

    def predict(self, profile: np.ndarray | None) -> tuple[str, float]:
        if profile is None or not self.languages:
            return UNKNOWN, 0.0
        v = profile - self.mean
        cosine = self.prototypes @ v / max(float(np.sqrt(v @ v)), 1e-12)
        best = int(cosine.argmax())
        return self.languages[best], float(min(1.0, max(0.0, (1 + cosine[best]) / 2)))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Prototypes from the rows of docs whose lang is not null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch, column in slices(whole):
                for name, v in zip(batch.column(1).to_pylist(), profiles(column)):
                    if v is not None:
                        total[name] = total.get(name, 0) + np.append(v, 1.0)
        for name, v in total.items():
            n = len(v)
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(np.arange(n, dtype=np.int32)), pa.array(v.astype(np.float64))], names=["lang", "i", "s"])

    own = docs.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = mapped(own, run, "lang string, i int, s double").groupBy("lang", "i").agg(F.sum("s").alias("s")).collect()
    found: dict[str, np.ndarray] = {}
    for r in rows:
        found.setdefault(r["lang"], np.zeros(DIMENSIONS + 1))[r["i"]] = r["s"]
    names = sorted(found)
    if not names:
        return Model([], np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)))
    bundles = np.stack([found[k][:-1] / found[k][-1] for k in names])
    # one language alone keeps its whole profile
    mean = bundles.mean(axis=0) if len(names) > 1 else np.zeros(DIMENSIONS)
    apart = bundles - mean
    return Model(names, mean.astype(np.float32), (apart / np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-12)).astype(np.float32))


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with `lang_pred` and `score` in place of the text.

    A null text, or one without a letter, is "und" with score 0, and so is any
    text if nothing could be learnt. Texts of any length are read whole. Repeated
    rows get equal results; of languages with equal cosines the first by name is
    taken; an empty table gives an empty one. Columns named like the new ones are
    replaced.
    """
    keep = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    out = _predicted(docs, keep, model, text)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], "lang_pred", "score")


def least_score(held: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> float:
    """The score that a text of LETTERS or more needs, measured on documents of known language that taught nothing.

    It lies below that of all of these whose language is found; 0 if there are none.
    """
    out = _predicted(held, [lang], model, text).filter((F.col("letters") >= LETTERS) & (F.col("row").getField(lang) == F.col("lang_pred")))
    least = out.agg(F.min("score")).first()[0]
    return 0.0 if least is None else (1 + MARGIN * max(0.0, 2 * least - 1)) / 2


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of docs with a text in one of the learnt languages, as they are.

    Texts of LETTERS or more need a score of `least`; shorter ones tell too little to be rejected.
    """
    out = _predicted(docs, docs.columns, model, text).filter((F.col("lang_pred") != UNKNOWN) & ((F.col("letters") < LETTERS) | (F.col("score") >= least)))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _predicted(docs: DataFrame, keep: list[str], model: Model, text: str) -> DataFrame:
    """(row, lang_pred, score, letters): the columns to keep, whatever their names, out of the way."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = packed.select("row").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "letters": F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, column in slices(whole):
                got = [(*model.predict(v), n) for v, n in counted_profiles(column)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.int32())], names=["row", "lang_pred", "score", "letters"])

    return mapped(packed, run, schema)


def op5_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.filter(~held_out("doc_id")).select("text", "lang"))
    return identify(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model)


QUERIES = {"op5_hyperdimensional_language": op5_hyperdimensional_language}
ORACLE: dict[str, str] = {}
