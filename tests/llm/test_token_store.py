from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import token_store as T
from millrace.llm._shared import strings

public_tokenizers = pytest.importorskip("public_tokenizers")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 100, 3000):
        for most in (1, 7, 1000, 1 << 40):
            v = np.sort(rng.integers(0, most, n)).astype(np.uint64)
            e, used = T.EliasFano.unpack(memoryview(T.EliasFano.of(v).pack() + b"rest"))
            assert (e.all() == v).all() and used == len(T.EliasFano.of(v).pack())
            assert all(e.select(i) == v[i] for i in range(0, n, max(1, n // 25)))
    with pytest.raises(IndexError):
        T.EliasFano.of(np.array([1, 2])).select(2)


def test_boundaries_take_little_space():
    ends = np.cumsum(np.random.default_rng(1).integers(100, 3000, 20_000))
    e = T.EliasFano.of(ends)
    bits = 8 * (len(e.low) + len(e.high) + e.ranks.nbytes)
    assert bits < len(ends) * (3 + np.log2(ends[-1] / len(ends)))


def test_pieces_encode_as_whole_texts(library):
    rng = random.Random(3)
    parts = ["a", " ", "é", "\n", " ", "\u3000", "1", "!", "'s", "ß", "中", " <|endoftext|>", "\t", "'", "word"]
    texts = ["", " ", "a ", " a", "a  b"] + ["".join(rng.choice(parts) for _ in range(60)) for _ in range(800)]
    encoder = T.PieceEncoder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    for _ in range(2):
        ids, n = encoder.encode(strings(pa.array(texts)))
        for t, own in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
            assert own.tolist() == library.encode(t, add_special_tokens=False).ids


def test_store(spark, library, tmp_path):
    texts = [None, "", "some words here", "x" * 3000, "some words here", "é " * 500]
    rows = [(100 - 7 * i, t, "k") for i, t in enumerate(texts)] + [(None, "no id", "k"), (100, None, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string")
    T.write(df, str(tmp_path / "s"), segment=64)
    got = T.documents(T.read(spark, str(tmp_path / "s")), with_ids=True).orderBy("start").collect()
    assert len(got) == len(rows)
    at = 0
    for r, want in zip(got, sorted((r[0] if r[0] is not None else -1) for r in rows)):
        assert (r.doc_id if r.doc_id is not None else -1) == want and r.start == at
        assert r.ids[-1] == T.END_ID and len(r.ids) == r.n_tokens
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    by_id = {r.doc_id: r.ids[:-1] for r in got}
    assert by_id[86] == library.encode("some words here", add_special_tokens=False).ids
    T.write(df.limit(0), str(tmp_path / "none"))
    assert T.documents(T.read(spark, str(tmp_path / "none"))).count() == 0


def test_block_reads_one_document():
    b = T.Block(T.pack_block([None, 5, 5, 9], np.array([1, 3, 0, 2]), np.arange(6, dtype=np.uint32), 2))
    assert b.doc_ids() == [None, 5, 5, 9] and b.span(1) == (1, 4) and b.tokens(3).tolist() == [4, 5] and b.tokens(2).tolist() == []
    with pytest.raises(ValueError):
        T.Block(b"????" + bytes(60))
