from __future__ import annotations

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline
from millrace.llm import bpe

ITEM = "a benchmark item of a dozen words or so that nobody should ever learn by heart at all"


def world():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    text = lambda n=40: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(), "en", "s") for i in range(30)]
    rows += [(40, rows[3][1], "en", "s"), (41, rows[4][1] + " more", "en", "t"), (42, text() + " " + ITEM + " " + text(), "en", "s")]
    rows += [(50, None, "en", "s"), (51, "123 456", None, "s"), (52, text() + " mail me@example.com", "en", None), (53, text() + " mail me@example.com", None, "s")]
    return [(i, t, lang, source, len(t) if t else None) for i, t, lang, source in rows]


def test_stages_take_effect_one_after_the_other(spark, tmp_path):
    docs = spark.createDataFrame(world(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, ITEM), (1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, left = [], docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, left, str(tmp_path))
        out.write.parquet(str(tmp_path / f"stage{i}"))
        left = spark.read.parquet(str(tmp_path / f"stage{i}"))
        kept.append({r.doc_id for r in left.collect()})
        if i < 4:
            assert left.columns == docs.columns
    everything = {r[0] for r in world()}
    assert kept[0] == everything - {50, 51}
    assert kept[1] == kept[0] - {40, 41}
    assert kept[2] == kept[1] - {42}
    assert kept[3] == kept[4] == kept[2]
    masked = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "stage3")).collect()}
    assert masked[52].text.endswith("mail <EMAIL>") and masked[52].n_chars == len(masked[52].text)
    original = {r[0]: r[1] for r in world()}
    assert all(r.text == original[i] for i, r in masked.items() if i < 50)
    own = bpe.loaded(bpe.vocabulary())
    for r in left.collect():
        assert np.array(r.ids, "<u4").tobytes() == own.encode(masked[r.doc_id].text) and r.n_tokens == len(r.ids)


def test_five_stages_end_with_tokens():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
