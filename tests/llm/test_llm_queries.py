"""Each opN_ query, as registered, on small tables; its contract's columns and one row for each row of its table."""

from __future__ import annotations

import random

import pytest

pytest.importorskip("public_tokenizers")
from millrace import llm
from millrace.llm import _shared

COLUMNS = {
    "op2": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op3": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op4": "vec_id n_links component_id kept",
    "op5": "doc_id held_out lang_pred score",
    "op6": "doc_id n_shingles component_id kept",
    "op7": "doc_id start n_tokens ids_crc32",
    "op8": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9": "doc_id held_out score predicted",
    "op10": "page_id host path rule verdict",
    "op11": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12": "vec_id code error label_error codebooks_sha256",
    "op13": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
}
ITEM = "a benchmark item of some dozen words that nobody should learn by heart at all"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(90)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(30)), "en" if i % 3 else "de", "s", 1, "row", "id") for i in range(40)]
    docs += [(40, None, "en", "s", 1, None, None), (41, "", None, None, 0, "", ""), (42, docs[1][1], "en", "s", 1, "x", "x"), (43, ITEM, "en", "s", 1, "x", "x")]
    folder = str(tmp_path_factory.mktemp("tables"))
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    write(docs, "doc_id long, text string, lang string, source string, n_chars long, row string, id string", "documents")
    write([(0, ITEM), (1, None), (2, "")], "item_id long, text string", "benchmark")
    write([(i, i % 2) for i in range(40)], "doc_id long, toxic int", "labels")
    write([(i, [rng.random() for _ in range(8)], i % 2) for i in range(30)] + [(30, None, 0)], "vec_id long, embedding array<float>, label int", "embeddings")
    write([(i, f"https://www.{rng.choice(words)}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{i}", "") for i in range(60)] + [(60, None, None)], "page_id long, url string, html string", "pages")
    return folder


@pytest.mark.parametrize("name", list(llm.queries()))
def test_query(spark, tables, name):
    out = llm.queries()[name](spark, tables)
    n = name.split("_")[0]
    rows = out.collect()
    if n == "op1":
        assert [(r.doc_id, r.item_id, r.similarity) for r in rows] == [(43, 0, 1.0)]
        return
    assert out.columns[: len(COLUMNS[n].split())] == COLUMNS[n].split()
    table, key = {"op4": ("embeddings", "vec_id"), "op10": ("pages", "page_id"), "op12": ("embeddings", "vec_id")}.get(n, ("documents", "doc_id"))
    want = spark.read.parquet(f"{tables}/{table}.parquet")
    if n == "op12":  # a null vector has no code
        want = want.filter("embedding is not null")
    assert sorted(r[key] for r in rows) == sorted(r[key] for r in want.collect())
    if n == "op6":
        assert {r.doc_id: r.component_id for r in rows}[42] == 1


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key):
            return None

    class Session:
        class sparkContext:  # noqa: N801
            master = "local-cluster[3,2,1000]"
            getConf = staticmethod(Conf)  # noqa: N815

    with pytest.raises(ValueError, match="checkpoint"):
        _shared.shared_dir(Session())
