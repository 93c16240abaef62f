from __future__ import annotations

import random

from millrace.llm import language


def corpus(n=60):
    rng = random.Random(2)
    parts = {"aa": ["the", "ing", "th", "an", "er", "wh"], "bb": ["ción", "ado", "ñ", "que", "os", "el"], "cc": ["sch", "ung", "ß", "ä", "ein", "keit"]}
    rows = []
    for lang, p in parts.items():
        for _ in range(n):
            rows.append((" ".join("".join(rng.choice(p) for _ in range(3)) for _ in range(25)), lang))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    rng = random.Random(1)
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.learn(df.filter("doc_id < 120"))
    out = language.identify(df.filter("doc_id >= 120"), model).collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_edges(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(corpus(5))], "doc_id long, text string, lang string")
    model = language.learn(df.union(spark.createDataFrame([(99, "xx yy", None), (98, None, "aa"), (97, "", "zz")], df.schema)))
    assert model.languages == ["aa", "bb", "cc"]
    odd = [None, "", "123 !? \n", "a", "中文", "thing " * 30_000, "𐀀"]
    rows = spark.createDataFrame([(i, t, "s", 1.0) for i, t in enumerate(odd + odd)], "doc_id long, text string, lang_pred string, row double")
    got = {}
    for r in language.identify(rows, model).collect():
        assert got.setdefault(r.doc_id % len(odd), (r.lang_pred, r.score)) == (r.lang_pred, r.score)
    assert [got[i][0] for i in range(3)] == ["und"] * 3
    assert all(got[i][0] in model.languages for i in range(3, len(odd)))
    assert language.identify(rows.limit(0), model).count() == 0
    none = language.learn(df.limit(0))
    assert {r.lang_pred for r in language.identify(rows, none).collect()} == {"und"}


def test_query_learns_from_no_held_out_row(spark, tmp_path):
    rows = [(i, *r) for i, r in enumerate(corpus(20))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language.held_out("doc_id")
    df.withColumn("lang", language.F.when(held, "wrong").otherwise(df.lang)).write.parquet(str(tmp_path / "documents.parquet"))
    out = language.op5_hyperdimensional_language(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out} == {"aa", "bb", "cc"} and {r.held_out for r in out} == {True, False}


def test_texts_in_no_learnt_language_are_rejected(spark):
    rows = corpus()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.learn(df.filter("doc_id < 120"))
    least = language.least_score(df.filter("doc_id >= 120"), model)
    odd = ["Все люди рождаются свободными и равными в своем достоинстве и правах " * 3, "qzkx vwpj xqjz kvvq pzzx jqwk " * 8, "qz", None]
    other = spark.createDataFrame([(1000 + i, t, "aa") for i, t in enumerate(odd)], df.schema)
    # short texts tell too little, and all clean ones stay
    assert {r.doc_id for r in language.accepted(df.union(other), model, least=least).collect()} == {*range(180), 1002}
    assert language.least_score(df.limit(0), model) == 0
