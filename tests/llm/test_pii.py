from __future__ import annotations

import re

import numpy as np

from millrace.llm import pii
from millrace.llm._shared import Scratch

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else None, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


TEXTS = [
    None,
    "",
    "a@b.com_x@y.com a@b.c@d.e a@b.",
    "1.2.3.4.5.6.7.8 0000.0.0.255 256.1.1.1 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112, 4111  1111",
    "+1 (555) 123-4567 +1+1+12345678 +49 30 1234567890123",
    "🙂 é a@b.de 🙂 +44 20 7946 0958",
    "x" * 60_000 + "@a.b",
    "1" * 60_000,
    "1." * 1500,
    "call tel 212-555-7890 or ssn 123-45-6789 or iban DE44 5001 0517 5407 3249 31",
]


def rows(spark):
    return spark.createDataFrame([(i, t, "c", 7) for i, t in enumerate(TEXTS + TEXTS)], "doc_id long, text string, candidates string, row int")


def test_base_spans_are_those_of_plain_matching(spark):
    found = pii.detect(rows(spark), Scratch(spark, "t")).collect()
    assert len(found) == 2 * len(TEXTS)
    for r in found:
        assert [(s.kind, s.start, s.end) for s in r.findings if s.kind in pii.BASE] == brute(TEXTS[r.doc_id % len(TEXTS)]), r.doc_id


def test_the_classifier_adds_supported_spans_only(spark):
    df = spark.createDataFrame([(1, "call tel 212-555-7890"), (2, "part no 212-555-7890"), (3, "000-12-0000")], "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.findings] for r in pii.detect(df, Scratch(spark, "t")).collect()}
    assert got == {1: ["tel"], 2: [], 3: []}


def test_mask_keeps_columns_and_other_text(spark):
    out = pii.mask(rows(spark), Scratch(spark, "t"))
    assert out.columns == ["doc_id", "text", "candidates", "row"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] is None and got[1] == ""
    assert got[5].startswith("<PHONE> +1+1<PHONE>")
    assert got[6] == "🙂 é <EMAIL> 🙂 <PHONE>"
    assert got[8] == TEXTS[8] and got[9] == "<IP>." * 375


def test_labelers_reliabilities_are_found():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    sharp = np.where(rng.random(4000) < 0.95, truth, ~truth) * 2 - 1
    vague = np.where(rng.random(4000) < 0.7, truth, ~truth) * 2 - 1
    noise = rng.integers(0, 2, 4000) * 2 - 1
    votes, n = np.unique(np.c_[sharp, vague, noise], axis=0, return_counts=True)
    p = pii.expectation_maximisation(votes, n.astype(float))
    assert all((p > 0.5) == (votes[:, 0] > 0))


def test_empty_table(spark):
    assert pii.detect(rows(spark).limit(0), Scratch(spark, "t")).count() == 0
    assert pii.mask(rows(spark).limit(0), Scratch(spark, "t")).count() == 0


def test_query(spark, tmp_path):
    rows(spark).write.parquet(str(tmp_path / "documents.parquet"))
    out = pii.op3_personal_data(spark, str(tmp_path)).collect()
    assert len(out) == 2 * len(TEXTS)
    for r in out:
        want = brute(TEXTS[r.doc_id % len(TEXTS)])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in pii.BASE]
        assert r.spans.startswith(",".join(f"{k}:{a}:{b}" for k, a, b in want))


def test_no_python_on_the_main_path(spark, tmp_path):
    rows(spark).write.parquet(str(tmp_path / "documents.parquet"))
    plan = pii.op3_personal_data(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_long_repeats_don_t_overflow_the_matcher(spark):
    n = 100_000
    wanted = {
        "a@b" + ".c" * n: [("email", 0, 3 + 2 * n)],
        "a@" + "b" * n: [],
        "1." * 400: [("ip", 8 * k, 8 * k + 7) for k in range(100)],
        "1 " * n: [],
        "+1" + "-2" * n: [],
        "+1" + " " * n + "2345678": [("phone", 0, n + 9)],
        "12-" * n: [],
        "DE44" + " A1B2" * n: [],
    }
    df = spark.createDataFrame(list(enumerate(wanted)), "doc_id long, text string")
    for r in pii.detect(df, Scratch(spark, "t")).collect():
        assert [(s.kind, s.start, s.end) for s in r.findings if s.kind in pii.BASE] == list(wanted.values())[r.doc_id], r.doc_id


def test_estimated_reliabilities_change_what_is_accepted(spark):
    # the cue mostly stands before impossible numbers of parts, so it is no evidence, though a majority takes it for some
    lines = ["call part 112-055-7890"] * 40 + ["(212) 555-7890 here"] * 40 + ["so call 212-555-7891"] * 20
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = pii.candidates(df).cache()
    accepted = lambda rounds: {r.doc_id for r in pii.classify(found, pii.train(found, em_rounds=rounds)).collect() if r.findings}
    assert accepted(0) == set(range(40, 100)) and accepted(200) == set(range(40, 80))


def test_the_form_and_check_digits_vary(spark):
    lines = ["iban DE89 3704 0044 0532 0130 00", "iban DE88 3704 0044 0532 0130 00", "x hotel 212-555-7890"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    x = {r.doc_id: r.candidates[0].x for r in pii.candidates(df).collect()}
    assert x[0][1] == 1 and x[1][1] == -1  # the gazetteer, with the check digits
    assert x[2][2] == 0  # "hotel" is no cue
