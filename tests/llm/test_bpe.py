from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.loaded(bpe.vocabulary())


def texts():
    rng = random.Random(1)
    out = ["", " ", "<|endoftext|>a<|startoftext|> B<|endoftext", "İstanbul ΣΑΣ Σ", "don't I'll 123 ½²Ⅷ x", "á ẞ ﬁ 가", "\u0085  a\x1cb\x00", "🙂👍🏽 ‍"]
    for n in (3, 50, 4000, 9000):
        out.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)))
        out.append("".join(rng.choice(["the", "ing", "an", "er", "ha", "o"]) for _ in range(n)))
        out.append("".join(rng.choice("éàñö") for _ in range(n)))
        out += ["a" * n, "!" * n, "ha" * n]
    return out


def test_same_ids_and_text_as_the_library(own, library):
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        got = own.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == want, t[:40]
        assert bpe.decoded_digest(own, got) == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_every_character_as_the_library(own, library):
    for first in range(0, 0x20000, 0x800):
        t = "".join(chr(c) + "a" for c in range(first, first + 0x800) if not 0xD800 <= c <= 0xDFFF)
        if t:
            assert np.frombuffer(own.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, hex(first)


def test_lookahead_of_a_small_merge_list():
    # 0 a, 1 b, 2 c; ab -> 3, bc -> 4 later: whether b c merge never shows to the right of c
    length = {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3}
    assert bpe.lookahead([(0, 1, 3)], length) == 1
    # a bc needs both, and an earlier rule could take c away: one symbol more
    assert bpe.lookahead([(2, 1, 3), (1, 2, 4), (0, 4, 5)], length) == 3


def test_streaming_holds_a_bounded_window(own):
    rng = random.Random(2)
    for word in ("ab" * 6000, "a" * 9000, "".join(rng.choice("aeinrst") for _ in range(9000))):
        t, tokens, at, behind = bpe.Transducer(own), [], 0, 0
        letters = own.spelt(word)
        while at < len(letters):
            tokens += t.feed(letters[at : at + 100], at + 100 >= len(letters))
            at += 100
            behind = max(behind, min(at, len(letters)) - sum(own.length[x] for x in tokens))
        assert behind <= own.ahead + own.longest and tokens == own.merged(own.symbols(word))
        assert behind < 200  # what is held is far less than the bound here


def test_tokens_are_emitted_before_the_word_ends(own):
    t = bpe.Transducer(own)
    assert t.feed(own.spelt("internationalisationandmore" * 3), False)


def test_only_reachable_tokens_are_emitted(own):
    byte = {c: b for b, c in enumerate(own.bytes)}
    for name, i in list(own.vocab.items())[::7]:
        letters = name.removesuffix(own.end)
        s = [own.first[byte[c]] for c in letters]
        if name != letters:
            s[-1] = own.last[byte[letters[-1]]]
        assert (own.merged(s) == [i]) == (i in own.formed), name


def test_short_words_take_the_same_path(own):
    rng = random.Random(3)
    for _ in range(3000):
        w = "".join(rng.choice("abcdehilnorstuéß") for _ in range(rng.randint(1, 14)))
        assert np.frombuffer(own.word(w), "<u4").tolist() == own.merged(own.symbols(w)), w


def test_decoder_takes_pieces(own):
    ids = np.frombuffer(own.encode("Grüße, 🙂 don't"), "<u4").tolist()
    d, e = own.decoder(as_text=True), own.decoder()
    assert "".join(d.feed([i]) for i in ids) + d.close() == "grüße , 🙂 don 't "
    assert "".join(e.feed([i]) for i in ids) == own.decoder().feed(ids)


def test_query_edges(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Ab ab", "x"), (3, "Ab ab", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.encode(df).collect())
    ids = np.array(library.encode("Ab ab", add_special_tokens=False).ids, "<u4")
    empty = hashlib.sha256(b"").hexdigest()
    assert out == [(1, 0, empty), (2, 0, empty)] + [(3, len(ids), hashlib.sha256(ids.tobytes()).hexdigest())] * 2
    assert bpe.encode(df.limit(0), with_ids=True).count() == 0
    assert bpe.encode(df.drop("ids"), with_ids=True).filter("doc_id = 3").first().ids == ids.tolist()
