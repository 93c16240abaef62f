"""BPE encoding and decoding by streaming transducers.

Encoding reads the letters (bytes) of a word from left to right. After each, the
transducer knows the last token of the tokens of what it has read: the only one
that ends there and stays apart from the last token before it. Whatever follows,
the next token begins at one of the places that are at most a token's length
back; where the tokens up to all of these places have a common beginning, it is
stable and is emitted. ``lookahead`` computes from the merge list how many
letters to the right of a border can decide on it, so that no more than these
are ever held: memory depends on the merge list, not on the text.

Decoding is a state machine from ids to text that takes ids in pieces: either
as the library joins tokens, or as text, byte by byte through UTF-8.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ._shared import kept, mapped, slices

#: Words of up to this many characters are kept with their ids: the last so many
#: that were used, and up to as many before them. So are pairs of tokens.
KEPT_LENGTH, KEPT_WORDS, KEPT_PAIRS = 48, 300_000, 400_000
#: Letters that a long word is read by; characters that a text is read by.
STEP, PIECE = 512, 1 << 16
BLANK = re.compile("[ \t\n\r]")
#: From here on, which characters are letters, and their cases, depend on the
#: version of Unicode: the library's tables decide.
UNCOMMON = re.compile("[^\x00-\u024F]")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + n)
            n += 1
    return out


def lookahead(merges: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """Symbols to the right of a boundary that decide whether a merge crosses it.

    merges: (left, right, merged) ids by rank. A merge of left and right needs
    right to stand alone just then. That can fail only by an earlier merge
    across a boundary inside right, or at its end, whose left part is a token
    of right's derivation ending there, and which in turn reaches as far right
    as its own right part may be contested. Ranks fall along such a chain, so
    one pass by rank finds the longest one.
    """
    ends: dict[int, list[tuple[int, int]]] = {}  # token: (offset, token of its derivation that ends there)
    reach: dict[int, int] = {}  # left token: furthest reach of its merges so far
    longest = 0
    for left, right, merged in merges:
        own = ends.get(right) or [(length[right], right)]
        far = max([length[right], *(at + reach[t] for at, t in own if t in reach)])
        reach[left] = max(reach.get(left, 0), far)
        longest = max(longest, far)
        if merged not in ends:
            a = ends.get(left) or [(length[left], left)]
            ends[merged] = [*a, *((length[left] + at, t) for at, t in own), (length[left] + length[right], merged)]
    return longest


class Bpe:
    """A word-level BPE vocabulary with word ends, as in a tokenizers JSON file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        self.bytes = byte_letters()
        self.first = [self.vocab[c] for c in self.bytes]
        self.last = [self.vocab[c + self.end] for c in self.bytes]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        merges = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs]
        self.merges = merges
        self.rank = {(a, b): i for i, (a, b, _) in reversed([*enumerate(merges)])}
        self.made, self.none = [m for _, _, m in merges], len(merges)
        self.length = {i: len(t.removesuffix(self.end)) if self.end else len(t) for t, i in self.vocab.items()}
        for a, b in zip(self.first, self.last):
            self.length[a] = self.length[b] = 1
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        self.kept: dict[str, bytes] = {}
        self.kept_before: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.library = Tokenizer.from_str(text)
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(self.bytes)})
        self._derive()

    def _derive(self) -> None:
        """How each token is made, and which tokens are their own encoding: no other can be emitted."""
        #: Of each token: the rank of the merge that makes it (-1: a letter), and its two parts.
        self.formed = dict.fromkeys([*self.first, *self.last], -1)
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b, made) in enumerate(self.merges):
            # a later merge to the same token is the one only where this can't happen
            if made not in self.formed and a in self.formed and b in self.formed and self._apart(a, b, rank):
                self.formed[made], self.parts[made] = rank, (a, b)
        self.tokens = {self.names[t]: t for t in self.formed}
        self.longest = max(self.length[t] for t in self.formed)

    @cached_property
    def ahead(self) -> int:
        return lookahead(self.merges, self.length)

    def _apart(self, a: int, b: int, until: int) -> bool:
        """Whether no merge before rank `until` crosses the border of tokens a and b.

        Ranks only rise as tokens are made. So the tokens at the border are
        followed back in time: two of them merge if they do so before either
        is merged with its other neighbour; of equal merges the left one is first.
        """
        formed, parts, rank = self.formed, self.parts, self.rank.get
        until_a = until_b = until
        while True:
            r = rank((a, b), until)
            if r < until_a and r <= until_b and r < until:
                return False
            fa, fb = formed[a], formed[b]
            if fa > fb:
                until_a, a = fa, parts[a][1]
            elif fb >= 0:
                until_b, b = fb, parts[b][0]
            else:
                return True

    def apart(self, a: int, b: int) -> bool:
        """Whether tokens a and b, side by side, stay as they are."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(a, b, self.none)
        return known

    def merged(self, symbols: list[int]) -> list[int]:
        """The tokens of a few symbols by the definition: the pair of least rank first, leftmost first."""
        s, rank, none = symbols.copy(), self.rank.get, self.none
        ranks = list(map(rank, zip(s, s[1:]), repeat(none)))
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            s[i : i + 2] = [self.made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((s[i - 1], s[i]), none)
            if i < len(ranks):
                ranks[i] = rank((s[i], s[i + 1]), none)
        return s

    def symbols(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        return [*map(self.first.__getitem__, raw[:-1]), self.last[raw[-1]]]

    def spelt(self, word: str) -> str:
        """A letter for each byte of the word."""
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)

    def stream(self, letters: str) -> Iterator[bytes]:
        """A word's ids, as little-endian 32-bit integers, piece by piece."""
        whole = self.tokens.get(letters + self.end)
        if whole is not None:
            yield whole.to_bytes(4, "little")
            return
        t = Transducer(self)
        for at in range(0, len(letters), STEP):
            yield array("I", t.feed(letters[at : at + STEP], at + STEP >= len(letters))).tobytes()

    def word(self, word: str) -> bytes:
        out = self.kept.get(word)
        if out is None:
            out = self.kept_before.get(word) or b"".join(self.stream(word if word.isalnum() and word.isascii() else self.spelt(word)))
            if len(word) <= KEPT_LENGTH:
                if len(self.kept) >= KEPT_WORDS:
                    self.kept, self.kept_before = {}, self.kept
                self.kept[word] = out
        return out

    def normal(self, text: str) -> str:
        """NFC, then each letter's own lower case, whatever stands around it."""
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def library_words(self, text: str) -> Iterator[str]:
        """The words, spelt, as the library's own tables of letters and cases have them."""
        for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text)):
            yield letters

    def pieces(self, text: str) -> Iterator[bytes]:
        """The text's ids as little-endian 32-bit integers, special tokens' texts as those tokens, piece by piece."""
        at = 0
        specials = self.special.finditer(text) if "<|" in text else iter(())
        for m in specials:
            yield from self._plain(text, at, m.start())
            yield self.added[m[0]].to_bytes(4, "little")
            at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int) -> Iterator[bytes]:
        while at < end:
            # words end at blanks; a run without one is a piece, however long
            blank = BLANK.search(text, at + PIECE, end)
            stop = blank.end() if blank else end
            part, at = text[at:stop], stop
            if UNCOMMON.search(part):
                for letters in self.library_words(part):
                    yield from self.stream(letters)
            elif len(part) <= 2 * PIECE:
                yield b"".join(map(self.word, self.words.findall(self.normal(part))))
            else:
                for m in self.words.finditer(self.normal(part)):
                    yield from self.stream(self.spelt(m[0]))

    def encode(self, text: str) -> bytes:
        return b"".join(self.pieces(text))

    def decoder(self, as_text: bool = False) -> "Decoder":
        return Decoder(self, as_text)


class Transducer:
    """The tokens of one word, whose letters come in pieces; each is emitted once no later letter can change it."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.text = bpe, ""
        #: By place: the last token of the tokens up to it, and the place where that begins.
        self.token: list[int | None] = [None]
        self.back = [0]

    def feed(self, letters: str, last: bool) -> list[int]:
        """Tokens that have become stable; `last` ends the word."""
        bpe, token, back = self.bpe, self.token, self.back
        tokens, pairs, apart, longest = bpe.tokens.get, bpe.pairs.get, bpe.apart, bpe.longest
        text = self.text = self.text + letters
        n = len(text)
        for i in range(len(token), n + 1):
            part = text[:i] + bpe.end if last and i == n else text[:i]
            for j in range(i - longest if i > longest else 0, i):
                t = tokens(part[j:])
                if t is None:
                    continue
                before = token[j]
                if before is not None:
                    ok = pairs(before << 20 | t)
                    if not (apart(before, t) if ok is None else ok):
                        continue
                token.append(t)
                back.append(j)
                break
        return self._emit(n) if last else self._emit(self._stable(n))

    def _stable(self, n: int) -> int:
        """The last place that the tokens up to each place where the next token may begin have in common."""
        at = set(range(max(0, n + 1 - self.bpe.longest), n + 1))
        while len(at) > 1:
            most = max(at)
            at.remove(most)
            at.add(self.back[most])
        return at.pop()

    def _emit(self, place: int) -> list[int]:
        out, i = [], place
        while i:
            out.append(self.token[i])
            i = self.back[i]
        if place:
            self.text = self.text[place:]
            self.token = self.token[place:]
            self.back = [b - place if b > place else 0 for b in self.back[place:]]
        if len(self.text) > self.bpe.longest and len(self.text) > self.bpe.ahead + self.bpe.longest:
            raise AssertionError("more letters are held than can matter")
        return out[::-1]


class Decoder:
    """From ids to text, piece by piece; the state is a few bytes, whatever came before.

    Without as_text: tokens joined by blanks, as the library does for a file
    without a decoder. With it: bytes through UTF-8, word ends as blanks.
    """

    def __init__(self, bpe: Bpe, as_text: bool):
        self.names, self.end, self.as_text, self.begun = bpe.names, bpe.end, as_text, False
        self.byte = {c: b for b, c in enumerate(bpe.bytes)}
        self.added = set(bpe.added.values())
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        if not self.as_text:
            out = " ".join([self.names[i] for i in ids])
            if out and self.begun:
                out = " " + out
            self.begun = self.begun or bool(out)
            return out
        out = []
        for i in ids:
            name = self.names[i]
            if i in self.added:
                out.append(self.utf8.decode(name.encode()))
            elif self.end and name.endswith(self.end):
                out.append(self.utf8.decode(bytes(self.byte[c] for c in name[: -len(self.end)]) + b" "))
            else:
                out.append(self.utf8.decode(bytes(self.byte[c] for c in name)))
        return "".join(out)

    def close(self) -> str:
        """What an unfinished character leaves."""
        return self.utf8.decode(b"", True) if self.as_text else ""


_held: dict[str, Bpe] = kept(__name__)


def loaded(text: str) -> Bpe:
    """The vocabulary, kept by the worker."""
    name = hashlib.sha256(text.encode()).hexdigest()
    if name not in _held:
        _held.clear()
        _held[name] = Bpe(text)
    return _held[name]


def digests(bpe: Bpe, pieces: Iterable[bytes]) -> tuple[int, str, str]:
    """(number, SHA-256 of the ids, SHA-256 of the decoded text), of neither of which more than a piece is held."""
    n, ids_hash, text_hash, d = 0, hashlib.sha256(), hashlib.sha256(), bpe.decoder()
    for p in pieces:
        n += len(p) // 4
        ids_hash.update(p)
        text_hash.update(d.feed(memoryview(p).cast("I")).encode("utf-8", "surrogatepass"))
    text_hash.update(d.close().encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def decoded_digest(bpe: Bpe, ids: bytes) -> str:
    """SHA-256 of the decoded text of all ids."""
    return digests(bpe, (ids[at : at + 4 * PIECE] for at in range(0, len(ids), 4 * PIECE)))[2]


def vocabulary(path: str | None = None) -> str:
    """The tokenizers JSON file, as text; executors get it with the function."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, text: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256, and ids if wanted, in place of the text.

    A null text is an empty one, which has no tokens. Long texts are read piece
    by piece. Repeated rows give equal results, and of equal merges in a word the
    left one is first; an empty table gives an empty one; columns named like the
    new ones are replaced.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # one file of fixed size
    new = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    keep = [c for c in docs.columns if c not in (text, *new)]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = packed.select("row", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256"), *[F.array().cast("array<int>").alias("ids")] * with_ids).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for whole in batches:
            for batch, column in slices(whole):
                ids, found = [], []
                for t in column:
                    pieces = bpe.pieces(t.as_py())
                    if with_ids:
                        ids.append(b"".join(pieces))
                        pieces = (ids[-1][at : at + 4 * PIECE] for at in range(0, len(ids[-1]), 4 * PIECE))
                    found.append(digests(bpe, pieces))
                columns = [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.string()),
                    pa.array([f[2] for f in found], pa.string()),
                ]
                if with_ids:
                    off = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(off, pa.array(np.frombuffer(b"".join(ids), "<i4"))))
                yield pa.RecordBatch.from_arrays(columns, names=["row", *new])

    out = mapped(packed, run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *new)


def op8_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op8_streaming_bpe": op8_streaming_bpe}
ORACLE: dict[str, str] = {}
