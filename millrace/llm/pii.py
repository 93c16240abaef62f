"""Personal data by weak supervision, in Spark functions alone.

Regular expressions propose spans. Five labelers vote on each of them (+1, 0
or -1): the form (strict, or a looser spelling of the same kind), a gazetteer
(domains, number ranges, country codes, check digits), helping context,
hindering context and the digits' variety. Expectation maximisation over the
counts of each pattern of votes estimates how reliable each labeler is for each
kind, and gives each pattern a probability. These are the soft labels on which
the final span classifier, a logistic regression over votes and span features,
is trained. Only counts by pattern reach the driver: at most kinds x 3^5 votes
x feature buckets rows, whatever the input.

The classifier alone decides on the loose kinds (national telephone numbers,
social security numbers, IBANs), which add to the strict kinds in BASE and
never overlap them. Spans of BASE always stay, as their definition is given;
`doubtful` counts those that the classifier would refuse.

Defined cases: a null or empty text has no spans; texts of any length are read
whole; repeated rows give repeated results; where spans of two loose kinds
overlap, both stay; an empty table gives an empty one, and where no span is
proposed the classifier accepts nothing; columns other than the text are left
alone. Spans count code points, end exclusive.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _native as N
from ._shared import Scratch

# Possessive repeats and the look-behinds keep every scan linear; they match
# what the plain patterns match, for a run of digits or name characters can
# only match from its start, or from the end of the match before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9-])",
    "tel": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b",
}
KINDS = list(PATTERNS)
BASE, LOOSE = KINDS[:4], KINDS[4:]

# The gazetteers.
DOMAINS = "com org net edu gov mil int info biz io de fr es it uk us eu ch at nl be pl pt se no fi dk ca au jp cn in br mx ru".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 234 254 351 352 353 358 370 371 372 380 385 386 420 421 852 886 966 971 972".split()
IBAN_COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()
# Whole words that stand before a span, by kind.
HELPING = {
    "email": "e?-?mails?|contact|write|send|reach|kontakt|correo|courriel",
    "ip": "ip|host|server|address|login|client",
    "card": "cards?|visa|mastercard|credit|debit|karte|carte|tarjeta|payment",
    "phone": "phone|telephone|tel|call|fax|mobile|contact|cell",
    "ssn": "ssn|social|security",
    "tel": "phone|telephone|tel|call|fax|mobile|contact|cell",
    "iban": "iban|account|bank|konto|compte|cuenta",
}
HINDERING = "versions?|v|isbn|issn|orders?|invoice|ref|sku|part|model|serial|ticket"
# Spellings that count as strict.
STRICT = {
    "email": r"^[A-Za-z0-9][^@]*@[A-Za-z0-9].*\.[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]*)\.(?:0|[1-9][0-9]*)\.(?:0|[1-9][0-9]*)\.(?:0|[1-9][0-9]*)$",
    "card": r"^(?:[0-9]+|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4,7})$",
    "phone": r"^\+[0-9]{8,}$|^\+[0-9]{1,3}[\x20.-]\(?[0-9]",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "tel": r"^\([0-9]{3}\)[\x20-][0-9]{3}-[0-9]{4}$",
    "iban": r"^[A-Z0-9]+$|^[A-Z0-9]{4}(?:\x20[A-Z0-9]{4}){3,7}(?:\x20[A-Z0-9]{1,3})?$",
}
# Spellings that are neither strict nor loose: the form tells nothing.
PLAIN = {"ssn": STRICT["ssn"], "tel": r"^[0-9]{3}([\x20.-])[0-9]{3}\1[0-9]{4}$", "iban": STRICT["iban"]}
VOTES = ["form", "gazetteer", "helping", "hindering", "variety"]
FEATURES = VOTES + ["long", "at_line_start"]
CONTEXT = 40
CANDIDATES = "array<struct<kind:string,start:int,end:int,x:array<int>>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(digits))
    values = F.transform(
        at,
        lambda i: F.when(
            (F.length(digits) - i) % 2 == 1,
            F.substring(digits, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0),
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    """Whether the match is one of its kind; matches of loose kinds need a vote."""
    if kind == "ip":
        # parts of many digits may have leading zeros
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(16, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def _gazetteer(kind: str, m: Column) -> Column:
    d = _digits(m)
    if kind == "email":
        return F.when(F.lower(F.substring_index(m, ".", -1)).rlike(f"^(?:{'|'.join(DOMAINS)})$"), 1).otherwise(0)
    if kind == "ip":
        first = F.substring_index(m, ".", 1).try_cast("int")
        return F.when(first.isin(0, 127, 255) | (first >= 224), -1).otherwise(1)
    if kind == "card":
        return F.when(d.rlike("^(4|5[1-5]|2[2-7]|3[0-9]|6)"), 1).otherwise(-1)
    if kind == "phone":
        return F.when(d.rlike(f"^(?:{'|'.join(COUNTRY_CODES)})"), 1).otherwise(-1)
    # most numbers are in the ranges of these two, so being in them tells nothing
    if kind == "ssn":
        return F.when(d.rlike("^(000|666|9)|^...00|0000$"), -1).otherwise(0)
    if kind == "tel":
        return F.when(d.rlike("^[01]|^...[01]"), -1).otherwise(0)
    return F.when(m.rlike(f"^(?:{'|'.join(IBAN_COUNTRIES)})") & (_mod97(m) == 1), 1).otherwise(-1)


def _mod97(m: Column) -> Column:
    """The check of an IBAN: 1 if it is right."""
    own = F.regexp_replace(m, "[^A-Z0-9]", "")
    turned = F.split(F.concat(F.substring(own, 5, 40), F.substring(own, 1, 4)), "")
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda r, c: ((r * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int"))


def _form(kind: str, m: Column) -> Column:
    if kind in PLAIN:
        strict = F.when(m.rlike(STRICT[kind]), 1 if kind == "tel" else 0)
        return strict.when(m.rlike(PLAIN[kind]), 0).otherwise(-1)
    return F.when(m.rlike(STRICT[kind]), 1).otherwise(-1)


def _features(kind: str, gap: Column, m: Column) -> Column:
    """gap: the text before the match, back to the match of the kind before it."""
    before = F.lower(F.right(gap, F.lit(CONTEXT)))
    line = (gap == "") | gap.endswith("\n")
    d = _digits(m)
    x = [
        _form(kind, m),
        _gazetteer(kind, m),
        F.when(before.rlike(rf"\b(?:{HELPING[kind]})\b"), 1).otherwise(0),
        F.when(before.rlike(rf"\b(?:{HINDERING})\b"), -1).otherwise(0),
        F.when(d.rlike(r"^([0-9])\1*$"), -1).otherwise(0) if kind != "email" else F.lit(0),
        F.when(F.length(m) > 16, 1).otherwise(0),
        F.when(line, 1).otherwise(0),
    ]
    return F.array(*[v.cast("int") for v in x])


#: A text without this has no match of the kind; looking for it is cheap.
NEEDS = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}


def _spans(kind: str) -> Column:
    """The kind's valid matches, with votes and features."""
    places = F.arrays_zip(F.col(f"_{kind}_gaps").alias("g"), F.col(f"_{kind}_starts").alias("s"))
    found = F.zip_with(f"_{kind}", places, lambda m, p: F.struct(m.alias("m"), p["s"].alias("s"), p["g"].alias("g")))
    return F.transform(
        F.filter(found, lambda p: _valid(kind, p["m"])),
        lambda p: F.struct(
            F.lit(kind).alias("kind"), p["s"].alias("start"), (p["s"] + F.length(p["m"])).cast("int").alias("end"), _features(kind, p["g"], p["m"]).alias("x")
        ),
    )


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the column `candidates` (CANDIDATES): valid matches with votes and features."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    hits = {k: N.matches(t, p) for k, p in PATTERNS.items()}
    # few steps for all kinds, as each one is analysed anew
    df = df.withColumns({f"_{k}": F.when(t.contains(NEEDS[k]), h).otherwise(none) if k in NEEDS else h for k, h in hits.items()})
    df = df.withColumns({f"_{k}_gaps": F.when(F.size(f"_{k}") > 0, N.gaps(t, p, F.col(f"_{k}"))).otherwise(none) for k, p in PATTERNS.items()})
    df = df.withColumns({f"_{k}_starts": N.offsets(F.col(f"_{k}_gaps"), F.col(f"_{k}")) for k in KINDS})
    df = df.withColumns({f"_{k}": F.when(F.size(f"_{k}") > 0, _spans(k)).otherwise(F.array().cast(CANDIDATES)) for k in KINDS})
    base = F.concat(*[F.col(f"_{k}") for k in BASE])
    loose = F.concat(*[F.col(f"_{k}") for k in LOOSE])
    free = F.filter(loose, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return df.withColumn("candidates", F.concat(base, free)).drop(*[f"_{k}{x}" for k in KINDS for x in ("", "_gaps", "_starts")])


def patterns(found: DataFrame) -> DataFrame:
    """How often each kind has each pattern of votes and features."""
    return found.filter(F.size("candidates") > 0).select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.x").agg(F.count(F.lit(1)).alias("n"))


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 200, tie: float = 0.1) -> np.ndarray:
    """Probability that a pattern of votes (-1, 0, 1) is personal data.

    Votes are independent given the truth; each labeler has a distribution of
    votes for either truth, estimated from all patterns, with a few counts to begin with.
    Where fewer than three labelers know something, such distributions fit the
    counts equally well in many ways; `tie` settles it: either distribution
    also counts, by that weight, what the other one has with signs reversed,
    as if a labeler erred alike on both sides.
    """
    # before anything is known: the majority, and no where nothing speaks for it
    p = 1 / (1 + np.exp(0.5 - votes.sum(axis=1).astype(float)))
    cast = [[votes[:, j] == v for v in (-1, 0, 1)] for j in range(votes.shape[1])]
    for _ in range(rounds):
        prior = np.clip(((p * n).sum() + 1) / (n.sum() + 2), 0.02, 0.98)
        log = np.log(prior) - np.log(1 - prior) + np.zeros(len(n))
        for own in cast:
            # a labeler counts as better than chance, and as silent in most cases, until counts say otherwise
            yes = np.array([(p * n)[at].sum() for at in own]) + [1, 4, 2]
            no = np.array([((1 - p) * n)[at].sum() for at in own]) + [2, 4, 1]
            yes, no = yes + tie * no[::-1], no + tie * yes[::-1]
            for at, q in zip(own, np.log(yes / yes.sum()) - np.log(no / no.sum()), strict=True):
                log[at] += q
        p = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
    return p


def train(found: DataFrame, rounds: int = 400, em_rounds: int = 200) -> dict[str, np.ndarray]:
    """kind: weights of the span classifier, the last one the constant.

    Without rounds of expectation maximisation, its soft labels are majorities.
    """
    rows = patterns(found).collect()  # as many as there are patterns of votes
    out = {}
    for kind in KINDS:
        own = sorted((tuple(r["x"]), r["n"]) for r in rows if r["kind"] == kind)
        if not own:
            continue
        x, n = np.array([o[0] for o in own], float), np.array([o[1] for o in own], float)
        soft = expectation_maximisation(x[:, : len(VOTES)].astype(int), n, em_rounds)
        a, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
        share = n / n.sum()
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            w -= 0.5 * (a.T @ (share * (p - soft)) + 1e-3 * w)
        out[kind] = w
    return out


def classify(found: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """`candidates` becomes `findings` (N.SPAN), those of BASE and the others that the model accepts, and `doubtful`."""

    def believed(c: Column) -> Column:
        ok = F.lit(False)
        for kind, w in model.items():
            weights = F.split(F.lit(" ".join(repr(float(v)) for v in w)), " ").cast("array<double>")
            z = F.aggregate(F.zip_with(F.concat(c["x"], F.array(F.lit(1))), weights, lambda x, v: x * v), F.lit(0.0), lambda t, v: t + v)
            ok = F.when(c["kind"] == kind, z >= 0).otherwise(ok)
        return ok

    kept = F.filter("candidates", lambda c: c["kind"].isin(BASE) | believed(c))
    spans = F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    doubtful = F.size(F.filter("candidates", lambda c: c["kind"].isin(BASE) & ~believed(c))).cast("long")
    return found.withColumns({"findings": spans, "doubtful": doubtful}).drop("candidates")


def _packed(df: DataFrame, text: str) -> DataFrame:
    """(row, text): the columns of df, whatever their names, out of the way."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text], F.lit(0).alias("_")).alias("row"), F.col(f"`{text}`").alias("text"))


def detect(df: DataFrame, scratch: Scratch, text: str = "text") -> DataFrame:
    """The rows of df with `findings` (N.SPAN) and `doubtful` in place of the text, which is read once."""
    found = scratch.cut(candidates(_packed(df, text)).drop("text"), "candidates")
    out = classify(found, train(found))
    return out.select(*[F.col("row").getField(c).alias(c) for c in df.columns if c not in (text, "findings", "doubtful")], "findings", "doubtful")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, as <KIND>."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        put = F.array(F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(a["out"], put)).otherwise(a["out"]).alias("out"))

    done = F.aggregate(order, state, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.greatest(F.length(text) - a["at"], F.lit(0)))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def mask(df: DataFrame, scratch: Scratch, text: str = "text") -> DataFrame:
    """df with its personal data masked. Null texts stay null.

    The candidates are found twice, which costs less than to write all texts
    or to join them back.
    """
    model = train(scratch.cut(candidates(df.select(F.col(f"`{text}`").alias("text"))).drop("text"), "candidates"))
    found = classify(candidates(_packed(df, text)), model)
    return found.select(*[masked(F.col("text"), F.col("findings")).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns])


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = detect(docs, Scratch(spark, "pii")).withColumn("findings", N.ordered(F.col("findings"), KINDS, start_first=False))
    base = F.filter("findings", lambda s: s["kind"].isin(BASE))
    return found.select(
        "doc_id",
        *[N.n_of(F.col("findings"), k).alias(f"n_{k}") for k in BASE],
        F.sha2(N.digest(base).cast("binary"), 256).alias("base_sha256"),
        N.digest(F.col("findings")).alias("spans"),
        *[N.n_of(F.col("findings"), k).alias(f"n_{k}") for k in LOOSE],
        F.size("findings").cast("long").alias("n_spans"),
        F.col("doubtful").alias("n_doubtful"),
    )


QUERIES = {"op3_personal_data": op3_personal_data}
ORACLE: dict[str, str] = {}
