"""Secret scans over an incremental blob ledger.

Every historical version of a file is addressed by the SHA-256 of its content.
The ledger holds, for each blob, the rule versions that have scanned it and
what they found. A scan takes the blob ids of all versions, leaves out those
that the ledger knows under all rules, takes one text of each blob that is left,
runs the rule versions that it hasn't seen, and joins the findings back to all
paths that hold the blob. Texts of known blobs never move. Everything is a
Spark function.

Defined cases: a null text is an empty one; texts of any length are scanned
whole; repeated rows and copies share one scan and each get its findings; spans
of several kinds may start at one place, and are in the order of the rules
then; a text without secrets has empty findings; an empty table gives an empty
result and an empty ledger; other columns are left alone, whatever their names,
for only `path` and `text` are read. Spans count code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _native as N
from ._shared import Scratch


@dataclass(frozen=True)
class Rule:
    """What `pattern` matches is a finding if `group` of it has `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: A run of hex digits or of an access key is maximal, so {24,} and {16,} match
#: just those maximal runs that are long enough. No rule repeats a group without
#: a small bound: Java's matcher would recurse once for each repeat.
RULES = [
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 2, r"-----BEGIN (?:[A-Z0-9 ]{1,60} )?PRIVATE KEY-----"),
    Rule("hub", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
]
KINDS = [r.kind for r in RULES]
BASE = KINDS[:3]
#: So many blob ids, of 64 bytes, are sent to all tasks at most.
FEW_BLOBS = 50_000
LEDGER = f"blob string, scanned array<string>, findings {N.SPAN}"


def _run(df: DataFrame, rule: Rule) -> DataFrame:
    """Adds the column rule.kind with the spans of the rule, empty where it isn't due."""
    due = F.array_contains("due", rule.name)
    none = F.array().cast("array<string>")
    hit, value = f"{rule.kind}_hit", f"{rule.kind}_value"
    df = df.withColumn(hit, F.when(due, N.matches(F.col("text"), rule.pattern)).otherwise(none))
    some = F.size(hit) > 0
    if rule.group:
        df = df.withColumn(value, F.when(some, N.matches(F.col("text"), rule.pattern, rule.group)).otherwise(none))
    else:
        df = df.withColumn(value, F.col(hit))
    starts = F.when(some, N.offsets(N.gaps(F.col("text"), rule.pattern, F.col(hit)), F.col(hit))).otherwise(F.array().cast("array<int>"))
    spans = F.zip_with(
        starts,
        F.arrays_zip(F.col(hit).alias("h"), F.col(value).alias("v")),
        lambda s, x: F.struct(
            F.lit(rule.kind).alias("kind"),
            s.alias("start"),
            (s + F.length(x["h"])).cast("int").alias("end"),
            (F.length(x["v"]) >= rule.least).alias("ok"),
        ),
    )
    spans = F.transform(F.filter(spans, lambda s: s["ok"]), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return df.withColumn(rule.kind, F.when(some, spans).otherwise(F.array().cast(N.SPAN))).drop(hit, value)


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_blobs(versions: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """LEDGER rows for every blob of `versions` (column text) that had a rule to run.

    A row replaces the ledger's row of its blob: findings of rule versions
    that ran before are kept, those of a replaced version are not.
    """
    names = [r.name for r in rules]
    texts = versions.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", blob_id(F.col("text")))
    if ledger is None:
        blobs = _one_text(texts).withColumns({"scanned": F.array().cast("array<string>"), "findings": F.array().cast(N.SPAN)})
    else:
        blobs = _due(texts, ledger, names).join(ledger.select("blob", "scanned", "findings"), "blob", "left").withColumns(
            {"scanned": F.coalesce("scanned", F.array().cast("array<string>")), "findings": F.coalesce("findings", F.array().cast(N.SPAN))}
        )
    all_names = F.array(*map(F.lit, names))
    blobs = blobs.withColumn("due", F.array_except(all_names, "scanned")).filter(F.size("due") > 0)
    for rule in rules:
        blobs = _run(blobs, rule)
    due_kinds = F.transform("due", lambda d: F.substring_index(d, "@", 1))
    kept = F.filter("findings", lambda s: ~F.array_contains(due_kinds, s["kind"]) & F.array_contains(F.array(*[F.lit(r.kind) for r in rules]), s["kind"]))
    found = F.concat(kept, *[F.col(r.kind) for r in rules])
    return blobs.select("blob", all_names.alias("scanned"), found.alias("findings"))


def _one_text(texts: DataFrame) -> DataFrame:
    """A partial aggregate first, so that a task sends one text of each blob it has."""
    return texts.groupBy("blob").agg(F.first("text").alias("text"))


def _due(texts: DataFrame, ledger: DataFrame, names: list[str]) -> DataFrame:
    """(blob, text) of the blobs that the ledger doesn't know under all of the rules."""
    known = ledger.filter(F.size(F.array_except(F.array(*map(F.lit, names)), "scanned")) == 0).select("blob")
    due = texts.select("blob").distinct().join(known, "blob", "left_anti")
    if due.count() <= FEW_BLOBS:
        return _one_text(texts.join(F.broadcast(due), "blob", "left_semi"))
    # many: all texts move, but the copies that a task holds don't
    return _one_text(texts).join(due, "blob", "left_semi")


def merge(ledger: DataFrame, scanned: DataFrame) -> DataFrame:
    """The ledger after a scan."""
    return ledger.select("blob", "scanned", "findings").join(scanned.select("blob"), "blob", "left_anti").unionByName(scanned)


def scan(versions: DataFrame, path: str, ledger: DataFrame | None = None, rules: list[Rule] = RULES, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings by path, ledger): each row's `path` column with all spans of its blob.

    With scratch, the ledger is written first, so that the join with the paths
    has a side that Spark can split where very many paths hold one blob.
    """
    scanned = scan_blobs(versions, ledger, rules)
    after = scanned if ledger is None else merge(ledger, scanned)
    if scratch is not None:
        after = scratch.cut(after, "ledger")
    # most blobs have no findings: their rows need no more than a missing match
    found = after.filter(F.size("findings") > 0).select("blob", "findings")
    paths = versions.select(F.col(path).alias("_path"), blob_id(F.col("text")).alias("blob"))
    out = paths.join(found, "blob", "left").select(F.col("_path").alias(path), "blob", F.coalesce("findings", F.array().cast(N.SPAN)).alias("findings"))
    return out, after


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: every document's secrets.

    The first scan fills the ledger; the second, as the next run of the job
    would, finds no unseen pair, moves no text, and reads the ledger.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scratch = Scratch(spark, "secrets")
    ledger = scratch.cut(scan_blobs(docs), "ledger")
    found, _ = scan(docs, "doc_id", ledger, scratch=scratch)
    spans = found.withColumn("findings", N.ordered(F.col("findings"), KINDS, start_first=True))
    base = F.filter("findings", lambda s: s["kind"].isin(BASE))
    return spans.select(
        "doc_id",
        *[N.n_of(F.col("findings"), k).alias(f"n_{k}") for k in BASE],
        F.sha2(N.digest(base).cast("binary"), 256).alias("base_sha256"),
        N.digest(F.col("findings")).alias("spans"),
    )


def _sql() -> str:
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {i} AS k, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, '{p}') AS gaps,
    regexp_extract_all(t, '{p}') AS hits, regexp_extract_all(t, '{p}', {r.group}) AS vals
  FROM docs""")
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
e AS (SELECT doc_id, k, kind, least, gaps, hits, vals, unnest(range(1, len(hits) + 1)) AS i FROM m WHERE len(hits) > 0),
s AS (SELECT doc_id, k, kind, least, length(vals[i]) AS n,
    (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0))::BIGINT AS a, length(hits[i]) AS w
  FROM e),
f AS (SELECT doc_id, k, kind, a, kind || ':' || a || ':' || (a + w) AS x FROM s WHERE n >= least),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS na, count(*) FILTER (kind = 'access') AS nc, count(*) FILTER (kind = 'hex') AS nh,
    string_agg(x, ',' ORDER BY a, k) FILTER (k < 3) AS b, string_agg(x, ',' ORDER BY a, k) AS x FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(na, 0)::BIGINT AS n_assign, coalesce(nc, 0)::BIGINT AS n_access, coalesce(nh, 0)::BIGINT AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(x, '') AS spans
FROM docs d LEFT JOIN g ON g.doc_id = d.doc_id
"""


QUERIES = {"op2_secret_scan": op2_secret_scan}
ORACLE = {"op2_secret_scan": _sql()}
