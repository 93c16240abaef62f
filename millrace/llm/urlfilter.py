"""URL verdicts: rules first, else gradient-boosted trees on lexical features.

A rule (host, path, verdict) fits its host and all subdomains, where the URL's
path starts with the rule's; the longest fitting rule decides. URLs that a rule
decides are the labelled ones: the trees learn the rules' verdicts from length,
depth, digit ratio, entropy, parameter counts and statistics of suffixes of the
host, and decide the rest.

Rules are few and given, so they are literal expressions; suffix statistics are
a grouped sum over all labelled URLs; where a URL is one of those it is fitted
on, its own label is left out of its statistics. The trees are fitted on about
SAMPLE labelled URLs at most, drawn by a hash of the URL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import Scratch

SAMPLE = 20_000
TREES, DEPTH = 10, 4
#: Rows of a suffix without labels, in the statistics of all.
PRIOR = 20.0

# The rules of the query, (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@dataclass
class Model:
    """Statistics of suffixes and trees; without trees, the verdict of all."""

    suffixes: DataFrame | None
    rate: float
    trees: GBTClassificationModel | None


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.when(url.isNull(), F.lit("")).otherwise(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def path_of(url: Column) -> Column:
    return F.when(url.isNull(), F.lit("")).otherwise(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        own = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, own) if out is None else out.when(fits, own)
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return none if out is None else out.otherwise(none)


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits: sorted, equal ones are runs, counted in one go."""
    n = F.length(text)
    empty = F.struct(F.lit("").alias("c"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    sum_of = lambda s: s["sum"] + s["run"] * F.log2(F.greatest(s["run"], F.lit(1)))

    def add(s: Column, x: Column) -> Column:
        same = s["c"] == x
        return F.struct(x.alias("c"), F.when(same, s["run"] + 1).otherwise(1).alias("run"), F.when(same, s["sum"]).otherwise(sum_of(s)).alias("sum"))

    return F.when(n > 0, F.log2(n) - F.aggregate(F.sort_array(F.split(text, "")), empty, add, sum_of) / n).otherwise(0.0)


FEATURES = ["length", "host_length", "host_depth", "path_depth", "digits", "host_digits", "entropy", "host_entropy", "parameters", "fragment", "hyphens", "secure", "suffix1", "suffix2", "suffix3"]


def features(df: DataFrame) -> DataFrame:
    """Adds the lexical features of `url` (with `host` and `path`), but for the suffix statistics, and their keys."""
    url = F.coalesce("url", F.lit(""))
    n, h = F.length(url), F.col("host")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = F.split(h, r"\.")
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", "")) / F.greatest(F.length(c), F.lit(1))
    first = F.filter(F.split("path", "/"), lambda x: x != "")
    return df.withColumns(
        {
            "length": n.cast("double"),
            "host_length": F.length(h).cast("double"),
            "host_depth": F.size(parts).cast("double"),
            "path_depth": F.size(first).cast("double"),
            "digits": digits(url),
            "host_digits": digits(h),
            "entropy": _entropy(url),
            "host_entropy": _entropy(h),
            "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
            "fragment": F.when(url.contains("#"), 1.0).otherwise(0.0),
            "hyphens": F.length(F.regexp_replace(url, "[^-]", "")).cast("double"),
            "secure": F.when(url.startswith("https"), 1.0).otherwise(0.0),
            # the top label, the top two, and the path's first part, hashed so that any length will do
            "key1": F.concat(F.lit("1:"), F.md5(F.substring_index(h, ".", -1))),
            "key2": F.concat(F.lit("2:"), F.md5(F.substring_index(h, ".", -2))),
            "key3": F.concat(F.lit("3:"), F.md5(F.coalesce(F.get(first, F.lit(0)), F.lit("")))),
        }
    )


def _with_suffixes(df: DataFrame, model: Model, label: str | None = None) -> DataFrame:
    """Adds suffix1 to suffix3: the share of blocked URLs among those labelled with the same suffix.

    A row that has a `label` is one of these, and doesn't count for itself.
    """
    n, s = F.coalesce("_n", F.lit(0)), F.coalesce("_s", F.lit(0.0))
    if label:
        n, s = n - 1, s - F.col(label)
    for i in (1, 2, 3):
        # joined, not broadcast: there are as many suffixes as the input has
        own = model.suffixes.select(F.col("key").alias(f"key{i}"), F.col("n").alias("_n"), F.col("s").alias("_s"))
        df = df.join(own, f"key{i}", "left").withColumn(f"suffix{i}", (s + PRIOR * model.rate) / (n + PRIOR)).drop("_n", "_s")
    return df


def judged(df: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """df with host, path, rule and verdict; the verdict is null where no rule fits."""
    out = df.withColumn("url", F.col(url)).withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return out.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules)).withColumns({"rule": F.col("_r.rule"), "verdict": F.col("_r.verdict")}).drop("_r")


def train(urls: DataFrame, scratch: Scratch, rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> Model:
    """A model from the URLs that a rule decides; of one verdict alone, or of none, it has no trees."""
    own = judged(urls.select("url"), rules=rules).filter("rule is not null")
    own = own.withColumn("label", (F.col("verdict") == "block").cast("double")).withColumn("draw", F.xxhash64("url"))
    known = scratch.cut(features(own).drop("url", "path", "host", "rule", "verdict"), "labelled")
    n, blocked = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    blocked = blocked or 0.0
    rate = blocked / n if n else 0.0
    if not n or blocked in (0.0, float(n)):
        return Model(None, rate, None)
    keys = known.select("label", F.explode(F.array("key1", "key2", "key3")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"))
    suffixes = scratch.cut(keys, "suffixes")
    model = Model(suffixes, rate, None)
    if n > sample:
        known = known.filter(F.pmod("draw", F.lit(1 << 30)) < int((1 << 30) * sample / n))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(_with_suffixes(known, model, "label")).select("draw", "label", "x")
    # a bounded sample, dealt and ordered by its hash, so that a rerun sees the same
    rows = scratch.cut(rows.repartition(2, "draw").sortWithinPartitions("draw", "label").select("label", "x"), "sample")
    return Model(suffixes, rate, GBTClassifier(labelCol="label", featuresCol="x", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=10).fit(rows))


def judge(df: DataFrame, model: Model, key: str, url: str = "url", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(key, host, path, rule, verdict, score) for each row of df.

    A null url, or one without "://", has an empty host and path, and the
    trees' verdict on those. URLs of any length are read whole. Repeated rows
    get equal verdicts; of rules of one length the first by host and path
    decides; an empty table gives an empty result; other columns are not read.
    Where nothing could be learnt, the verdict is allow, or block if all
    labelled URLs are blocked.
    """
    own = judged(df.select(F.col(key).alias("key"), F.col(url).alias("url")), rules=rules)
    if model.trees is None:
        out = own.withColumn("score", F.lit(1.0 if model.rate > 0.5 else 0.0))
    else:
        rest = _with_suffixes(features(own), model)
        x = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rest)
        out = model.trees.transform(x).withColumn("score", vector_to_array("probability")[1])
    method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return out.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), F.when(F.col("rule").isNull(), F.col("score")).alias("score"))


def agreement(urls: DataFrame, scratch: Scratch, url: str = "url") -> tuple[int, float, float]:
    """(number, share judged as the rules do, the same of blocked ones), on a fifth of the URLs that rules decide, of which the trees learn nothing."""
    urls = urls.select(F.col(url).alias("url"))
    held = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(5)) == 0
    out = judge(urls.filter(held).withColumn("key", F.lit(0)), train(urls.filter(~held), scratch), "key", rules=[])
    out = out.withColumn("_r", rule_of(F.col("host"), F.col("path"))).filter("_r.rule is not null")
    right, block = F.col("_r.verdict") == F.col("verdict"), F.col("_r.verdict") == "block"
    r = out.agg(F.count(F.lit(1)), F.avg(right.cast("double")), F.avg(F.when(block, right.cast("double")))).first()
    return r[0], r[1] or 0.0, r[2] or 0.0


def op10_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, train(pages, Scratch(spark, "urls")), "page_id")


QUERIES = {"op10_url_trees": op10_url_trees}
ORACLE: dict[str, str] = {}
