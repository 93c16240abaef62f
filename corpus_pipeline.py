"""A training corpus from raw documents: five stages, each on what the one before kept.

Cases that each stage defines. Nulls: a document without a text goes in the
first stage; nulls in other columns stay. Empty and very long texts: the first
go in the first stage as they have no letter, the second are read whole. Repeated
rows: the second stage keeps one of each id and text, the one whose other columns
come first; of near-duplicates it keeps the smallest id. Ties are named by each
operator. Empty tables: every stage gives an empty table of the same columns.
Extra columns, whatever their names, are kept by all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, contamination, importable, language, minhash, pii
from millrace.llm._shared import Scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a text in any learnt language: null ones, those without a letter, and those like none."""
    held = language.held_out("doc_id")
    model = language.learn(docs.filter(~held).select("text", "lang"))
    return language.accepted(docs, model, least=language.least_score(docs.filter(held).select("text", "lang"), model))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that links of five-word shingles connect.

    Of rows with one id and text, that whose columns come first is kept. Where no
    id is repeated, which a count of ids tells, no text moves.
    """
    scratch = Scratch(spark, "dedup")
    found = minhash.near_duplicates(docs.select("doc_id", "text"), f=minhash.Forest(shingle=5), scratch=scratch)
    # a row that is repeated is one document too
    gone = scratch.cut(found.filter(~F.col("kept")).select(F.col("id").alias("doc_id")).distinct(), "copies")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    known = left.filter("doc_id is not null").groupBy("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_t")).agg(F.min(row).alias("_r"))
    return known.select("_r.*").unionByName(left.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Scratch(spark, "leaks")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; n_chars follows the text."""
    out = pii.mask(docs, Scratch(spark, "pii"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of what they decode to, in place of its text."""
    return bpe.encode(docs, with_ids=True)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE", tokens),
]

#: SQL can express neither the models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each on the written result of the one before."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    before = None
    for _, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), "stage")
        if before is not None:  # no later stage reads it
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
