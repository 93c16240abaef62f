"""Operators for training-data pipelines; nothing else in the library imports them."""

from __future__ import annotations

from functools import wraps
from importlib import import_module
from pathlib import Path

MODULES = ["contamination", "secrets", "pii", "embedding_dedup", "language", "minhash", "token_store", "bpe", "toxicity", "urlfilter", "merkle", "vector_codes", "order_minhash"]


def importable(spark) -> None:
    """Lets the Python workers of a local session import this package from any folder.

    On a cluster it is installed, or sent with --py-files.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local["):
        sc.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def _ready(query):
    @wraps(query)
    def run(spark, sf_dir):
        importable(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {k: _ready(f) for m in MODULES for k, f in import_module(f".{m}", __name__).QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: f for m in MODULES for k, f in import_module(f".{m}", __name__).ORACLE.items()}
