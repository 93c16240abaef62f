"""Named queries over the fixture tables, each with the same query in SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["tpch", "relational", "extensions", "scalars", "streams", "advanced", "layouts", "lines"]


def queries() -> dict:
    return {k: q for m in MODULES for k, q in import_module(f".{m}", __name__).QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in import_module(f".{m}", __name__).ORACLE.items()}
