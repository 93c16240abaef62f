"""Every query with SQL gives what DuckDB gives, at the smallest scale."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from millrace import plans

DATA = os.environ.get("MILLRACE_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no fixtures here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return c


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query(spark, duck, name):
    df = plans.queries()[name](spark, DATA)
    found = duck.execute(plans.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(tuple(map(value, r)) for r in found.fetchall())
    got = sorted(tuple(map(value, r)) for r in df.select(*columns).collect())
    assert got == want


def test_every_query_has_sql():
    assert set(plans.queries()) - set(plans.oracle_sql()) == {"approximate"}


def test_entry_imports_without_the_llm_folders(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "millrace.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delattr("millrace.llm", raising=False)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert "pricing_summary" in entry.queries()
    assert "pipeline" not in entry.queries()
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)


def test_entry_query_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_join_hints_choose_the_join(spark):
    plan = lambda name: plans.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan("broadcast_hint") and "SortMergeJoin" in plan("merge_hint")


@pytest.mark.parametrize("name", ["except_distinct", "except_all", "null_tests", "sketch_errors", "right_join", "union_all"])
def test_queries_have_rows(spark, name):
    assert plans.queries()[name](spark, DATA).count() > 0
