"""The source of JSON lines: ranges, its filters, offsets over a restart, and odd lines."""

from __future__ import annotations

import io
import json
import os

import pytest

from millrace import plans
from millrace.sources import lines

DATA = os.environ.get("MILLRACE_DATA", "/root/testdata/sf0.001")
SCHEMA = "i long, s string, o struct<k: long>"


@pytest.mark.parametrize("text", [b"", b"a", b"a\n", b"a\nbb\n\nccc", b"\n\nx\n", b"a" * 30 + b"\nb\n"])
@pytest.mark.parametrize("split", [1, 2, 3, 7, 100])
@pytest.mark.parametrize("block", [1, 4, 64])
def test_each_line_is_in_one_range(text, split, block):
    found = [b for at in range(0, len(text), split) for b in lines.lines(io.BytesIO(text), at, min(at + split, len(text)), block)]
    assert b"".join(found) == text and all(b.endswith(b"\n") for b in found[:-1])


def put(path, rows):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def read(spark, path, split=20, where=()):
    return lines.opened(spark, str(path), SCHEMA, where, split)


def test_rows_nulls_and_unknown_columns(spark, tmp_path):
    put(tmp_path / "t/a.json", [{"i": 1, "s": "é\n", "o": {"k": 2}}, "", {"s": None, "extra": [1]}, {"i": 3, "s": "x" * 100}])
    put(tmp_path / "t/_SUCCESS", ["no JSON"])
    put(tmp_path / "t/b/empty.json", [])
    df = read(spark, tmp_path / "t")
    assert df.rdd.getNumPartitions() > 3
    rows = sorted(((r.i, r.s, r.o and r.o.k) for r in df.collect()), key=str)
    assert rows == sorted([(1, "é\n", 2), (None, None, None), (3, "x" * 100, None)], key=str)
    assert read(spark, tmp_path / "none").collect() == []


def test_filters_in_the_reader(spark, tmp_path):
    put(tmp_path / "a.json", [{"i": i, "s": "ab"[i % 2], "o": {"k": i}} for i in range(50)] + [{"i": None, "s": "a"}])

    def kept(*where):
        return sorted(str(r.i) for r in read(spark, tmp_path, 200, where).collect())

    assert kept(("i", ">", 40), ("s", "=", "a")) == ["42", "44", "46", "48"]
    assert kept(("i", "<=", 1)) == ["0", "1"] and kept(("i", "<", 1)) == ["0"] and kept(("i", ">=", 49)) == ["49"]
    assert kept(("i", "in", [1, 5, 99])) == ["1", "5"] and kept(("i", "=", None)) == []


def test_scans_of_one_frame_keep_their_own_filters(spark, tmp_path):
    put(tmp_path / "a.json", [{"i": i} for i in range(50)])
    df = read(spark, tmp_path, 200)
    assert sorted(r.i for r in df.filter("i < 2").union(df.filter("i > 47")).collect()) == [0, 1, 48, 49]
    assert df.select("i").count() == 50
    both = read(spark, tmp_path, 200, [("i", "<", 2)]).union(read(spark, tmp_path, 200, [("i", ">", 47)]))
    assert sorted(r.i for r in both.collect()) == [0, 1, 48, 49]


def test_a_restarted_stream_goes_on_after_the_last_file(spark, tmp_path):
    def run():
        s = lines.opened(spark, str(tmp_path / "in"), SCHEMA, [("i", "<", 12)], 30, stream=True)
        s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.i for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).collect())

    put(tmp_path / "in/1.json", [{"i": i} for i in range(10)])
    assert run() == list(range(10))
    assert run() == list(range(10))
    put(tmp_path / "in/2.json", [{"i": i} for i in range(10, 13)])
    assert run() == list(range(12))  # the filter holds for streams too


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no fixtures here")
def test_batch_and_stream_give_the_events(spark):
    e = spark.read.parquet(f"{DATA}/events.parquet")
    found = plans.queries()["lines_stream"](spark, DATA)
    assert found.select("event_id", "ts", "value").exceptAll(e.select("event_id", "ts", "value")).isEmpty() and found.count() == e.count()
    own = plans.queries()["lines_batch"](spark, DATA)
    assert own.agg({"n": "sum"}).first()[0] == e.filter("event_type = 'purchase' and value > 50").count() > 0
