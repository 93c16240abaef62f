"""A source of JSON lines for batches and streams: byte ranges as partitions, filters in the reader, offsets by file.

``register(spark)`` makes it known; then ``spark.read.format("json_lines").schema(...).load(path)``
and ``spark.readStream`` likewise, or ``opened(...)`` for either. Paths are those of Arrow's file
systems (file, hdfs, s3, gs), so that tasks read their ranges themselves.

Filters are given with the path (``where``) and are of that DataFrame for good. ``pushFilters`` isn't
offered on purpose: in Spark 4.1.2 all scans of one DataFrame of a Python source share what was
pushed last, so that ``df.filter("i < 2").union(df.filter("i > 47"))`` gave the rows above 47 twice,
and ``df.count()`` after it only counted those.

Cases. A column that a line lacks is null, and what the schema doesn't name is left out. Blank
lines are no rows; a line that isn't JSON ends the query. An empty folder gives no rows. A
line belongs to the range in which it begins, so each is read once, however long; a task holds a
block of lines or one line. A stream takes whole files in order of their names: a
file must be complete once it is there, and named after all that came before.
"""

from __future__ import annotations

import io
import json
import operator
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.json
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "json_lines"
#: Bytes of a partition, and of what a task holds at once.
SPLIT, BLOCK = 32 << 20, 4 << 20


@dataclass(frozen=True)
class Span(ds.InputPartition):
    """The lines of a file that begin in start <= byte < end."""

    path: str
    start: int
    end: int


def lines(f, start: int, end: int, block: int = BLOCK) -> Iterator[bytes]:
    """Blocks of whole lines, of all lines of the file f that begin in start <= byte < end."""
    at = start
    if start:  # the line that holds the byte before belongs to another range, unless it ends there
        at -= 1
        f.seek(at)
        while (cut := (got := f.read(block)).find(b"\n")) < 0:
            if not got:
                return
            at += len(got)
        at += cut + 1
    f.seek(at)
    held: list[bytes] = []
    while at < end and (got := f.read(min(block, end - at))):
        at += len(got)
        if cut := got.rfind(b"\n") + 1:
            yield b"".join([*held, got[:cut]])
            held = [got[cut:]] if cut < len(got) else []
        else:
            held.append(got)
    while held:  # the last line reaches beyond the range
        got = f.read(block)
        cut = got.find(b"\n") + 1
        if cut or not got:
            yield b"".join([*held, got[:cut]])
            return
        held.append(got)


def _condition(name: str, how: str, value: object) -> pc.Expression:
    """Keeps the rows in which a column compares so; as in SQL, a null doesn't."""
    field = pc.field(name)
    if how == "in":
        return field.isin(value)
    compare = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
    return compare[how](field, value) if value is not None else pc.scalar(False)


def _files(path: str) -> list[pa.fs.FileInfo]:
    """Files below path by name, without hidden ones and those of unfinished writes."""
    system, root = pa.fs.FileSystem.from_uri(path)
    found = system.get_file_info(pa.fs.FileSelector(root, recursive=True, allow_not_found=True))
    shown = [x for x in found if x.is_file and not any(p.startswith(("_", ".")) for p in x.path[len(root) :].split("/"))]
    return sorted(shown, key=lambda x: x.path)


def _spans(files: Iterable[pa.fs.FileInfo], split: int) -> list[Span]:
    return [Span(x.path, at, min(at + split, x.size)) for x in files for at in range(0, x.size, split)]


class _Rows:
    """What the readers of batches and streams share: options, and the rows of a span."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path, self.split = schema, options["path"], int(options.get("split", SPLIT))
        self.keep = [_condition(*c) for c in json.loads(options.get("where", "[]"))]

    def read(self, span: Span | None) -> Iterator[pa.RecordBatch]:
        if span is None:  # where there are no partitions, Spark reads one without a name
            return
        schema = to_arrow_schema(self.schema)
        parse = pa.json.ParseOptions(explicit_schema=schema, unexpected_field_behavior="ignore")
        system, _ = pa.fs.FileSystem.from_uri(self.path)
        with system.open_input_file(span.path) as f:
            for block in lines(f, span.start, span.end):
                if block.strip():
                    rows = pa.json.read_json(io.BytesIO(block), pa.json.ReadOptions(use_threads=False, block_size=len(block) + 1), parse).select(schema.names)
                    for keep in self.keep:
                        rows = rows.filter(keep)
                    yield from rows.to_batches()


class Batch(_Rows, ds.DataSourceReader):
    def partitions(self) -> list[Span]:
        return _spans(_files(self.path), self.split)


class Stream(_Rows, ds.DataSourceStreamReader):
    """An offset names the last file that was read."""

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": max([x.path for x in _files(self.path)], default="")}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return _spans([x for x in _files(self.path) if start["after"] < x.path <= end["after"]], self.split)

    def commit(self, end: dict) -> None:
        """Files stay where they are."""


class JsonLines(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        raise ValueError(f"{NAME} reads no file to find a schema: name one by .schema()")

    def reader(self, schema: StructType) -> Batch:
        return Batch(schema, self.options)

    def streamReader(self, schema: StructType) -> Stream:
        return Stream(schema, self.options)


def register(spark: SparkSession) -> None:
    """Makes the source known."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers needn't have the package
    spark.dataSource.register(JsonLines)


def opened(spark: SparkSession, path: str, schema: str | StructType, where: list[tuple[str, str, object]] = (), split: int = SPLIT, stream: bool = False) -> DataFrame:
    """The lines below path for which all of `where` holds: (column, how, value), how one of = < <= > >= in.

    Rows that a task's reader leaves out never leave Python. A null is in no condition's rows,
    but for one that a list of `in` names.
    """
    register(spark)
    reader = spark.readStream if stream else spark.read
    return reader.format(NAME).schema(schema).option("split", split).option("where", json.dumps([list(c) for c in where])).load(path)
