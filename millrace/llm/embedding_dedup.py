"""Near-duplicate embeddings: an epsilon grid order join.

Unit vectors have a cosine of c or more just if their distance is at most
sqrt(2 - 2c) = epsilon. Distinct vectors of one group (label and length) are
sorted by the cells, a FINE-th of epsilon wide, of their leading principal
coordinates within groups; the sorted sequence is cut into blocks of BLOCK
vectors with a bounding box each. The join starts from the whole sequence with
itself and recurses: an interval pair that a box distance above epsilon proves
distant is skipped, any other is replaced by the pairs of its parts, down to
blocks. Within a pair of blocks, each interval of PART vectors meets just those
vectors of the other block that are not distant from its box; these are
compared exactly, in double precision. The length of what the projection leaves
out is one more coordinate. Neither lengthens distances, so nothing is lost.

A compared pair of blocks gives counts per vector and the edges of a spanning
forest, never all pairs; equal vectors are one row with its number of copies.
The driver gets the d x d moments, the number of blocks, and nothing that
grows with the rows. How much boxes can skip depends on the data: of vectors
spread evenly in many dimensions, most are near each other in a few of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import Scratch, components, mapped

BLOCK = 512
PART = 32
DIMENSIONS = 8
FINE = 4
FANOUT = 8
#: Rounding of unit vectors, projections and distances stays far below this.
SLACK = 1e-6

CLASS = "id long, copies long, part string, dim int, unit binary"
BLOCKS = "pid int, seq int, part string, dim int, low array<double>, high array<double>, ids array<long>, copies array<long>, units binary"


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of doubles from binary unit vectors, with zeros up to dim."""
    rows = [np.frombuffer(x, np.float64) for x in column.to_pylist()]
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def usable(df: DataFrame, key: str, vector: str, group: str) -> DataFrame:
    """(id, part, vector as doubles) of the rows that can have links."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    own = df.select(F.col(key).cast("long").alias("id"), F.col(group).alias("part"), v.alias("v"))
    return own.filter("id is not null and part is not null and v is not null").filter(finite).filter(F.exists("v", lambda x: x != 0))


def moments(vectors: DataFrame, dim: int) -> np.ndarray:
    """Sum of the outer products of the unit vectors less their group's mean; its last number is their count."""
    own = "part string, dim int, i int, s double, n long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([f"{d}:{p}" for p, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist())])
            names, which = np.unique(keys, return_inverse=True)
            total = np.zeros((len(names), dim))
            np.add.at(total, which, _matrix(b.column(2), dim))
            dims, parts = zip(*(x.split(":", 1) for x in names.tolist())) if len(names) else ((), ())
            columns = [pa.array(np.repeat(np.array(parts, object), dim), pa.string()), pa.array(np.repeat(np.array(dims, np.int32), dim)), pa.array(np.tile(np.arange(dim, dtype=np.int32), len(names))), pa.array(total.ravel()), pa.array(np.repeat(np.bincount(which, minlength=len(names)), dim))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "dim", "i", "s", "n"])

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for b in batches:
            x = _matrix(b.column(0), dim)
            total[:-1, :-1] += x.T @ x
            total[-1, -1] += len(x)
        yield _cells(total)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for b in batches:
            for at in range(b.num_rows):
                each = b.column(0)[at].values
                s, n = each.field(1).to_numpy(zero_copy_only=False), each.field(2)[0].as_py()
                total[:-1, :-1] -= np.outer(s, s) / n
        yield _cells(total)

    groups = mapped(vectors.select("part", "dim", "unit"), sums, own).groupBy("part", "dim", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    # a group's sums, of `dim` numbers, in one row
    rows = groups.groupBy("part", "dim").agg(F.sort_array(F.collect_list(F.struct("i", "s", "n"))).alias("x")).select("x")
    found = mapped(vectors.select("unit"), outer, CELLS).union(mapped(rows, means, CELLS))
    out = np.zeros((dim + 1, dim + 1))
    for i, j, s in found.groupBy("i", "j").agg(F.sum("s")).collect():
        out[i, j] = s
    return out


CELLS = "i long, j long, s double"


def _cells(total: np.ndarray) -> pa.RecordBatch:
    n = len(total)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n), n)), pa.array(np.tile(np.arange(n), n)), pa.array(total.ravel())], names=["i", "j", "s"])


def axes(total: np.ndarray, k: int) -> np.ndarray:
    """The k leading principal directions, as columns."""
    _, found = np.linalg.eigh(total[:-1, :-1] / max(total[-1, -1], 1))
    return found[:, ::-1][:, :k]


def placed(units: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Coordinates of unit vectors: their projections, and the length of the rest."""
    at = units @ directions[: units.shape[1]]
    return np.c_[at, np.sqrt(np.maximum(0, 1 - (at * at).sum(axis=1)))]


def distinct_units(vectors: DataFrame) -> DataFrame:
    """CLASS rows: the smallest id and the copies of each distinct vector of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units, dims = [], []
            for x in b.column(2):
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                v = v / np.abs(v).max()  # squares neither overflow nor vanish
                v = v / np.sqrt(v @ v)
                units.append((v + 0.0).tobytes())  # -0.0 is 0.0
                dims.append(len(v))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(units, pa.binary()), pa.array(dims, pa.int32())], names=["id", "part", "unit", "dim"])

    return mapped(vectors.select("id", F.col("part").cast("string"), "v"), run, "id long, part string, unit binary, dim int")


def blocks_of(scratch: Scratch, classes: DataFrame, directions: np.ndarray, epsilon: float, block: int) -> DataFrame:
    """The sorted sequence, cut into blocks, each with a number in that order."""
    dim, k = directions.shape[0], directions.shape[1] + 1

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = placed(_matrix(b.column(b.schema.get_field_index("unit")), dim), directions)
            grid = np.floor(at / (epsilon / FINE)).astype(np.int32)
            own = [pa.ListArray.from_arrays(np.arange(0, len(x) * k + 1, k, dtype=np.int32), pa.array(x.ravel())) for x in (grid, at)]
            yield pa.RecordBatch.from_arrays([*b.columns, *own], names=[*b.schema.names, "cell", "at"])

    # cells in lexicographic order; the id decides between equal ones
    ordered = scratch.cut(mapped(classes, cells, CLASS + ", cell array<int>, at array<double>"), "placed").repartitionByRange("part", "dim", "cell", "id").sortWithinPartitions("part", "dim", "cell", "id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq, group = TaskContext.get().partitionId(), 0, None
        held: list[pa.RecordBatch] = []  # rows of one group, fewer than a block

        def made() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            at = np.concatenate([b.column(4).flatten().to_numpy() for b in held]).reshape(-1, k)
            row = {
                "pid": pid,
                "seq": seq,
                "part": group[0],
                "dim": group[1],
                "low": at.min(axis=0).tolist(),
                "high": at.max(axis=0).tolist(),
                "ids": rows.column(0).to_pylist(),
                "copies": rows.column(1).to_pylist(),
                "units": b"".join(rows.column(5).to_pylist()),
            }
            return pa.RecordBatch.from_pylist([row], schema=kind)

        for b in batches:
            parts, dims = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], (parts[1:] != parts[:-1]) | (dims[1:] != dims[:-1])])) if b.num_rows else []
            for a, end in zip(begins, [*begins[1:], b.num_rows]):
                if held and group != (parts[a], int(dims[a])):
                    yield made()
                    held, seq = [], seq + 1
                group = (parts[a], int(dims[a]))
                while a < end:
                    n = min(end - a, block - sum(x.num_rows for x in held))
                    held.append(b.slice(a, n))
                    a += n
                    if sum(x.num_rows for x in held) == block:
                        yield made()
                        held, seq = [], seq + 1
        if held:
            yield made()

    kind = pa.schema(
        [("pid", pa.int32()), ("seq", pa.int32()), ("part", pa.string()), ("dim", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("units", pa.binary())]
    )
    found = scratch.cut(mapped(ordered.select("id", "copies", "part", "dim", "at", "unit"), cut, BLOCKS), "blocks")
    # one row for each partition, whose blocks follow those of the ones before
    counts = found.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("pid", (F.sum("n").over(Window.orderBy("pid")) - F.col("n")).alias("before"))
    return found.join(F.broadcast(before), "pid").withColumn("block", F.col("before") + F.col("seq")).drop("pid", "seq", "before")


def _near(epsilon: float) -> Column:
    """Whether the boxes of a and b may hold linked vectors."""
    gaps = F.zip_with(
        F.zip_with("la", "hb", lambda x, y: x - y),
        F.zip_with("lb", "ha", lambda x, y: x - y),
        lambda p, q: F.greatest(p, q, F.lit(0.0)),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return (F.col("ka") <= F.col("mb")) & (F.col("kb") <= F.col("ma")) & (apart <= (epsilon + SLACK) ** 2)


def block_pairs(scratch: Scratch, boxes: DataFrame, epsilon: float) -> DataFrame:
    """(a, b) with a <= b: pairs of blocks that aren't provably distant."""
    # the group as one more interval, so that groups are distant from each other
    level = boxes.select("block", "low", "high", F.concat_ws(":", F.format_string("%010d", "dim"), "part").alias("k")).withColumn("m", F.col("k"))
    levels = [scratch.cut(level.select(F.col("block").alias("node"), "low", "high", "k", "m"), "boxes")]
    n = levels[0].agg(F.max("node")).first()[0]
    if n is None:
        return levels[0].select(F.col("node").alias("a"), F.col("node").alias("b"))
    k = DIMENSIONS + 1

    def extreme(f, c: str):
        return F.array(*[f(F.get(c, F.lit(i))) for i in range(k)])

    while n >= FANOUT:
        n //= FANOUT
        up = levels[-1].groupBy(F.floor(F.col("node") / FANOUT).alias("node")).agg(extreme(F.min, "low").alias("low"), extreme(F.max, "high").alias("high"), F.min("k").alias("k"), F.max("m").alias("m"))
        levels.append(scratch.cut(up, "boxes"))
    top = levels.pop()
    # at most FANOUT intervals at the top
    pairs = _skip(_top_pairs(top), top, epsilon)
    while levels:
        pairs = pairs.select(F.explode(_children("a")).alias("a"), "b")
        pairs = pairs.select("a", F.explode(_children("b")).alias("b")).filter("a <= b")
        pairs = scratch.cut(_skip(pairs, levels.pop(), epsilon), "pairs")
    return pairs


def _children(node: str) -> Column:
    first = F.col(node) * FANOUT
    return F.sequence(first, first + (FANOUT - 1))


def _top_pairs(top: DataFrame) -> DataFrame:
    nodes = F.sequence(F.lit(0).cast("long"), F.lit(FANOUT - 1).cast("long"))
    return top.select(F.col("node").alias("a")).select("a", F.explode(nodes).alias("b")).filter("a <= b")


def _skip(pairs: DataFrame, boxes: DataFrame, epsilon: float) -> DataFrame:
    one, two = (boxes.select(F.col("node").alias(x), F.col("low").alias(f"l{x}"), F.col("high").alias(f"h{x}"), F.col("k").alias(f"k{x}"), F.col("m").alias(f"m{x}")) for x in "ab")
    return pairs.join(one, "a").join(two, "b").filter(_near(epsilon)).select("a", "b")


LINKS = "u long, v long, n long"


def near_rows(xa: np.ndarray, xb: np.ndarray, directions: np.ndarray, cosine: float) -> tuple[np.ndarray, int]:
    """(whether each row of xa has the cosine with each of xb, pairs that were compared)."""
    pa_, pb, far = placed(xa, directions), placed(xb, directions), ((2 - 2 * cosine) ** 0.5 + SLACK) ** 2
    near, n = np.zeros((len(xa), len(xb)), bool), 0
    for i in range(0, len(xa), PART):
        own = pa_[i : i + PART]
        gap = np.maximum(np.maximum(own.min(axis=0) - pb, pb - own.max(axis=0)), 0)
        some = np.flatnonzero((gap * gap).sum(axis=1) <= far)
        if len(some):
            near[i : i + PART, some] = xa[i : i + PART] @ xb[some].T >= cosine
            n += len(own) * len(some)
    return near, n


def compare(pairs: DataFrame, blocks: DataFrame, directions: np.ndarray, cosine: float) -> DataFrame:
    """LINKS rows: (u, null, n) adds n links to u; (u, v, null) is an edge of a forest; (null, null, n) counts compared pairs."""
    own = blocks.select("block", "ids", "copies", "units", "dim")
    one = own.select(F.col("block").alias("a"), F.col("ids").alias("ia"), F.col("copies").alias("na"), F.col("units").alias("xa"), "dim")
    two = own.select(F.col("block").alias("b"), F.col("ids").alias("ib"), F.col("copies").alias("nb"), F.col("units").alias("xb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "ia", "na", "xa", "ib", "nb", "xb", "dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b, *lists = (c[i] for c in batch.columns)
                ia, na, ib, nb = (lists[j].values.to_numpy() for j in (0, 1, 3, 4))
                dim = lists[6].as_py()
                xa, xb = (np.frombuffer(lists[j].as_buffer(), np.float64).reshape(-1, dim) for j in (2, 5))
                same = a.as_py() == b.as_py()
                near, met = near_rows(xa, xb, directions, cosine)
                if same:
                    np.fill_diagonal(near, False)
                ca, cb = near @ nb, na @ near
                u, n = [ia[ca > 0]], [ca[ca > 0]]
                if not same:
                    u.append(ib[cb > 0])
                    n.append(cb[cb > 0])
                # of a block with itself, each pair is seen from either side
                u, n = np.concatenate([*u, [0]]), np.concatenate([*n, [(met + len(ia)) // 2 if same else met]])
                eu, ev = _forest(near, ia, ib)
                edge = np.arange(len(u) + len(eu)) >= len(u)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([u, eu]), mask=np.arange(len(edge)) == len(u) - 1),
                        pa.array(np.concatenate([np.zeros(len(u), np.int64), ev]), mask=~edge),
                        pa.array(np.concatenate([n, np.zeros(len(eu), np.int64)]).astype(np.int64), mask=edge),
                    ],
                    names=["u", "v", "n"],
                )

    return mapped(both, run, LINKS)


def _forest(near: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what `near` connects: each vector with the smallest id that it reaches."""
    i, j = np.nonzero(near)
    ids, at = np.unique(np.concatenate([ia[i], ib[j]]), return_inverse=True)
    p, q = at[: len(i)], at[len(i) :]
    root, before = np.arange(len(ids)), None
    while before is None or (root != before).any():
        before = root.copy()
        low = np.minimum(root[p], root[q])
        np.minimum.at(root, p, low)
        np.minimum.at(root, q, low)
        root = root[root]
    other = root != np.arange(len(ids))
    return ids[other], ids[root[other]]


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", group: str = "label", cosine: float = 0.98, block: int = BLOCK, scratch: Scratch | None = None, report: dict | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of df.

    Rows are compared only within a group that isn't null. A vector that is
    null, empty, zero or holds null or non-finite components has no links, nor
    have vectors of different lengths with each other. A row without an id has no
    links either, nor does it count as a copy: its component is null, and it is
    kept. Of equal vectors the smallest id stands for all. Repeated rows of one id
    count as copies. An empty table gives an empty result; other columns are
    not read. `cosine` must be above 0. `report` gets the pairs of different
    vectors that are possible within groups, and those that were compared.
    """
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "grid")
    epsilon = (2 - 2 * cosine) ** 0.5
    rows = scratch.cut(distinct_units(usable(df, key, vector, group)), "units")
    classes = scratch.cut(rows.groupBy("part", "dim", "unit").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).select("id", "copies", "part", "dim", "unit"), "classes")
    dim = classes.agg(F.max("dim")).first()[0] or 1
    directions = np.zeros((dim, DIMENSIONS))
    found = axes(moments(classes, dim), DIMENSIONS)
    directions[:, : found.shape[1]] = found
    blocks = scratch.cut(blocks_of(scratch, classes, directions, epsilon, block), "blocks")
    pairs = block_pairs(scratch, blocks.select("block", "low", "high", "part", "dim"), epsilon)
    links = scratch.cut(compare(pairs, blocks, directions, cosine), "links")
    if report is not None:
        report["compared"] = links.filter("u is null").agg(F.sum("n")).first()[0] or 0
        report["possible"] = classes.groupBy("part", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.expr("n * (n + 1) / 2"))).first()[0] or 0
    labels = scratch.cut(components(scratch, links.filter("v is not null").select("u", "v")), "labels")
    others = links.filter("v is null and u is not null").groupBy(F.col("u").alias("class")).agg(F.sum("n").alias("others"))
    known = (
        classes.select(F.col("id").alias("class"), "copies", "part", "dim", "unit")
        .join(others, "class", "left")
        .join(labels.select(F.col("id").alias("class"), "component"), "class", "left")
        .select("part", "dim", "unit", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class").alias("component_id"))
    )
    linked = known.filter("n_links > 0")
    own = rows.join(linked, ["part", "dim", "unit"]).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = df.select(F.col(key).cast("long").alias("id")).join(own, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op4_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return near_duplicates(vectors).withColumnRenamed("id", "vec_id")


QUERIES = {"op4_epsilon_grid": op4_epsilon_grid}
ORACLE = {
    "op4_epsilon_grid": """
WITH RECURSIVE x AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
y AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM x),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM y a JOIN y b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.v FROM r JOIN l ON l.u = r.b),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
c AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON m.a = vec_id LEFT JOIN c ON c.u = vec_id
""",
}
