"""Merkle manifest of a table: a root for each group, one for all, and a proof for each row.

A row's leaf is the digest of its columns. Leaves of a group are numbered in
order; every `width` consecutive nodes make a parent, until one node is left, the
group's subroot. The subroots, ordered by group, make the root in the same way.

A level is one window, partitioned by group and parent index: its ordered
collect_list over the full frame is the parent's preimage and holds each node's
siblings. The first row of each run stays as the parent, so the next level has
one row a parent. Blocks of width^STRIDE nodes are partitioned by group and block,
which is enough for the windows of STRIDE levels, so these share one shuffle; a
block keeps the paths of its nodes, so paths are completed from the top by joining
blocks, not nodes. A group of any size is spread over its blocks.

Numbers come from a range partitioning and the counts by partition, never from
a window over a group. The driver gets one number a pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import Scratch

#: Levels that share a shuffle: blocks of 64 nodes for a width of 2.
STRIDE = 6
STEP = "struct<before: string, after: string>"


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def preimage(columns: list[Column]) -> Column:
    """Each value as its length in bytes, a colon and its text; `-` for null. No two rows share one."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def leaf(columns: list[Column]) -> Column:
    return digest(preimage(columns))


def numbered(scratch: Scratch, df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """df with `i`, the place in its group from 0 in ascending order, nulls first, and `n`, the group's size.

    Rows are range partitioned by group and order, so a large group has many
    partitions; what comes before a partition is summed from counts.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = scratch.cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(F.col(group).alias("_g"), part.alias("_p")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_g")
    before = F.sum("_n").over(w.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    # a row for each partition and each group
    starts = scratch.cut(counts.select("_g", "_p", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("n")), "starts")
    out = placed.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (part == F.col("_p")))
    return out.withColumn("i", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_g", "_p")


#: The members of a run's nodes, whose paths are longer by what stands beside their node.
GROWN = """
flatten(transform(run, (node, k) -> transform(node.members, m -> struct(m.row AS row, array_append(m.path,
  struct(array_join(slice(run.h, 1, k), '') AS before, array_join(slice(run.h, k + 2, size(run)), '') AS after)) AS path))))"""


def climb(nodes: DataFrame, width: int, stride: int) -> DataFrame:
    """(g, i, h, n, members) of the nodes `stride` levels above nodes (g, i, h, n, row).

    n is the number of nodes that the group has on a level; a single one stays as it is.
    members has each node's row and its path so far, from below.
    """
    size = width**stride
    x = nodes.select("g", "n", "h", "i", F.expr(f"i div {size}").alias("block"), F.array(F.struct("row", F.array().cast(f"array<{STEP}>").alias("path"))).alias("members"))
    x = x.repartition("g", "block")
    for _ in range(stride):
        run = Window.partitionBy("g", "block", F.expr(f"i div {width}")).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        x = x.withColumn("run", F.collect_list(F.struct("h", "members")).over(run)).filter(F.col("i") % width == 0)
        single = F.col("n") <= 1
        x = x.select(
            "g",
            "block",
            F.expr(f"i div {width}").alias("i"),
            F.when(single, F.col("h")).otherwise(digest(F.array_join(F.col("run")["h"], ""))).alias("h"),
            F.when(single, F.col("members")).otherwise(F.expr(GROWN)).alias("members"),
            F.expr(f"(n + {width - 1}) div {width}").alias("n"),
        )
    return x.select("g", F.col("block").alias("i"), "h", "n", "members")


def tree(scratch: Scratch, nodes: DataFrame, width: int, stride: int) -> tuple[DataFrame, list[DataFrame]]:
    """((g, h) of each group's last node, the tables of blocks from below) over nodes (g, i, h, n, row)."""
    passes: list[DataFrame] = []
    # one pass at least, so that each row is in a block
    while not passes or (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        passes.append(scratch.cut(climb(nodes, width, stride), "blocks"))
        nodes = passes[-1].select("g", "i", "h", "n", F.struct("i").alias("row"))
    return nodes.select("g", "h"), passes


def descend(tops: DataFrame, passes: list[DataFrame], carried: list[str]) -> DataFrame:
    """(row, path, *carried) of the nodes below; tops has (g, path, *carried)."""
    up = tops.select("g", F.lit(0).cast("long").alias("i"), "path", *carried)
    for k, blocks in reversed(list(enumerate(passes))):
        own = up.select(F.col("g").alias("_g"), F.col("i").alias("_i"), F.col("path").alias("above"), *carried)
        both = blocks.select("g", "i", "members").join(own, F.col("g").eqNullSafe(F.col("_g")) & (F.col("i") == F.col("_i")))
        each = both.select("g", "above", *carried, F.explode("members").alias("m"))
        path = F.concat("m.path", "above").alias("path")
        up = each.select("g", F.col("m.row.i").alias("i"), path, *carried) if k else each.select(F.col("m.row").alias("row"), path, *carried)
    return up


def manifest(df: DataFrame, by: str, order: list[str], columns: list[str], keep: list[Column] | None = None, width: int = 2, stride: int = STRIDE, scratch: Scratch | None = None) -> DataFrame:
    """(row, leaf, subroot, root, path) for each row of df.

    `row` is a struct of the order columns and the expressions of `keep`, which
    are evaluated on df. `path` has for each level from below the digests before
    and after the own one within its run, joined; levels without siblings have
    two empty strings, a group of one row no level of its own.

    Rows with a null group are a group, which comes first; an empty string is
    another. Within a group null order values come first, then values ascend;
    rows that tie follow one another by leaf, and rows alike in both by place,
    which doesn't show. Nulls in columns are told from any text. Texts are hashed
    whole and don't leave the scan. An empty table gives no rows. Columns that
    aren't named are not read, whatever their names.
    """
    scratch = scratch or Scratch(df.sparkSession, "merkle")
    quoted = {c: F.col(f"`{c}`") for c in {by, *order, *columns}}
    row = F.struct(*[quoted[c].alias(c) for c in order], *(keep or []))
    sort = [f"o{k}" for k in range(len(order))]
    rows = df.select(quoted[by].alias("g"), *[quoted[c].alias(s) for c, s in zip(order, sort)], leaf([quoted[c] for c in columns]).alias("h"), row.alias("row"))
    # a row's number splits a run of equal keys over partitions
    rows = scratch.cut(rows.withColumn("at", F.monotonically_increasing_id()), "leaves")
    leaves = numbered(scratch, rows, "g", [*sort, "h", "at"])
    nodes = leaves.select("g", "i", "h", "n", F.struct(F.col("row").alias("own"), F.col("h").alias("leaf")).alias("row"))
    subroots, passes = tree(scratch, nodes, width, stride)
    above = numbered(scratch, scratch.cut(subroots.select(F.lit(0).alias("all"), "g", "h"), "subroots"), "all", ["g"])
    roots, uppers = tree(scratch, above.select(F.col("all").alias("g"), "i", "h", "n", F.struct("g", F.col("h").alias("subroot")).alias("row")), width, stride)
    tops = descend(roots.select("g", F.array().cast(f"array<{STEP}>").alias("path"), F.col("h").alias("root")), uppers, ["root"])
    tops = scratch.cut(tops.select("row.g", "path", "row.subroot", "root"), "tops")
    out = descend(tops, passes, ["subroot", "root"])
    return out.select(F.col("row.own").alias("row"), "row.leaf", "subroot", "root", "path")


def folded(own: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, own, lambda h, s: digest(F.concat(s["before"], h, s["after"])))


def proof(path: Column) -> Column:
    """All siblings from below, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: proofs of all documents, some tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    more = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest(docs, "lang", ["doc_id"], COLUMNS, keep=[F.when(chosen, leaf(more)).alias("tampered")])
    out = found.select("row.doc_id", "leaf", "subroot", "root", digest(proof(F.col("path"))).alias("proof_sha256"), folded(F.coalesce("row.tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(levels: int = 40) -> str:
    """The same by recursion over levels; nodes are looked up by number, and crc32 is computed bit by bit."""

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR END"

    def row(n_chars: str) -> str:
        return "sha256(" + " || ".join(field(n_chars if c == "n_chars" else c) for c in COLUMNS) + ")"

    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: z::BIGINT)), lambda c, z: {bit})"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda a, b: {byte}), 4294967295)"

    def path(name: str, own: str, of: str, nodes: str, key: str) -> str:
        # one entry a level that has more than one node: where the sibling is, and its digest
        return f"""
{name} AS (SELECT o.{own}, list(CASE WHEN s.h IS NULL THEN 'N' WHEN (o.i >> k) % 2 = 0 THEN 'R' || s.h ELSE 'L' || s.h END ORDER BY k) FILTER (k < o.height) AS p
  FROM {of} o CROSS JOIN range({levels}) r(k)
  LEFT JOIN {nodes} s ON s.g IS NOT DISTINCT FROM {key} AND s.l = k AND s.i = xor(o.i >> k, 1) GROUP BY ALL)"""

    grow = "SELECT g, l + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), max((n + 1) // 2) FROM {0} WHERE n > 1 GROUP BY g, l, i // 2"
    fold = "CASE WHEN b[1] = 'R' THEN sha256(a || b[2:]) WHEN b[1] = 'L' THEN sha256(b[2:] || a) ELSE sha256(a) END"
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, doc_id, lang AS g, {row('n_chars')} AS leaf, CASE WHEN {crc} % 7 = 0 THEN {row('n_chars + 1')} END AS changed FROM documents),
base AS (SELECT id, doc_id, g, leaf, coalesce(changed, leaf) AS own, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
t AS (SELECT g, 0 AS l, i, leaf AS h, n FROM base UNION ALL {grow.format('t')}),
tops AS (SELECT g, l AS height, h FROM t WHERE n = 1),
ranked AS (SELECT g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tops),
u AS (SELECT 0 AS g, 0 AS l, i, h, n FROM ranked UNION ALL {grow.format('u')}),
root AS (SELECT l AS height, h FROM u WHERE n = 1),
b AS (SELECT base.*, height, h AS subroot FROM base JOIN tops ON base.g IS NOT DISTINCT FROM tops.g),
r AS (SELECT ranked.*, height FROM ranked, root),
{path('low', 'id', 'b', 't', 'o.g')},
{path('high', 'lang', 'r', 'u', '0')},
w AS (SELECT b.*, root.h AS root, list_concat(coalesce(low.p, []), coalesce(high.p, [])) AS p
  FROM b JOIN low ON low.id = b.id JOIN high ON high.lang IS NOT DISTINCT FROM b.g, root),
x AS (SELECT *, list_reduce(list_prepend(own, p), lambda a, b: {fold}) AS folded_root FROM w)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM x
"""


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLE = {"op11_merkle_manifest": _sql()}
