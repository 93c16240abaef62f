"""Near-duplicate documents: MinHash signatures in an LSH forest.

1. One pass over the texts gives each document its number of shingles, a
   digest of its set and TREES x DEPTH minima. Documents with equal sets form
   one class, of which only the smallest id goes on.
2. Each tree sorts the classes by their signature of DEPTH minima. Neighbours
   in that order have the longest common prefixes; a class is a candidate with
   its WINDOW next neighbours that share LEAST minima or more. In a crowded
   region those neighbours share a longer prefix, so the depth adapts itself.
   Range partitioning sorts, so no region has to fit in one task, and the
   edges of adjacent partitions are matched in a step of their own.
3. Pairs whose signatures make the wanted similarity impossible, with an error
   of five standard deviations, or whose sizes do so for certain, go; the rest
   is confirmed on full sets, the most similar earlier class of each first, so
   that later pairs within one component need no work.
4. Regions with more classes than a window sees, of more than one component,
   are compared whole, so that no pair is lost to the window: in blocks of
   bounded size, the classes outside the region's largest component with all.
   Pairs that shingles or bit maps prove apart go: shingles that RARE classes
   of such regions or fewer have give the pairs that share one by an equi-join,
   so any other pair has at most its other shingles in common; and a bit of a
   set's map that another's lacks is a shingle that the other lacks.

A link is lost only if no tree holds its two classes in one region: at a
similarity of 0.8 that happens to 3 of 100,000 links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import LOWER, U64, Scratch, components, flat, mapped, mix, roots, shingle_hashes, slices, word_hashes, word_runs


@dataclass(frozen=True)
class Forest:
    shingle: int = 5
    percent: int = 80  # links have 100 * intersection >= percent * union
    trees: int = 20
    depth: int = 6
    least: int = 4
    window: int = 6
    block: int = 256
    rare: int = 8

    @property
    def hashes(self) -> int:
        return self.trees * self.depth


SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
U32 = np.uint32


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a strings() array."""
    data, off = flat(column)
    starts, ends, first = word_runs(~SPACE[data], off)
    words = word_hashes(LOWER[data], starts, ends)
    shingles = shingle_hashes(words, k)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            yield np.unique(shingles[a : b - k + 1])
        elif b > a:
            # the whole sequence as one shingle; its length keeps it apart
            h = np.array([b - a], U64)
            for i in range(a, b):
                h = mix(h * U64(31) + words[i : i + 1])
            yield h
        else:
            yield np.zeros(0, U64)


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n minima (uint32) of each set, none of which may be empty."""
    x = (np.concatenate(sets) >> U64(32)).astype(U32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    rng = np.random.default_rng(20)
    odd = rng.integers(0, 1 << 31, n, dtype=np.int64).astype(U32) * U32(2) + U32(1)
    flip = rng.integers(0, 1 << 32, n, dtype=np.int64).astype(U32)
    out = np.empty((len(sets), n), U32)
    y = np.empty_like(x)
    for j in range(n):
        np.bitwise_xor(x, flip[j], out=y)
        np.multiply(y, odd[j], out=y)
        np.bitwise_xor(y, y >> U32(15), out=y)
        np.multiply(y, U32(0x2C1B3C6D), out=y)
        out[:, j] = np.minimum.reduceat(y, at)
    return out


SKETCH = "id long, n_shingles long, set_a long, set_b long, signature binary, low binary"


def sketches(docs: DataFrame, key: str, text: str, f: Forest) -> DataFrame:
    """SKETCH rows; the set's digest and the signature are null for an empty set.

    `low` has the last byte of each minimum, which is enough to count equal
    ones: at most one in 256 unequal minima counts as equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, column in slices(whole):
                sets = list(shingle_sets(column, f.shingle))
                full = [i for i, s in enumerate(sets) if len(s)]
                digest = np.zeros((len(sets), 2), np.int64)
                signature, low = [None] * len(sets), [None] * len(sets)
                if full:
                    found = minima([sets[i] for i in full], f.hashes).astype(">u4")
                    for row, i in zip(found, full):
                        digest[i] = np.frombuffer(hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), np.int64)
                        signature[i], low[i] = row.tobytes(), row.astype(np.uint8).tobytes()
                empty = np.array([len(s) == 0 for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest[:, 0], mask=empty), pa.array(digest[:, 1], mask=empty), pa.array(signature, pa.binary()), pa.array(low, pa.binary())],
                    names=["id", "n_shingles", "set_a", "set_b", "signature", "low"],
                )

    return mapped(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")), run, SKETCH)


def _neighbours(keys: list[bytes], ids: np.ndarray, width: int, f: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (earlier, later) within a window that share the first `width` bytes of the key."""
    left, right = [], []
    if len(keys) > 1:
        short = np.array([k[:width] for k in keys], dtype=f"S{width}").view(np.uint8).reshape(len(keys), width)
        same = (short[1:] == short[:-1]).all(axis=1)
        run = np.concatenate([[0], np.cumsum(~same)])
        for w in range(1, min(f.window, len(keys) - 1) + 1):
            hit = np.flatnonzero(run[w:] == run[:-w])
            if not len(hit):
                break
            left.append(ids[hit])
            right.append(ids[hit + w])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


NEAR = "part int, edge int, pos int, tree_key binary, u long, v long"


def forest_pairs(scratch: Scratch, classes: DataFrame, f: Forest) -> DataFrame:
    """Distinct candidate pairs (u < v) of classes (id, signature)."""
    step = 4 * f.depth
    trees = classes.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(f.trees - 1)),
                lambda t: F.concat(F.lpad(F.hex(t), 2, "0").cast("binary"), F.lit(b"\x00"), F.substring("signature", t * step + 1, F.lit(step))),
            )
        ).alias("tree_key"),
        "id",
    )
    width = 4 * f.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tail_keys, tail_ids, head, seen = TaskContext.get().partitionId(), [], np.zeros(0, np.int64), 0, 0

        def out(edge: int, keys: list, u: np.ndarray, v: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
            n = len(u)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, edge, np.int32)), pa.array(pos.astype(np.int32)), pa.array(keys or [None] * n, pa.binary()), pa.array(u), pa.array(v)],
                names=["part", "edge", "pos", "tree_key", "u", "v"],
            )

        for batch in batches:
            new_keys = batch.column(0).to_pylist()
            new_ids = batch.column(1).to_numpy(zero_copy_only=False)
            if head < f.window:  # the first rows of the partition
                n = min(f.window - head, len(new_keys))
                yield out(0, new_keys[:n], new_ids[:n], new_ids[:n], head + np.arange(n))
                head += n
            keys, ids = tail_keys + new_keys, np.concatenate([tail_ids, new_ids])
            u, v = _neighbours(keys, ids, width + PREFIX, f)
            yield out(1, [], u, v, np.zeros(len(u)))
            tail_keys, tail_ids = keys[-f.window :], ids[-f.window :]
            seen += len(new_keys)
        yield out(2, tail_keys, tail_ids, tail_ids, np.arange(len(tail_ids)) - len(tail_ids))

    n = max(8, int(scratch.spark.conf.get("spark.sql.shuffle.partitions")))
    near = scratch.cut(mapped(trees.repartitionByRange(n, "tree_key", "id").sortWithinPartitions("tree_key", "id"), run, NEAR), "near")
    ends = near.filter("edge <> 1")
    # the last rows of a partition with the first ones of the next partition
    # that has rows; `parts` has as many rows as there are partitions
    parts = ends.select("part").distinct()
    follow = parts.withColumn("next", F.lead("part").over(Window.orderBy("part")))
    tail = ends.filter("edge = 2").join(F.broadcast(follow), "part").select(F.col("next").alias("at"), "pos", "tree_key", "u")
    head = ends.filter("edge = 0").select(F.col("part").alias("at"), "pos", "tree_key", F.col("u").alias("v"))
    crossed = (
        tail.alias("a")
        .join(head.alias("b"), "at")
        .filter((F.col("b.pos") - F.col("a.pos") <= f.window) & (F.substring("a.tree_key", 1, width + PREFIX) == F.substring("b.tree_key", 1, width + PREFIX)))
        .select("u", "v")
    )
    pairs = near.filter("edge = 1").select("u", "v").union(crossed)
    return pairs.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


#: Bytes of a tree's key before the signature: the tree's number and a zero.
PREFIX = 3


def least_agreeing(f: Forest) -> int:
    """Equal minima that a pair at the threshold has but for five standard deviations."""
    p = f.percent / 100
    return int(f.hashes * p - 5 * (f.hashes * p * (1 - p)) ** 0.5)


def likely(pairs: DataFrame, classes: DataFrame, f: Forest) -> DataFrame:
    """(u, v, equal): pairs that may be linked, by size and by equal minima."""
    own = classes.select("id", "n_shingles", "low")
    both = pairs.join(own.select(F.col("id").alias("u"), F.col("n_shingles").alias("nu"), F.col("low").alias("su")), "u").join(
        own.select(F.col("id").alias("v"), F.col("n_shingles").alias("nv"), F.col("low").alias("sv")), "v"
    )
    both = both.filter(f"100 * least(nu, nv) >= {f.percent} * greatest(nu, nv)").select("u", "v", "su", "sv")
    least, n = least_agreeing(f), f.hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                su, sv = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, n) for i in (2, 3))
                equal = (su == sv).sum(axis=1)
                keep = pa.array(equal >= least)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(equal.astype(np.int32))], names=["u", "v", "equal"]).filter(keep)

    return mapped(both, run, "u long, v long, equal int")


BITS = 2048


def bit_map(shingles: np.ndarray) -> bytes:
    """A bit for each shingle, by its hash: a bit of one set that another lacks proves a shingle that the other lacks."""
    out = np.zeros(BITS, np.uint8)
    out[(shingles >> U64(40)).astype(np.int64) % BITS] = 1
    return np.packbits(out).tobytes()


def full_sets(docs: DataFrame, key: str, text: str, ids: DataFrame, f: Forest) -> DataFrame:
    """(id, shingles, bits) of the documents in ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, column in slices(whole):
                sets = list(shingle_sets(column, f.shingle))
                off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(off, pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array([bit_map(s) for s in sets], pa.binary())], names=["id", "shingles", "bits"])

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(ids.select("id").distinct().hint("merge"), "id", "left_semi")
    return mapped(own, run, "id long, shingles array<long>, bits binary")


def confirmed(pairs: DataFrame, sets: DataFrame, f: Forest) -> DataFrame:
    """(u, v, linked) for pairs (u, v), on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = x.values.to_numpy(), y.values.to_numpy()
                same = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * same >= f.percent * (len(p) + len(q) - same))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["u", "v", "linked"])

    both = pairs.select("u", "v").join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("x")), "u")
    both = both.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("y")), "v").select("u", "v", "x", "y")
    return mapped(both, run, "u long, v long, linked boolean")


def crowds(scratch: Scratch, classes: DataFrame, f: Forest) -> DataFrame:
    """(tree, prefix, id): the members of regions that a window doesn't see whole.

    The regions are written first, so that the join with their members is one
    of two plain shuffles, in which Spark splits a region of very many.
    """
    step, width = 4 * f.depth, 4 * f.least
    members = classes.select("id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(f.trees - 1)), lambda t: F.substring("signature", t * step + 1, F.lit(width)))).alias("tree", "prefix"))
    large = members.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > f.window + 1).select("tree", "prefix")
    return members.join(scratch.cut(large, "regions"), ["tree", "prefix"])


def rare_shingles(crowd_ids: DataFrame, full: DataFrame, f: Forest) -> DataFrame:
    """(s, id): the shingles that few classes of the crowds have, with those classes."""
    each = full.join(crowd_ids, "id", "left_semi").select("id", F.explode("shingles").alias("s"))
    few = each.groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= f.rare)
    return each.join(few, "s", "left_semi")


def rare_pairs(rare: DataFrame, facts: DataFrame, f: Forest) -> DataFrame:
    """(u, v) of different components that share rare shingles, and may be linked for all that they don't share."""
    named = rare.join(facts.select("id", "component", "n_shingles", "lone"), "id")
    a, b = (named.select("s", F.col("id").alias(x), F.col("component").alias(f"c{x}"), F.col("n_shingles").alias(f"n{x}"), (F.col("n_shingles") - F.col("lone")).alias(f"m{x}")) for x in "uv")
    size = f"100 * least(nu, nv) >= {f.percent} * greatest(nu, nv)"
    both = a.join(b, "s").filter(f"u < v and cu <> cv and {size}").groupBy("u", "v", "nu", "nv", "mu", "mv").agg(F.count(F.lit(1)).alias("r"))
    # no more can be common than the shared rare shingles and what else either has
    most = F.least("mu", "mv") + F.col("r")
    return both.filter(100 * most >= f.percent * (F.col("nu") + F.col("nv") - most)).select("u", "v")


def crowd_facts(rare: DataFrame, classes: DataFrame, full: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, component, n_shingles, lone, low, bits): lone counts a class's rare shingles."""
    lone = rare.groupBy("id").agg(F.count(F.lit(1)).alias("lone"))
    facts = classes.select("id", "n_shingles", "low").join(full.select("id", "bits"), "id").join(lone, "id", "left").join(labels, "id", "left")
    return facts.select("id", F.coalesce("component", "id").alias("component"), "n_shingles", F.coalesce("lone", F.lit(0)).alias("lone"), "low", "bits").dropDuplicates(["id"])


def crowded_pairs(scratch: Scratch, crowd: DataFrame, facts: DataFrame, f: Forest) -> DataFrame:
    """(u, v): likely pairs of different components within the regions of `crowd` that share no rare shingle."""
    # with so many rare shingles, a class can't have a link here that shares none
    able = facts.filter(f"100 * (n_shingles - lone) >= {f.percent} * n_shingles")
    inside = scratch.cut(crowd.join(able.select("id", "component"), "id"), "inside")
    largest = inside.groupBy("tree", "prefix", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("tree", "prefix")
    regions = largest.agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"))
    regions = regions.filter("parts > 1").select("tree", "prefix", "main", F.ceil(F.col("n") / f.block).cast("int").alias("blocks"))
    regions = scratch.cut(regions, "regions")
    members = inside.select("tree", "prefix", "id").join(regions, ["tree", "prefix"]).join(able, "id")
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    row = F.sort_array(F.collect_list(F.struct("id", "component", "n_shingles", "lone", "low", "bits")))
    where = ["tree", "prefix", "block", "blocks"]
    odd = members.filter("component <> main").groupBy(*where).agg(row.alias("a")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = members.groupBy(*where).agg(row.alias("b")).select("tree", "prefix", F.col("block").alias("other"), "b")
    pairs = odd.join(every, ["tree", "prefix", "other"]).select("a", "b")
    least, n = least_agreeing(f), f.hashes

    def side(rows: pa.Array) -> tuple[np.ndarray, ...]:
        own, c, size, lone = (rows.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        low, bits = (b"".join(rows.field(i).to_pylist()) for i in (4, 5))
        return own, c, size, size - lone, np.frombuffer(low, np.uint8).reshape(-1, n), np.frombuffer(bits, U64).reshape(-1, BITS // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ia, ca, na, ma, sa, xa = side(batch.column(0)[at].values)
                ib, cb, nb, mb, sb, xb = side(batch.column(1)[at].values)
                # a pair that shares a rare shingle is found by that
                most = np.minimum(ma[:, None], mb[None])
                i, j = np.nonzero((100 * most >= f.percent * (na[:, None] + nb[None] - most)) & (ca[:, None] != cb[None]))
                kept = []
                for k in range(0, len(i), 8192):
                    p, q = i[k : k + 8192], j[k : k + 8192]
                    x, y = xa[p], xb[q]
                    most = np.minimum(na[p] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), nb[q] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
                    ok = 100 * most >= f.percent * (na[p] + nb[q] - most)
                    ok[ok] = (sa[p[ok]] == sb[q[ok]]).sum(axis=1) >= least
                    kept.append(ok)
                keep = np.concatenate(kept) if kept else np.zeros(0, bool)
                i, j = i[keep], j[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ia[i], ib[j])), pa.array(np.maximum(ia[i], ib[j]))], names=["u", "v"])

    return mapped(pairs, run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", f: Forest = Forest(), scratch: Scratch | None = None) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of docs.

    Words are runs of other characters than space and \\x09-\\x0D, with A-Z in
    lower case; a text with fewer words than a shingle is one shingle, and one
    without words, or a null one, has an empty set and is linked with nothing.
    Ids must be integers; rows of one id are taken as one document, whose
    text is the one with the smallest SHA-256; a null id is kept and linked with
    nothing. Ties of ids can't be, so the smallest id of a group is one document. Long texts are taken whole. An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "minhash")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    docs, key, text = one_text_an_id(rows), "id", "text"
    own = sketches(docs, key, text, f).withColumn("set_a", F.when(F.col("id").isNotNull(), F.col("set_a")))
    own = scratch.cut(own, "sketches")
    # written, so that the join below has a side that can be split where a set is very common
    sets = scratch.cut(own.filter("set_a is not null").groupBy("set_a", "set_b").agg(F.min("id").alias("class")), "classes")
    member = scratch.cut(own.select("id", "n_shingles", "set_a", "set_b").join(sets, ["set_a", "set_b"], "left").select("id", "n_shingles", "class"), "members")
    reps = sets.select(F.col("class").alias("id")).distinct()
    classes = own.filter("set_a is not null").join(reps, "id", "left_semi").select("id", "n_shingles", "signature", "low")
    classes = scratch.cut(classes, "classes")
    scratch.drop(own, sets)
    crowd = scratch.cut(crowds(scratch, classes, f), "crowd")
    crowd_ids = scratch.cut(crowd.select("id").distinct(), "crowd")
    todo = scratch.cut(likely(forest_pairs(scratch, classes, f), classes, f), "likely")
    ends = todo.select(F.col("u").alias("id")).union(todo.select("v")).union(crowd_ids)
    full = scratch.cut(full_sets(docs, key, text, ends, f), "sets")
    # the most similar earlier class of each class: enough to join most groups
    best = todo.groupBy("v").agg(F.max(F.struct("equal", (-F.col("u")).alias("u"))).alias("m")).select((-F.col("m.u")).alias("u"), "v")
    tested = scratch.cut(confirmed(best, full, f), "tested")
    labels = roots(scratch, tested.filter("linked").select(F.col("v").alias("id"), F.col("u").alias("above")))
    rest = _across(todo.join(tested, ["u", "v"], "left_anti"), labels)
    more = scratch.cut(confirmed(rest, full, f), "tested")
    labels = _joined(scratch, labels, more)
    tested = tested.union(more)
    rare = scratch.cut(rare_shingles(crowd_ids, full, f), "rare")
    facts = scratch.cut(crowd_facts(rare, classes.join(crowd_ids, "id", "left_semi"), full, labels), "facts")
    late = crowded_pairs(scratch, crowd, facts, f).union(likely(rare_pairs(rare, facts, f), classes, f).select("u", "v"))
    late = scratch.cut(late.distinct().join(tested, ["u", "v"], "left_anti"), "late")
    late = scratch.cut(confirmed(late, full, f), "tested")
    labels = _joined(scratch, labels, late)
    scratch.drop(classes, full, todo, crowd)
    found = member.join(labels.select(F.col("id").alias("class"), "component"), "class", "left")
    component = F.coalesce("component", "class", "id")
    found = found.select("id", "n_shingles", component.alias("component_id"), (F.col("id").eqNullSafe(component)).alias("kept"))
    if docs is rows:
        return found
    return rows.select("id").join(found, "id").unionByName(found.filter("id is null"))


def one_text_an_id(rows: DataFrame) -> DataFrame:
    """rows (id, text), where each id has one row: of several, that with the smallest SHA-256 of its text.

    Ids alone are counted first, so that no text moves where all differ. Rows without an id stay.
    """
    known = rows.filter("id is not null")
    if known.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return rows
    order = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256), F.col("text").isNull())
    return known.groupBy("id").agg(F.min_by("text", order).alias("text")).union(rows.filter("id is null"))


def _joined(scratch: Scratch, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """The components with more links: only the components that these join are labelled anew."""
    links = tested.filter("linked").select("u", "v")
    if links.isEmpty():
        return labels
    upper = scratch.cut(components(scratch, _named(links, labels).select(F.col("cu").alias("u"), F.col("cv").alias("v"))), "upper")
    # an end without a label so far is a component of its own
    every = labels.union(upper.select("id", F.col("id").alias("component"))).distinct()
    named = every.join(upper.select(F.col("id").alias("component"), F.col("component").alias("above")), "component", "left")
    return scratch.cut(named.select("id", F.coalesce("above", "component").alias("component")), "labels")


def _named(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """pairs (u, v) with the components cu and cv of their ends."""
    a, b = (labels.select(F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in "uv")
    both = pairs.join(a, "u", "left").join(b, "v", "left")
    return both.select("u", "v", F.coalesce("cu", "u").alias("cu"), F.coalesce("cv", "v").alias("cv"))


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet of one component."""
    return _named(pairs, labels).filter("cu <> cv").select("u", "v")


def op6_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, f=Forest(shingle=2)).withColumnRenamed("id", "doc_id")


QUERIES = {"op6_minhash_forest": op6_minhash_forest}
ORACLE = {
    "op6_minhash_forest": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 2 THEN list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) ELSE ws END AS ss FROM w),
n AS (SELECT doc_id, len(ss)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(ss) AS sh FROM s),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM i JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.v FROM r JOIN e ON e.u = r.b),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m ON m.a = n.doc_id
""",
}
