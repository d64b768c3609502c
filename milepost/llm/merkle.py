"""Merkle manifest of a dataset: a tree per group of rows, a tree over the groups, witnesses.

A row's leaf is the hash of its fields, each ``-`` if null, else its number of UTF-8 bytes, a
colon and the value. Of the nodes of one level every ``ARITY`` consecutive ones (the last run
has fewer, even one) become their hash, until one is left. The trees of the groups end in
subroots, and these, in the order of the groups, in the root.

Witnesses grow while leaves are appended. An ``Append`` holds the open subtrees of one block,
one run of unfinished nodes a level; when a run is complete, the witnesses of all leaves below
it receive the siblings of their node, so nothing is computed again when later leaves come.
Blocks start at multiples of ``BLOCK`` leaves, a power of the arity, so they are whole subtrees.
They are dealt over tasks, and their roots are appended in the same way, as the leaves of the
next level of blocks, until a tree has one node left. No task holds more than one block at a
time, however large a group is, and the driver learns nothing but the longest tree's length.

Rows are numbered by a range partitioning on (group, key): the place in its partition, the
partitions before it and the group's start give a row's number.

Null groups are one group, the first; a null key comes before all others. Rows with the same
key are ordered by their leaf; repeated rows have equal leaves and a place each. An empty
table gives an empty result. Only the named fields are read, so no other column can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructType

from milepost.session import staged

ARITY = 3
BLOCK = ARITY**8
_STEP = StructType().add("left", BinaryType()).add("right", BinaryType())


def leaf_of(*fields: Column) -> Column:
    """Hash of a row's fields, as bytes."""
    texts = [c.cast("string") for c in fields]
    coded = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*coded), 256))


def parent(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


class Append:
    """One block of a tree: appended leaves, open subtrees, and a witness of every leaf.

    A witness is one (digests to the left, digests to the right) a level. ``open[k]`` has the
    nodes of level k whose run is unfinished, each with the range of leaves below it.
    """

    def __init__(self):
        self.open: list[list[tuple[bytes, int, int]]] = []
        self.witness: list[list[tuple[bytes, bytes]]] = []

    def leaf(self, digest: bytes) -> None:
        n = len(self.witness)
        self.witness.append([])
        self._node(0, (digest, n, n + 1))

    def _node(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """The run of ``level`` has all its siblings: witnesses below are extended."""
        run, self.open[level] = self.open[level], []
        digests = [d for d, _, _ in run]
        for k, (_, a, b) in enumerate(run):
            step = b"".join(digests[:k]), b"".join(digests[k + 1 :])
            for w in self.witness[a:b]:
                w.append(step)
        self._node(level + 1, (parent(digests), run[0][1], run[-1][2]))

    def close(self, depth: int) -> bytes:
        """The node at ``depth``, shorter last runs being completed as they are."""
        for level in range(depth):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        return self.open[depth][0][0]


def depth_of(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    depth = 0
    while n > 1:
        n, depth = -(-n // ARITY), depth + 1
    return depth


def _blocks(block: int):
    """Sorted rows (tree, pos, n, digest, ...) to the same rows with path in and root of their block."""

    def closed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        grown = Append()
        for digest in rows.column("digest").to_pylist():
            grown.leaf(digest)
        root = grown.close(depth_of(min(rows.column("n")[0].as_py(), block)))
        steps = [step for w in grown.witness for step in w]
        ends = np.concatenate([[0], np.cumsum([len(w) for w in grown.witness])]).astype(np.int32)
        sides = [pa.array([s[k] for s in steps], pa.binary()) for k in (0, 1)]
        path = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(sides, ["left", "right"]))
        added = [path, pa.array([root] * rows.num_rows, pa.binary())]
        return pa.RecordBatch.from_arrays([*rows.columns, *added], [*rows.schema.names, "path", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, cell = batch.column("tree").to_numpy(), batch.column("pos").to_numpy() // block
            cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (cell[1:] != cell[:-1])) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                here = int(tree[a]), int(cell[a])
                if held and here != at:
                    yield closed(held)
                    held = []
                held.append(batch.slice(a, b - a))
                at = here
        if held:
            yield closed(held)

    return run


def climb(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``nodes`` (tree, pos, n, digest, ...) with ``path`` to and ``root`` of their tree; n is its length."""
    if block != ARITY ** depth_of(block):
        raise ValueError("a block has a power of the arity of leaves")
    cell = F.floor(F.col("pos") / block)
    kinds = StructType([*nodes.schema.fields]).add("path", ArrayType(_STEP)).add("root", BinaryType())
    # Tree and block deal the rows: a hot tree is spread, a block stays together.
    grown = staged(
        nodes.withColumn("cell", cell)
        .repartition("tree", "cell")
        .sortWithinPartitions("tree", "pos")
        .drop("cell")
        .mapInArrow(_blocks(block), kinds)
    )
    longest = grown.agg(F.max("n")).first()[0]
    if longest is None or longest <= block:
        return grown
    roots = grown.filter(F.col("pos") % block == 0).select(
        "tree", cell.alias("pos"), F.ceil(F.col("n") / block).alias("n"), F.col("root").alias("digest")
    )
    above = climb(roots, block).select(
        "tree", F.col("pos").alias("cell"), F.col("path").alias("rest"), F.col("root").alias("top")
    )
    joined = grown.withColumn("cell", cell).join(above, ["tree", "cell"])
    return joined.select(
        *(F.col(c) for c in nodes.columns), F.concat("path", "rest").alias("path"), F.col("top").alias("root")
    )


def numbered(rows: DataFrame, order: list[str], group: str | None = None) -> DataFrame:
    """``rows`` with ``pos``, ``n`` and ``tree``: place in the group, its length, and a number of the group.

    The order has to settle all ties but those of equal rows.
    """
    keys = [group] if group else []
    placed = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = staged(placed.withColumn("id", F.monotonically_increasing_id()))
    part = F.shiftright("id", 33)
    # One row per (group, partition): as many rows as partitions for the largest group.
    runs = placed.groupBy(*keys, part.alias("part")).agg(F.min("id").alias("least"), F.count("*").alias("rows"))
    own = Window.partitionBy(*keys)
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *(F.col(k).alias("own_group") for k in keys),
        "part",
        "least",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(own).alias("n"),
        F.min("least").over(own).alias("tree"),
    )
    meets = part == F.col("part")
    if group:
        meets = meets & F.col(group).eqNullSafe(F.col("own_group"))
    joined = placed.join(runs, meets)
    return joined.withColumn("pos", F.col("id") - F.col("least") + F.col("before")).drop("id", "part", "least", "before", "own_group")


def manifest(
    docs: DataFrame,
    fields: list[str],
    key: str = "doc_id",
    group: str = "source",
    carry: dict[str, Column] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: key, group, leaf, path, subroot, root (digests as bytes).

    ``path`` has a (left, right) pair of joined digests a level, from the leaf to the root.
    ``carry`` are further columns, computed on the input rows and kept in the result.
    """
    carry = carry or {}
    leaves = docs.select(
        F.col(key).alias("key"),
        F.col(group).alias("group"),
        leaf_of(*(F.col(c) for c in fields)).alias("digest"),
        *(c.alias(f"carry_{name}") for name, c in carry.items()),
    )
    inner = climb(numbered(leaves, ["key", "digest"], "group"), block).withColumnRenamed("root", "subroot")
    tops = inner.filter("pos = 0").select("tree", "group", F.col("subroot").alias("digest"))
    tops = numbered(tops.withColumnRenamed("tree", "group_tree"), ["group"])
    outer = climb(tops, block).select(F.col("group_tree").alias("tree"), F.col("path").alias("rest"), "root")
    return inner.join(outer, "tree").select(
        F.col("key").alias(key),
        F.col("group").alias(group),
        F.col("digest").alias("leaf"),
        F.concat("path", "rest").alias("path"),
        "subroot",
        "root",
        *(F.col(f"carry_{name}").alias(name) for name in carry),
    )


def text_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give, as bytes."""
    return F.aggregate(
        path, leaf, lambda at, step: F.unhex(F.sha2(F.concat(text_of(step["left"]), text_of(at), text_of(step["right"])), 256))
    )


def siblings(path: Column) -> Column:
    """All siblings of a path, as one text: level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(text_of(s["left"]), text_of(s["right"]))), "")
