"""Merkle dataset manifest: a digest of a table, and for every row the witness that proves it belongs there.

Rows are leaves of one tree per group; the roots of the groups are leaves of a tree on top. Two
consecutive nodes become their digest; a last node without a neighbour becomes the digest of itself.

Leaves are numbered in order and dealt out in aligned blocks. A task appends the leaves of a block to a
stack of open subtrees. A new leaf starts with an empty witness; whenever two subtrees of a size complete
each other, each one's digest is added to the witnesses below the other. The root of a block is one leaf
of the next level, where the same append goes on, so no task sees more than a block at any level, and the
witness of a block's root extends the witnesses of all leaves below it.

A witness is an array with a step for each level: '<' and the digest of a neighbour before, '>' and that of
a neighbour after, or an empty step where there is none.

Defined cases: null fields have a mark of their own, so null and empty differ; a null group comes before all
others, the order in a group is by the order column (null first), then by leaf; repeated rows are leaves of
their own; a lone leaf is its group's root, a lone group's root the root; an empty table has no rows; other
columns are ignored unless carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import keep, partitions_for, store
from loomdex.session import BROADCAST_ROWS

#: A block holds 2 to this power nodes.
BLOCK_BITS = 10
#: Leaves that one task sorts, folds or joins.
ROWS_IN_TASK = 200_000
#: Groups whose place in the upper tree is broadcast; more are joined.
BROADCAST_GROUPS = 10_000


def leaf_of(*values: Column) -> Column:
    """Digest of fields, each '-' if null and otherwise its length in bytes, a colon and the value."""
    fields = [
        F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")))
        for v in values
    ]
    return F.sha2(F.concat(*fields), 256)


def digest(nodes: str) -> str:
    return hashlib.sha256(nodes.encode()).hexdigest()


class OpenSubtrees:
    """Complete subtrees that wait for their neighbour, largest first: (level, digest, witnesses of the leaves below)."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, list[list[str]]]] = []

    def append(self, leaf: str) -> list[str]:
        """The leaf's witness, which later appends extend."""
        witness: list[str] = []
        self._add(0, leaf, [witness])
        return witness

    def _add(self, level: int, node: str, below: list[list[str]]) -> None:
        while self.open and self.open[-1][0] == level:
            _, before, older = self.open.pop()
            for witness in older:
                witness.append(f">{node}")
            for witness in below:
                witness.append(f"<{before}")
            level, node, below = level + 1, digest(before + node), older + below
        self.open.append((level, node, below))

    def close(self, height: int) -> str:
        """The root at that height, once the last leaf has come."""
        while len(self.open) > 1 or self.open[0][0] < height:
            level, node, below = self.open.pop()
            for witness in below:
                witness.append("")
            self._add(level + 1, digest(node), below)
        return self.open[0][1]


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds a row's place `pos` in its group `grp`, and the group's size `n`. Sorts by range, counts by task."""
    spark = rows.sparkSession
    rows = keep(rows)  # the range partitioner reads them once more
    parts = partitions_for(spark, rows.count(), ROWS_IN_TASK)
    at = rows.repartitionByRange(parts, "grp", *order).sortWithinPartitions("grp", *order)
    at = keep(at.withColumn("at", F.monotonically_increasing_id())).withColumn("task", F.shiftright("at", 33))
    runs = at.groupBy("task", "grp").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    group = Window.partitionBy("grp")
    runs = keep(runs.select(
        "task", "grp", (F.sum("size").over(group.orderBy("task")) - F.col("size") - F.col("first")).alias("shift"),
        F.sum("size").over(group).alias("n"),
    ))  # a row for each task, and for each group
    runs = F.broadcast(runs) if runs.count() <= BROADCAST_ROWS else runs
    return at.join(runs, ["task", "grp"]).withColumn("pos", F.col("at") + F.col("shift")).drop("task", "at", "shift")


def _fold(nodes: DataFrame, bits: int) -> DataFrame:
    """The nodes with the witness of their block, and the roots of the blocks, numbered, as further rows."""
    fields = nodes.drop("grp", "pos", "n", "node").columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, tree = None, 0, OpenSubtrees()
        held: list[pa.RecordBatch] = []
        witnesses: list[list[str]] = []

        def done() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            height = (size - 1).bit_length() if size <= 1 << bits else bits
            root = tree.close(height)
            above = {"grp": block[0], "pos": block[1], "n": -(-size >> bits) if size > 1 << bits else 1, "node": root}
            columns = [pa.concat_arrays([*rows.column(f.name).chunks, pa.array([above.get(f.name)], f.type)]) for f in rows.schema]
            columns.append(pa.array([False] * len(witnesses) + [True]))
            columns.append(pa.array([*witnesses, None], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "is_root", "steps"])

        for batch in batches:
            since = 0
            values = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("grp", "pos", "n", "node")))
            for i, (grp, pos, n, node) in enumerate(values):
                if (grp, pos >> bits) != block:
                    if block is not None:
                        if i > since:
                            held.append(batch.slice(since, i - since))
                        yield from done()
                    block, size, tree, held, witnesses, since = (grp, pos >> bits), n, OpenSubtrees(), [], [], i
                witnesses.append(tree.append(node))
            if batch.num_rows > since:
                held.append(batch.slice(since))
        if block is not None:
            yield from done()

    block = F.shiftright("pos", bits)
    parts = partitions_for(nodes.sparkSession, nodes.count(), ROWS_IN_TASK)
    dealt = nodes.repartition(parts, "grp", block).sortWithinPartitions("grp", "pos")
    dealt = dealt.select("grp", "pos", "n", "node", *fields)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.mapInArrow(run, f"{types}, is_root boolean, steps array<string>")


def _grow(nodes: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Trees over numbered nodes: the nodes with whole witnesses up to their group's root, and (grp, node) of those roots."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while largest > 1:
        folded = store(_fold(nodes, bits), "witnesses")
        levels.append(folded.filter("not is_root").drop("is_root"))
        nodes = folded.filter("is_root").select("grp", "pos", "n", "node")
        largest = -(-largest >> bits) if largest > 1 << bits else 1
    if not levels:
        return nodes.withColumn("steps", F.array().cast("array<string>")), nodes.select("grp", "node")
    above = None
    for level in reversed(levels[1:]):
        found = level.select("grp", "pos", "steps")
        above = found if above is None else _extended(found, above, bits)
    rows = levels[0] if above is None else _extended(levels[0], above, bits)
    return rows, nodes.select("grp", "node")


def _extended(nodes: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """Witnesses of nodes, continued by the witness of the node that their block has become."""
    above = above.select("grp", F.col("pos").alias("block"), F.col("steps").alias("more"))
    joined = nodes.withColumn("block", F.shiftright("pos", bits)).join(above, ["grp", "block"])
    return joined.withColumn("steps", F.concat("steps", "more")).drop("block", "more")


def manifest(
    leaves: DataFrame, group: str, order: str, carried: Sequence[str] = (), leaf: str = "leaf", bits: int = BLOCK_BITS
) -> DataFrame:
    """(carried columns, leaf, subroot, root, witness) for every row of `leaves`, which has the leaf digests."""
    grp = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    rows = leaves.select(
        grp.alias("grp"), F.col(order).alias("sort_key"), F.col(leaf).alias("node"), *(F.col(c).alias(f"carried_{i}") for i, c in enumerate(carried))
    )
    grown, subroots = _grow(numbered(rows, ["sort_key", "node"]), bits)
    tops = keep(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "node"))
    placed, root = _grow(numbered(tops, ["of"]), bits)
    last = root.first()  # the root is one row
    top = keep(placed.select(
        F.col("of").alias("grp"), F.col("node").alias("subroot"), F.lit(last and last["node"]).alias("root"), F.col("steps").alias("top_steps")
    ))
    if top.count() <= BROADCAST_GROUPS:
        top = F.broadcast(top)
    return grown.join(top, "grp").select(
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carried)), F.col("node").alias("leaf"), "subroot", "root",
        F.concat("steps", "top_steps").alias("witness"),
    )


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and a witness lead to."""

    def up(node: Column, step: Column) -> Column:
        other = F.substr(step, F.lit(2))
        return F.sha2(F.when(step.startswith("<"), F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(witness, leaf, up)


def siblings_digest(witness: Column) -> Column:
    """One digest of all neighbours on the way to the root."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.substr(s, F.lit(2))), ""), 256)
