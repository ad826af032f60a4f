"""Merkle manifest of a table: a ternary hash tree for each source, kept in blocks with a van Emde Boas layout.

Leaves are numbered within their tree and cut into aligned blocks, subtrees of a fixed height. A block is built by one task
and stored as one row: the subtree of its upper half of levels first, then the subtrees below it one after the
other, each laid out the same way, so that a path from a leaf to the top touches few places whatever the size of a page.
The place of a node follows from arithmetic alone, also in the last, ragged block, as all subtrees before the last one are full.
The tops of a tree's blocks are the leaves of the next round, until one block holds what is left. Proofs go the other way:
each block's way to the top is found in the block above it, and its leaves append theirs.

Only digests are shuffled, never texts; a tree of any size is spread over its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergelane.session import materialize

# Nodes that become one.
ARITY = 3
# Levels above the leaves that a block has at most: 3 ** 8 = 6,561 leaves, a row of some 630 kB.
HEIGHT = 8
# Characters of a digest in hex.
HEX = 64


# --- layout ----------------------------------------------------------------------------------------


def _count(leaves, level: int):
    """Nodes of a level above so many leaves."""
    return -(-leaves // ARITY**level)


def tree_size(leaves, levels: int):
    """Nodes of a subtree with so many leaves and levels (its leaves are one level)."""
    return sum(_count(leaves, y) for y in range(levels))


def address(leaves: np.ndarray, levels: int, level: int, index: np.ndarray) -> np.ndarray:
    """The places of nodes (their level above the leaves, and index in it) in the layout of such subtrees."""
    if levels == 1:
        return np.zeros_like(index)
    low = levels // 2  # levels of the subtrees below; the one above has the rest
    above = _count(leaves, low)
    if level >= low:
        return address(above, levels - low, level - low, index)
    width = ARITY ** (low - 1)
    which = index // ARITY ** (low - 1 - level)
    own = np.minimum(leaves - which * width, width)
    start = tree_size(above, levels - low) + which * tree_size(width, low)
    return start + address(own, low, level, index - which * ARITY ** (low - 1 - level))


def _places(leaves: int, levels: int, level: int) -> np.ndarray:
    """The places of all nodes of a level."""
    index = np.arange(_count(leaves, level))
    return address(np.full(len(index), leaves), levels, level, index)


def _hash(*nodes: bytes) -> bytes:
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


def build(leaves: Sequence[bytes], levels: int) -> np.ndarray:
    """The subtree over some leaves, laid out; the top is at place 0."""
    n = len(leaves)
    nodes = np.zeros(tree_size(n, levels), dtype=f"S{HEX}")
    row = np.array(leaves, dtype=f"S{HEX}")
    nodes[_places(n, levels, 0)] = row
    for level in range(1, levels):
        below = row.tolist()
        row = np.array([_hash(*below[i : i + ARITY]) for i in range(0, len(below), ARITY)], dtype=f"S{HEX}")
        nodes[_places(n, levels, level)] = row
    return nodes


def siblings(nodes: np.ndarray, leaves: int, levels: int, index: np.ndarray) -> tuple[list[list[bytes]], list[list[bytes]]]:
    """For leaves of a block, what stands before and after the path's node in its run, for each level up to the top."""
    before, after = [[] for _ in index], [[] for _ in index]
    at = index
    for level in range(levels - 1):
        width = _count(leaves, level)
        first = at // ARITY * ARITY
        runs = first[:, None] + np.arange(ARITY)
        inside = runs < width
        places = address(np.full(runs.size, leaves), levels, level, np.minimum(runs, width - 1).ravel())
        held = nodes[places].reshape(runs.shape)
        for sides, wanted in ((before, runs < at[:, None]), (after, (runs > at[:, None]) & inside)):
            for side, row, which in zip(sides, held, wanted):
                side.append(b"".join(row[which].tolist()))
        at = at // ARITY
    return before, after


def fold(leaf: bytes, before: Sequence[bytes], after: Sequence[bytes]) -> bytes:
    """The top that a leaf gives with what stands beside its path."""
    for left, right in zip(before, after):
        leaf = _hash(left, leaf, right)
    return leaf


def _levels(n: int, height: int) -> int:
    """Levels of the blocks of a tree with n leaves: as many as fit, or those that the whole tree has."""
    levels = 1
    while levels <= height and ARITY ** (levels - 1) < n:
        levels += 1
    return levels


# --- trees of any size -----------------------------------------------------------------------------


def _numbered(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """`leaves` with ``rank`` within their tree (from 0) and ``n``, the tree's leaves.

    Sorted over many tasks; the rank is a row's number in its slice and the rows of the tree in the slices before it.
    """
    slices = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    table = materialize(slices.withColumn("slice", F.spark_partition_id()), "slices")
    part = Window.partitionBy("tree")
    before = part.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = table.groupBy("tree", "slice").agg(F.count(F.lit(1)).alias("here")).select(
        F.col("tree").alias("t"), F.col("slice").alias("s"), F.coalesce(F.sum("here").over(before), F.lit(0)).alias("start"),
        F.sum("here").over(part).alias("n"),
    )
    nth = F.row_number().over(Window.partitionBy("tree", "slice").orderBy(*order))
    placed = table.withColumn("nth", nth).join(counts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("slice") == F.col("s")))
    return placed.withColumn("rank", F.col("start") + F.col("nth") - 1).drop("slice", "nth", "t", "s", "start")


BLOCK = "tree string, n long, block long, leaves int, levels int, top string, nodes binary"


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """The blocks over nodes (tree, n, rank, digest)."""
    size = ARITY**height

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("rank").to_numpy())
        leaves = [x.encode() for x in table.column("digest").take(pa.array(order)).to_pylist()]
        n = table.column("n")[0].as_py()
        levels = _levels(n, height)
        laid = build(leaves, levels)
        return pa.table({
            "tree": pa.array([table.column("tree")[0].as_py()], pa.string()), "n": [n],
            "block": [int(table.column("rank")[0].as_py()) // size], "leaves": pa.array([len(leaves)], pa.int32()),
            "levels": pa.array([levels], pa.int32()), "top": [laid[0].decode()], "nodes": [laid.tobytes()],
        })

    block = F.floor(F.col("rank") / size).alias("block")
    return nodes.select("tree", "n", "rank", "digest", block).groupBy("tree", "block").applyInArrow(run, BLOCK)


def forest(leaves: DataFrame, height: int) -> list[DataFrame]:
    """The rounds of blocks over numbered leaves (tree, n, rank, digest), from below.

    Trees that a block holds whole are done; of the others, the tops of the blocks are the leaves of the next round.
    """
    size = ARITY**height
    rounds = []
    nodes = leaves
    while True:
        rounds.append(materialize(_blocks(nodes, height), "blocks"))
        more = rounds[-1].filter(F.col("n") > size)
        if more.isEmpty():
            return rounds
        nodes = more.select(
            "tree", F.ceil(F.col("n") / size).alias("n"), F.col("block").alias("rank"), F.col("top").alias("digest")
        )


PATH = "before array<binary>, after array<binary>"


def _paths(items: DataFrame, blocks: DataFrame, height: int, out: str, finish) -> DataFrame:
    """What `finish` makes of items (tree, rank, more) and the path (before, after) of each to the tree's top.

    `blocks` carry the paths of their own tops (``before`` and ``after``), to which each item's way inside the block is
    put in front.
    """
    size = ARITY**height

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return finish(left.slice(0, 0), [], [], [[], []])
        row = right.to_pylist()[0]
        nodes = np.frombuffer(row["nodes"], dtype=f"S{HEX}")
        index = left.column("rank").to_numpy() % size
        before, after = siblings(nodes, row["leaves"], row["levels"], index)
        return finish(left, before, after, [row["before"] or [], row["after"] or []])

    # A null source is a tree as well, and grouping lets nulls meet.
    keyed = items.withColumn("block", F.floor(F.col("rank") / size))
    kept = blocks.select("tree", "block", "leaves", "levels", "nodes", "before", "after")
    return keyed.groupBy("tree", "block").cogroup(kept.groupBy("tree", "block")).applyInArrow(run, out)


def _extended(before: list, after: list, up: list) -> list[pa.Array]:
    """The ways to the top of a block, each followed by the block's own path."""
    return [pa.array([[*own, *up[i]] for own in side], pa.list_(pa.binary())) for i, side in enumerate((before, after))]


def _with_paths(rounds: list[DataFrame], tops: DataFrame | None, height: int) -> DataFrame:
    """The lowest blocks with the path of their tops; `tops` (t, before, after) are paths that go on above a tree's top."""
    size = ARITY**height
    nothing = F.array().cast("array<binary>")

    def finish(left: pa.Table, before: list, after: list, up: list) -> pa.Table:
        sides = _extended(before, after, up)
        return pa.table({"tree": left.column("tree"), "block": left.column("rank"), "before": sides[0], "after": sides[1]})

    current = None
    for blocks in reversed(rounds):
        paths = blocks.filter(F.col("n") <= size).select("tree", "block")
        if tops is None:
            paths = paths.withColumns({"before": nothing, "after": nothing})
        else:
            paths = paths.join(tops, F.col("tree").eqNullSafe(F.col("t")), "left").drop("t")
        if current is not None:
            parts = blocks.filter(F.col("n") > size).select("tree", F.col("block").alias("rank"))
            paths = paths.unionByName(_paths(parts, current, height, f"tree string, block long, {PATH}", finish))
        known = materialize(paths, "paths").withColumnsRenamed({"tree": "t", "block": "b"})
        current = blocks.join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b"))).drop("t", "b")
    return current


# --- the manifest ----------------------------------------------------------------------------------


def field_text(value: Column) -> Column:
    """A field as it is hashed: '-' for null, else its length in UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def manifest(
    docs: DataFrame, tampered: dict[str, Column] | None = None, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id", tree_col: str = "source", height: int = HEIGHT,
) -> DataFrame:
    """Per row: its id, leaf, subroot, root, proof_sha256, folded_root and verified.

    A leaf is the lowercase hex SHA-256 of its fields, each '-' if null, else byte length, ':' and value. The leaves of
    a source ascend by id (null first, repeated ids by their leaf); as long as several nodes are left, every three of them, the
    last run fewer, become the digest of their hex texts. The last is the source's subroot (a lone leaf itself); the subroots by
    source, null first and bytewise, give the root the same way. proof_sha256 is the digest of the leaf's siblings, from
    the bottom up to the root and from left to right. folded_root comes from the row with the fields in `tampered`
    replaced and the untouched siblings; verified tells whether it is the root.

    Nulls are hashed as '-' in any field; empty and very long texts are hashed whole; equal rows are leaves of their own
    next to each other, and share what they prove. Other columns go; an empty table gives an empty one. `height` is
    the number of levels that a block spans. Jobs run while it is planned.
    """
    changed = [(tampered or {}).get(f, docs[f]) for f in fields]
    leaves = materialize(docs.select(
        docs[id_col].alias("id"), docs[tree_col].cast("string").alias("tree"),
        leaf_digest([docs[f] for f in fields]).alias("digest"), leaf_digest(changed).alias("changed"),
    ), "leaves")
    ranked = materialize(_numbered(leaves, ["id", "digest"]), "ranked")
    rounds = forest(ranked.select("tree", "n", "rank", "digest"), height)
    size = ARITY**height
    subroots = rounds[0].filter(F.col("n") <= size).select("tree", "top")
    for blocks in rounds[1:]:
        subroots = subroots.unionByName(blocks.filter(F.col("n") <= size).select("tree", "top"))
    subroots = materialize(subroots, "subroots")
    # Sources are the leaves of one more tree, whose paths go on above theirs.
    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("top").alias("digest"))
    sources = materialize(_numbered(sources, ["source"]), "sources")
    above = forest(sources.select("tree", "n", "rank", "digest"), height)

    def path_only(left: pa.Table, before: list, after: list, up: list) -> pa.Table:
        sides = _extended(before, after, up)
        return pa.table({"t": left.column("source"), "subroot": left.column("digest"), "before": sides[0], "after": sides[1]})

    tops = _paths(
        sources.select("tree", "rank", "source", "digest"), _with_paths(above, None, height), height,
        f"t string, subroot string, {PATH}", path_only,
    )
    tops = materialize(tops, "tops")
    lowest = _with_paths(rounds, tops.select("t", "before", "after"), height)
    id_type = docs.schema[id_col].dataType.simpleString()

    def proofs(left: pa.Table, before: list, after: list, up: list) -> pa.Table:
        proof, root = [], []
        for leaf, lefts, rights in zip(left.column("changed").to_pylist(), before, after):
            lefts, rights = [*lefts, *up[0]], [*rights, *up[1]]
            proof.append(_hash(*[x for pair in zip(lefts, rights) for x in pair]).decode())
            root.append(fold(leaf.encode(), lefts, rights).decode())
        return left.select(["id", "tree", "digest"]).append_column("proof_sha256", pa.array(proof, pa.string())).append_column(
            "folded_root", pa.array(root, pa.string())
        )

    proved = _paths(
        ranked.select("tree", "rank", "id", "digest", "changed"), lowest, height,
        f"id {id_type}, tree string, digest string, proof_sha256 string, folded_root string", proofs,
    )
    root = above[-1].select(F.col("top").alias("root"))
    found = proved.join(tops.select("t", "subroot"), F.col("tree").eqNullSafe(F.col("t")))
    row = root.first()
    whole = F.lit(row["root"] if row else None).cast("string")
    return found.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", whole.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == whole).alias("verified"),
    )
