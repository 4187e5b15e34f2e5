"""A Merkle manifest of a table, and versions of it in which single rows were tampered with.

Each row is a leaf; the leaves of one tree (a source) stand in the order of their ids. Runs of `ways`
consecutive nodes become one node until one is left, the subroot; the subroots become the root in the
same way. The tree is persistent: a tampered leaf makes a version that copies its ancestors only and
shares every other node.

Trees are cut into aligned blocks of `ways ** block_levels` leaves. A task holds one block: it builds the
block's nodes once and makes every version of a leaf in it by copying the path to the block's top. Blocks'
tops are the leaves of the next round, and versions go on there by the siblings of their block's top, which
are worked out once per block. So a source that holds a third of all rows is many blocks, and no group
is larger than one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, written

# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:binary,right:binary>>"
BLOCKS = (
    f"tree string, block long, position long, size long, id long, digest binary, version binary, "
    f"steps {STEPS}, copied array<binary>, top binary, version_top binary"
)


def node(digests: Sequence[bytes]) -> bytes:
    """The digest over digests, which go in as lower-case hex text."""
    return sha256(b"".join([d.hex().encode() for d in digests])).digest()


def height(size: int, ways: int) -> int:
    """Levels above `size` leaves until one node is left."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ways), levels + 1
    return levels


class BlockTree:
    """The nodes of one block, level by level. Versions are lists of copied ancestors; a node that is
    not on a version's path is this tree's own."""

    def __init__(self, leaves: Sequence[bytes], levels: int, ways: int):
        self.ways, self.levels = ways, [list(leaves)]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([node(below[k : k + ways]) for k in range(0, len(below), ways)])

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def steps(self, place: int) -> list[tuple[bytes, bytes]]:
        """The digests left and right of the path from a leaf to the top, joined, level by level."""
        out = []
        for level in self.levels[:-1]:
            start = place - place % self.ways
            run = level[start : start + self.ways]
            out.append((b"".join(run[: place - start]), b"".join(run[place - start + 1 :])))
            place //= self.ways
        return out

    def version(self, place: int, leaf: bytes) -> list[bytes]:
        """The copied ancestors, parent first, of a version in which one leaf is another."""
        copies = []
        for level in self.levels[:-1]:
            start = place - place % self.ways
            run = level[start : start + self.ways]
            run[place - start] = leaf
            leaf = node(run)
            copies.append(leaf)
            place //= self.ways
        return copies

    def node_of(self, copies: Sequence[bytes], place: int, level: int, index: int) -> bytes:
        """A node (above the leaves) of a version: a copy on its path, else the shared one."""
        on_path = place // self.ways**level == index
        return copies[level - 1] if on_path else self.levels[level][index]


def leaf(values: Sequence[Column]) -> Column:
    """SHA-256 over the fields of a row, each `-` if null, else its bytes in UTF-8, `:` and its text."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        )

    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf's digest and the digests beside its path lead to."""

    def up(digest: Column, step: Column) -> Column:
        text = F.concat(hex_text(step["left"]), hex_text(digest), hex_text(step["right"]))
        return F.unhex(F.sha2(text.cast("binary"), 256))

    return F.aggregate(steps, leaf, up)


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """`nodes` with `position` in its `tree` by `order`, and the tree's `size`.

    Rows are dealt by ranges of tree and order, so a large tree lies in many partitions. What a partition
    holds of a tree is counted, and the counts are summed up per tree: a row per partition and tree.
    """
    keys = ["tree", *order]
    dealt = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = written(dealt.withColumn("place", F.monotonically_increasing_id()), "nodes")
    part = F.shiftright("place", 33)  # the partition's number
    held = dealt.groupBy("tree", part.alias("part")).agg(
        F.min("place").alias("first"), F.count("*").alias("n")
    )
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "tree", "part", "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(of_tree).alias("size"),
    )
    placed = dealt.withColumn("part", part).join(starts, ["tree", "part"])
    position = F.col("start") + F.col("place") - F.col("first")
    return placed.withColumn("position", position).drop("part", "place", "first", "start")


def built(nodes: DataFrame, ways: int, block_levels: int) -> DataFrame:
    """One round: every node with its way to the top of its block, that top, and the top of its
    version if it has one."""
    schema = pa.schema(
        [
            ("tree", pa.string()), ("block", pa.int64()), ("position", pa.int64()), ("size", pa.int64()),
            ("id", pa.int64()), ("digest", pa.binary()), ("version", pa.binary()),
            ("steps", pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))),
            ("copied", pa.list_(pa.binary())), ("top", pa.binary()), ("version_top", pa.binary()),
        ]
    )

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("position").combine_chunks()
        size = group.column("size")[0].as_py()
        tree = BlockTree(group.column("digest").to_pylist(), min(block_levels, height(size, ways)), ways)
        steps, copied, tops = [], [], []
        for place, version in enumerate(group.column("version").to_pylist()):
            steps.append([{"left": a, "right": b} for a, b in tree.steps(place)])
            copies = None if version is None else tree.version(place, version)
            copied.append(copies)
            tops.append(None if copies is None else copies[-1] if copies else version)
        kept = [group.column(name) for name in schema.names[:7]]
        made = [steps, copied, [tree.top] * len(group), tops]
        arrays = [pa.array(x, kind) for x, kind in zip(made, schema.types[7:], strict=True)]
        return pa.Table.from_arrays([*kept, *arrays], schema=schema)

    block = F.floor(F.col("position") / F.lit(ways**block_levels)).alias("block")
    rows = nodes.select("tree", block, "position", "size", "id", "digest", "version")
    return written(rows.groupBy("tree", "block").applyInArrow(build, BLOCKS), "blocks")


def rounds(nodes: DataFrame, ways: int, block_levels: int) -> list[DataFrame]:
    """The rounds of all trees, up to that in which each tree is one block."""
    wide = ways**block_levels
    size = nodes.agg(F.max("size")).first()[0] or 0
    out = [built(nodes, ways, block_levels)]
    while size > wide:
        size = -(-size // wide)
        tops = out[-1].where(F.col("position") % wide == 0).select(
            "tree", F.col("block").alias("position"),
            F.ceil(F.col("size") / F.lit(wide)).alias("size"),
            F.lit(None).cast("long").alias("id"), F.col("top").alias("digest"),
            F.lit(None).cast("binary").alias("version"),
        )
        out.append(built(tops, ways, block_levels))
    return out


def _above(made: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The way from each block of the first round to the end of `tops`: `tree, block, above` and what
    else `tops` has. `tops` has a row per tree: `tree, block, above, ...`."""
    for blocks in reversed(made[1:]):
        further = [c for c in tops.columns if c not in ("tree", "block", "above")]
        tops = blocks.join(tops, ["tree", "block"]).select(
            "tree", F.col("position").alias("block"), F.concat("steps", "above").alias("above"), *further
        )
    return tops


def manifest(
    df: DataFrame,
    tampered: Mapping[str, Column] | None = None,
    *,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "source",
    ways: int = 3,
    block_levels: int = 7,
) -> DataFrame:
    """One row per row of `df`: `id, leaf, subroot, root, steps, copied, folded, verified`.

    `steps` are the sibling digests beside the path to the root; `folded(leaf, steps)` is the root.
    `tampered` gives other values for fields; a row whose leaf changes by it makes a version: `copied` are the
    ancestors it copies within its block, and the root of its version is in `folded`. Rows that stay as
    they are share the tree: `copied` is null and `folded` the root again, taken from the block's top.
    Digests are binary.

    A null field differs from an empty one. Rows of a null tree are a tree of their own, before all others;
    null ids come first. Rows of one id stand in the order of their leaves, and equal rows are leaves of their
    own. One row alone is its own root; an empty table gives no rows. Other columns of `df` are not read.
    A text of any length is hashed as a whole in one row's expression.
    """
    first = leaf([col(name) for name in fields])
    other = leaf([(tampered or {}).get(name, col(name)) for name in fields]) if tampered else F.lit(None)
    rows = df.select(
        # null before any name, names by their bytes
        F.when(col(tree_col).isNull(), "-").otherwise(F.concat(F.lit("="), col(tree_col).cast("string"))).alias("tree"),
        col(id_col).cast("long").alias("id"),
        first.alias("digest"),
        other.cast("binary").alias("version"),
    ).withColumn("version", F.when(F.col("version") != F.col("digest"), F.col("version")))
    leaves = rounds(numbered(rows, ["id", "digest", "version"]), ways, block_levels)

    subroots = leaves[-1].where("position = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest")
    )
    named = written(numbered(subroots, ["name"]), "subroots")
    upper = rounds(
        named.withColumn("id", F.lit(None).cast("long")).withColumn("version", F.lit(None).cast("binary")),
        ways, block_levels,
    )
    # One row: the root.
    tops = upper[-1].where("position = 0").select(
        "tree", "block", F.expr(f"CAST(array() AS {STEPS})").alias("above"), F.col("top").alias("root")
    )
    ends = upper[0].join(_above(upper, tops), ["tree", "block"]).select(
        "position", F.concat("steps", "above").alias("above"), F.col("digest").alias("subroot"), "root"
    )
    ends = named.select("position", F.col("name").alias("tree")).join(ends, "position")
    ends = ends.select("tree", F.lit(0).cast("long").alias("block"), "above", "subroot", "root")

    found = leaves[0].join(_above(leaves, ends), ["tree", "block"])
    own = F.coalesce("version_top", "top")
    found = found.select(
        "id", F.col("digest").alias("leaf"), "subroot", "root",
        F.concat("steps", "above").alias("steps"), "copied", folded(own, F.col("above")).alias("folded"),
    )
    return found.withColumn("verified", F.col("folded") == F.col("root"))
