"""Merkle manifest of a table: a digest tree per group, its nodes stored in van Emde Boas order, and a proof for every row.

H is lower-case hex sha256 over concatenated texts, digests as hex. A row's leaf is H of its columns, each as ``-`` if NULL, else UTF-8 byte
count, ``:`` and value. In a group, leaves ascend by id; while several nodes remain, each two consecutive ones, and a last one alone, become
their H. What remains is the subroot, and the subroots, in order of their groups (NULL first, then by bytes), give the root in the same way.

1. Leaves are numbered by range partitioning, so a group that holds most rows is as spread out as any. 2^``height`` consecutive leaves
   of a group are a block, which is one unit of work and one stored row.
2. A block is an aligned subtree. Its nodes lie in one byte string in van Emde Boas order: the tree is split at half its height, the
   top part comes first, then the bottom parts from left to right, each laid out in the same way. `address` gives the place of a node by arithmetic;
   construction and sibling look-up use nothing else. A subtree shorter than its block goes on as a chain of lone nodes behind it.
3. Block roots are the leaves of the next round, up to one node a group; the subroots of the groups are a group of their own.
4. Proofs go down the same way: a block takes the siblings above its root and hands them, with its own, to its leaves. Only the last round does so row
   by row, and there it folds the row's present leaf through the siblings, which must give the root.

Rows are never dropped. Rows with NULL ids come first in their group; rows that share an id follow each other by leaf, and equal rows,
which have equal leaves, in any order. NULL, empty and very long texts are values like others. An empty table has no rows, no root and an empty result. Other columns,
whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.llm.common import stored
from plantlake.llm.ngram_join import grouped
from plantlake.operators.ordering import dense_number

#: A block has at most 2^HEIGHT leaves; its nodes take 64 bytes a leaf.
HEIGHT = 12
#: The group of the subroots.
CROWN = -1
LEFT, RIGHT, ALONE = 0, 1, 2


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` below the root of a perfect tree of ``levels`` levels, in van Emde Boas order."""
    place = np.zeros(len(index), dtype=np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth, bottom = depth - top, levels - top
        place += (1 << top) - 1 + (index >> depth) * ((1 << bottom) - 1)
        index, levels = index & ((1 << depth) - 1), bottom
    return place


@cache
def _places(height: int) -> list[list[int]]:
    """Addresses by number of steps above the leaves."""
    return [address(height + 1, height - up, np.arange(1 << (height - up))).tolist() for up in range(height + 1)]


def joined(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Subtree:
    """The nodes above ``count`` leaves, ``steps`` steps up: hex digests in van Emde Boas order, then a chain of lone nodes."""

    def __init__(self, count: int, steps: int):
        self.count, self.steps = count, steps
        self.height = min(steps, (count - 1).bit_length())
        self.places = _places(self.height)

    def build(self, leaves: Sequence[str]) -> Subtree:
        self.nodes = [""] * ((2 << self.height) - 1)
        level = list(leaves)
        for up in range(self.height + 1):
            for place, digest in zip(self.places[up], level, strict=False):
                self.nodes[place] = digest
            level = [joined(*level[k : k + 2]) for k in range(0, len(level), 2)]
        for _ in range(self.steps - self.height):
            self.nodes.append(joined(self.root))
        return self

    @property
    def root(self) -> str:
        return self.nodes[0] if self.steps == self.height or len(self.nodes) < 2 << self.height else self.nodes[-1]

    def packed(self) -> bytes:
        return b"".join(bytes.fromhex(n) if n else bytes(32) for n in self.nodes)

    def unpack(self, raw: bytes) -> Subtree:
        text = raw.hex()
        self.nodes = [text[k : k + 64] for k in range(0, len(text), 64)]
        return self

    def path(self, index: int) -> list[tuple[int, str]]:
        """The sibling at each step above a leaf: on its left, on its right, or none."""
        found, present = [], self.count
        for up in range(self.height):
            other = index ^ 1
            found.append((LEFT if index & 1 else RIGHT, self.nodes[self.places[up][other]]) if other < present else (ALONE, ""))
            index, present = index >> 1, (present + 1) >> 1
        return found + [(ALONE, "")] * (self.steps - self.height)


def pack_path(path: list[tuple[int, str]]) -> bytes:
    return b"".join(bytes((side,)) + bytes.fromhex(digest) for side, digest in path)


def unpack_path(raw: bytes) -> list[tuple[int, str]]:
    path, at = [], 0
    while at < len(raw):
        size = 0 if raw[at] == ALONE else 32
        path.append((raw[at], raw[at + 1 : at + 1 + size].hex()))
        at += 1 + size
    return path


def fold(leaf: str, path: list[tuple[int, str]]) -> str:
    """What a leaf gives with the siblings of its path."""
    for side, other in path:
        leaf = joined(other, leaf) if side == LEFT else joined(leaf, other)
    return leaf


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Hex sha256 of the columns' lengths and values; no two rows have one input."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


# --- blocks -----------------------------------------------------------------------------

_BLOCKS = "grp long, block long, count int, steps int, size long, root string, nodes binary"


def _steps(size: Column, height: int) -> Column:
    """Steps that a block goes up: the height of its group's tree, ``height`` at most."""
    return F.when(size > 1, F.least(F.length(F.bin(size - 1)), F.lit(height))).otherwise(0).cast("int")


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for unit in grouped(batches, 2):
        steps, size = unit.column("steps")[0].as_py(), unit.column("size")[0].as_py()
        tree = Subtree(unit.num_rows, steps).build(unit.column("node").to_pylist())
        row = [unit.column("grp")[0].as_py(), unit.column("block")[0].as_py(), tree.count, steps, -(-size >> steps), tree.root, tree.packed()]
        yield pa.RecordBatch.from_pylist([dict(zip(_BLOCK_NAMES, row, strict=True))], schema=_BLOCK_ARROW)


_BLOCK_ARROW = pa.schema(
    [("grp", pa.int64()), ("block", pa.int64()), ("count", pa.int32()), ("steps", pa.int32()), ("size", pa.int64()), ("root", pa.string()), ("nodes", pa.binary())]
)
_BLOCK_NAMES = _BLOCK_ARROW.names


def _raised(nodes: DataFrame, largest: int, height: int, name: str) -> list[DataFrame]:
    """nodes: grp, pos, size (nodes of the group), node. The stored blocks of each round, until every group has one node."""
    rounds = []
    while True:
        blocks = nodes.select("grp", F.shiftright("pos", height).alias("block"), "pos", "size", _steps(F.col("size"), height).alias("steps"), "node")
        blocks = blocks.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
        rounds.append(stored(blocks.mapInArrow(_built, _BLOCKS), f"{name}-{len(rounds)}"))
        largest = -(-largest >> height)
        if largest <= 1:
            return rounds
        nodes = rounds[-1].filter("size > 1").select("grp", F.col("block").alias("pos"), "size", F.col("root").alias("node"))


# --- proofs -----------------------------------------------------------------------------


def _handed_down(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = Subtree(row["count"], row["steps"]).unpack(row["nodes"])
                first = row["block"] << height
                yield pa.RecordBatch.from_pydict(
                    {
                        "grp": pa.array([row["grp"]] * tree.count, pa.int64()),
                        "pos": pa.array(range(first, first + tree.count), pa.int64()),
                        "above": pa.array([pack_path(tree.path(k)) + row["above"] for k in range(tree.count)], pa.binary()),
                    }
                )

    return run


def _lowered(rounds: list[DataFrame], tops: DataFrame, height: int, to: int) -> DataFrame:
    """The blocks of round ``to`` with the siblings above their roots; ``tops``: grp, top, those above each group's last node."""
    above = None
    for k in range(len(rounds) - 1, to - 1, -1):
        last = rounds[k].filter("size = 1").join(tops.withColumnRenamed("top", "above"), "grp")
        blocks = last
        if above is not None:
            inner = rounds[k].filter("size > 1").join(above.withColumnRenamed("pos", "block"), ["grp", "block"])
            blocks = last.unionByName(inner)
        if k == to:
            return blocks
        above = blocks.mapInArrow(_handed_down(height), "grp long, pos long, above binary")
    raise ValueError(f"there is no round {to}")


_PROOFS = "id string, leaf string, subroot string, proof_sha256 string, folded_root string"


def _proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each unit the block comes first, then its rows."""
    for unit in grouped(batches, 2):
        head = unit.slice(0, 1).to_pylist()[0]
        tree, above = Subtree(head["count"], head["steps"]).unpack(head["nodes"]), unpack_path(head["above"])
        tail, subroot = "".join(digest for _, digest in above), head["subroot"]
        rows = unit.slice(1)
        leaves, proofs, folded = rows.column("node").to_pylist(), [], []
        for k, (leaf, present) in enumerate(zip(leaves, rows.column("present").to_pylist(), strict=True)):
            path = tree.path(k)
            proofs.append(joined(*(digest for _, digest in path), tail))
            folded.append(fold(fold(present or leaf, path), above))
        columns = [rows.column("id").combine_chunks(), pa.array(leaves), pa.array([subroot] * len(leaves)), pa.array(proofs), pa.array(folded)]
        yield pa.RecordBatch.from_arrays([c.cast(pa.string()) for c in columns], names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])


@dataclass(frozen=True)
class Manifest:
    """A stored digest tree: numbered leaves, the blocks of the groups, and the blocks of the tree of subroots."""

    leaves: DataFrame  # grp, pos, size, id, node, present
    rounds: list[DataFrame]
    subroots: DataFrame  # grp, pos, size, node
    crown: list[DataFrame]
    root: str | None
    height: int

    def proofs(self) -> DataFrame:
        """One row per row of the table: id (text), leaf, subroot, proof_sha256 and folded_root, what the present leaf folds to."""
        top = self.crown[-1].select("grp", F.lit(b"").alias("top")).distinct()
        crown = _lowered(self.crown, top, self.height, 0).mapInArrow(_handed_down(self.height), "grp long, pos long, above binary")
        tops = crown.select("pos", F.col("above").alias("top")).join(self.subroots.select("pos", "grp", F.col("node").alias("subroot")), "pos")
        blocks = _lowered(self.rounds, tops.select("grp", "top"), self.height, 0).join(tops.select("grp", "subroot"), "grp")
        blocks = blocks.select("grp", "block", F.lit(-1).cast("long").alias("pos"), "count", "steps", "nodes", "above", "subroot")
        rows = self.leaves.select("grp", F.shiftright("pos", self.height).alias("block"), "pos", "id", "node", "present")
        both = blocks.unionByName(rows, allowMissingColumns=True).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
        return both.mapInArrow(_proven, _PROOFS)


def manifest(
    table: DataFrame, columns: Sequence[str], id_col: str, group_col: str, present: Column | None = None, height: int = HEIGHT
) -> Manifest:
    """Build the digest tree of a table. ``present`` is what a row's leaf is found to be later (NULL: unchanged), for checking proofs."""
    held = F.lit(None).cast("string") if present is None else present
    narrow = table.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("name"), leaf_digest([F.col(c) for c in columns]).alias("node"), held.alias("present")
    )
    numbered = dense_number(stored(narrow, "manifest-leaves"), ["name", "id", "node"], "n")
    groups = stored(numbered.groupBy("name").agg(F.min("n").alias("grp"), F.count("*").alias("size")), "manifest-groups")
    n_groups, largest = groups.agg(F.count("*"), F.max("size")).first()
    sizes = groups.withColumnRenamed("name", "of")
    leaves = numbered.join(sizes, F.col("name").eqNullSafe(F.col("of"))).select(
        "grp", (F.col("n") - F.col("grp")).alias("pos"), "size", F.col("id").cast("string").alias("id"), "node", "present"
    )
    rounds = _raised(leaves, largest or 0, height, "manifest-blocks")
    tops = reduce(DataFrame.unionByName, [r.filter("size = 1").select("grp", F.col("root").alias("node")) for r in rounds])
    # Groups are numbered by their first leaf, so their numbers ascend like their names.
    subroots = dense_number(tops, ["grp"], "pos").select("grp", "pos", F.lit(n_groups).cast("long").alias("size"), "node")
    crown = _raised(subroots.withColumn("grp", F.lit(CROWN).cast("long")), n_groups, height, "manifest-crown")
    last = crown[-1].filter("size = 1").select("root").first()
    return Manifest(leaves, rounds, subroots, crown, last and last["root"], height)


def verified_rows(
    table: DataFrame, columns: Sequence[str], id_col: str, group_col: str, present: Column | None = None, height: int = HEIGHT
) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root and verified: whether the row's present leaf still gives the root."""
    tree = manifest(table, columns, id_col, group_col, present, height)
    root = F.lit(tree.root).cast(T.StringType())
    return tree.proofs().select(
        F.col("id").cast(table.schema[id_col].dataType).alias(id_col),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
