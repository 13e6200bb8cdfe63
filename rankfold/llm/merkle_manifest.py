"""A Merkle manifest of a table, and what becomes of its root when rows are changed.

A row's leaf is the digest of its fields. The leaves of each part, in the order of a key,
are the bottom of a binary tree; the parts' roots, in the order of their names, are the
bottom of one more tree, whose root stands for the table.

Trees are grown in tiers. Nodes are numbered along the sorted table and cut into aligned
blocks of ``2 ** HEIGHT``, so a block is a whole subtree; one task grows each block, and the
blocks' roots are the nodes of the next tier, until a part has one left. No task sees more
than a block, however large a part is. Then the way back down: each block is told the siblings
above its root, one short list a block, and builds its persistent tree again.

A changed leaf makes a new version of its block's tree. The version copies the leaf's
ancestors and shares every other node with the original; it goes on through the tiers above
by the siblings the block was told, each version by itself, in the task that has its leaf.

``H`` is the hex SHA-256 of its inputs put one after the other, digests as hex text. A node
without a neighbour is hashed alone while its level has others; a part with one leaf has that
leaf as its root. Null fields enter as ``-``, others as UTF-8 length, ``:`` and value; so an
empty text and a null differ. Rows without a part (null) form one, the first. Null keys come
first; equal keys go by their leaves, and rows repeated whole are leaves of their own. An
empty table gives no rows. Columns that are neither field, part nor key are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import column, reach_workers, written

#: Levels of a block: a task holds up to ``2 ** HEIGHT`` nodes at a time.
HEIGHT = 12
#: ``monotonically_increasing_id`` holds the partition above this bit.
_SLICE_BITS = 33


def digest(*inputs: str) -> str:
    return sha256("".join(inputs).encode()).hexdigest()


class BlockTree:
    """The subtree over one block of nodes; versions of it share what they do not change."""

    def __init__(self, nodes: list[str], count: int, height: int = HEIGHT):
        """``count`` is the number of nodes on the whole tier: where a block is all of it, the tree ends at one node."""
        self.levels = [nodes]
        while len(self.levels) <= height and (len(self.levels[-1]) > 1 or count > 1 << height):
            below = self.levels[-1]
            self.levels.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[str]:
        """From the node up: ``<`` and the left neighbour, ``>`` and the right one, or nothing."""
        found = []
        for level in self.levels[:-1]:
            other = at ^ 1
            found.append(("<" if other < at else ">") + level[other] if other < len(level) else "")
            at >>= 1
        return found

    def changed(self, at: int, node: str) -> dict[tuple[int, int], str]:
        """A version with another node at ``at``: the copied nodes, by level and place."""
        copied = {(0, at): node}
        for height, level in enumerate(self.levels[:-1]):
            pair = range(at & ~1, min((at | 1) + 1, len(level)))
            at >>= 1
            copied[height + 1, at] = digest(*(copied.get((height, i), level[i]) for i in pair))
        return copied

    def root_of(self, version: dict[tuple[int, int], str]) -> str:
        return version.get((len(self.levels) - 1, 0), self.root)


def folded(node: str, siblings: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for sibling in siblings:
        if sibling.startswith("<"):
            node = digest(sibling[1:], node)
        else:
            node = digest(node, sibling[1:])
    return node


def leaf(fields: list[Column]) -> Column:
    """The digest of a row's fields."""
    said = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in (field.cast("string") for field in fields)
    ]
    return F.sha2(F.concat(*said), 256)


def numbered(rows: DataFrame, order: list[str], kind: str) -> DataFrame:
    """``rows`` with ``pos``, their place within ``part`` in this order, and ``n``, the part's rows.

    The sorted rows are written once with their slice and row, so that a task that runs again
    numbers nothing anew; slices are counted by part, and a part's slices are few.
    """
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    ranked = spread.orderBy("part", *order, "tie").drop("tie")
    ranked = written(ranked.withColumn("place", F.monotonically_increasing_id()), kind)
    slice_of = F.shiftright("place", _SLICE_BITS)
    sizes = ranked.groupBy(F.col("part").alias("p"), slice_of.alias("s")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("size")
    )
    before = Window.partitionBy("p").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "p", "s", "first",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(Window.partitionBy("p")).alias("n"),
    )
    placed = ranked.join(starts, (F.col("part") == F.col("p")) & (slice_of == F.col("s")))
    return placed.withColumn("pos", F.col("place") - F.col("first") + F.col("start")).drop("place", "p", "s", "first", "start")


def _in_blocks(nodes: DataFrame, height: int):
    return nodes.withColumn("block", F.shiftright("pos", height)).groupBy("part", "block")


def _ordered(block: pa.Table) -> pa.Table:
    return block.sort_by("pos")


def grow(nodes: DataFrame, kind: str, height: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """The tiers over nodes ``part, pos, n, digest``, and ``part, digest`` of each part's root."""

    def root(block: pa.Table) -> pa.Table:
        block = _ordered(block)
        count, size = block["n"][0].as_py(), 1 << height
        tree = BlockTree(block["digest"].to_pylist(), count, height)
        row = {
            "part": block["part"][0].as_py(),
            "pos": block["pos"][0].as_py() // size,
            "n": -(-count // size),
            "digest": tree.root,
        }
        return pa.Table.from_pylist([row])

    reach_workers(nodes.sparkSession)
    most = nodes.agg(F.max("n")).head()[0] or 0
    tiers = []
    while most > 1:
        tiers.append(nodes)
        nodes = _in_blocks(nodes.select("part", "pos", "n", "digest"), height)
        nodes = written(nodes.applyInArrow(root, "part string, pos bigint, n bigint, digest string"), kind)
        most = -(-most >> height)
    return tiers, nodes.select("part", "digest")


def _descend(nodes: DataFrame, above: DataFrame, told, schema: str, height: int) -> DataFrame:
    """Each block of a tier with what is known of its root, through ``told(block, known, tree)``."""

    def work(block: pa.Table, known: pa.Table) -> pa.Table:
        block = _ordered(block)
        tree = BlockTree(block["digest"].to_pylist(), block["n"][0].as_py(), height)
        return told(block, known.to_pylist()[0], tree)

    known = above.withColumnRenamed("pos", "block").groupBy("part", "block")
    return _in_blocks(nodes, height).cogroup(known).applyInArrow(work, schema)


_KNOWN = "part string, pos bigint, siblings array<string>, subroot string, root string"


def _siblings(block: pa.Table, known: dict, tree: BlockTree) -> pa.Table:
    """The siblings of every node of a block, up to the root of all."""
    first = block["pos"][0].as_py()
    places = block["pos"].to_pylist()
    return pa.table(
        {
            "part": block["part"],
            "pos": block["pos"],
            "siblings": pa.array([tree.siblings(at - first) + known["siblings"] for at in places], pa.list_(pa.string())),
            "subroot": pa.array([known["subroot"]] * len(places), pa.string()),
            "root": pa.array([known["root"]] * len(places), pa.string()),
        }
    )


def _verified(block: pa.Table, known: dict, tree: BlockTree) -> pa.Table:
    """Every leaf of a block: its proof, and the root it leads to, changed if it was."""
    above, root = known["siblings"], known["root"]
    proofs, roots = [], []
    for at, (original, now) in enumerate(zip(block["digest"].to_pylist(), block["changed"].to_pylist())):
        siblings = tree.siblings(at) + above
        proofs.append(digest(*(sibling[1:] for sibling in siblings)))
        version = tree.changed(at, original if now is None else now)
        node = tree.root_of(version)
        roots.append(folded(node, above))
    rows = len(proofs)
    return pa.table(
        {
            "id": block["id"],
            "leaf": block["digest"],
            "subroot": pa.array([known["subroot"]] * rows, pa.string()),
            "root": pa.array([root] * rows, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(roots, pa.string()),
            "verified": pa.array([other == root for other in roots], pa.bool_()),
        }
    )


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    part: str = "lang",
    tampered: Mapping[str, Column] | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """One row for each row: ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``tampered`` gives fields other values, null expressions included; where a row's leaf
    changes by it, ``folded_root`` is that of the version with only this leaf changed. The
    proof's digest is over the leaf's siblings, from the leaf up, through the part's root to
    the root of all.
    """
    tampered = dict(tampered or {})
    original = leaf([column(name) for name in fields])
    other = leaf([tampered.get(name, column(name)) for name in fields])
    rows = docs.select(
        F.coalesce(F.concat(F.lit("+"), column(part).cast("string")), F.lit("")).alias("part"),
        column(key).alias("id"),
        original.alias("digest"),
        F.when(original != other, other).alias("changed"),
    )
    leaves = numbered(written(rows, "leaves"), ["id", "digest"], "manifest")
    tiers, parts = grow(leaves, "manifest", height)
    names = numbered(parts.select(F.lit("").alias("part"), F.col("part").alias("name"), "digest"), ["name"], "manifest")
    upper_tiers, top = grow(names, "manifest", height)
    known = top.select(
        "part",
        F.lit(0).cast("long").alias("pos"),
        F.array().cast("array<string>").alias("siblings"),
        F.lit("").alias("subroot"),
        F.col("digest").alias("root"),
    )
    for nodes in reversed(upper_tiers):
        known = written(_descend(nodes.select("part", "pos", "n", "digest"), known, _siblings, _KNOWN, height), "manifest")
    # From the tree over the parts to the trees of the parts.
    here = names.select(F.col("pos").alias("at"), "name", F.col("digest").alias("own"))
    known = known.join(here, F.col("pos") == F.col("at")).select(
        F.col("name").alias("part"), F.lit(0).cast("long").alias("pos"), "siblings", F.col("own").alias("subroot"), "root"
    )
    for nodes in reversed(tiers[1:]):
        known = written(_descend(nodes, known, _siblings, _KNOWN, height), "manifest")
    kind = docs.select(column(key).alias("id")).schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
    )
    return _descend(leaves, known, _verified, schema, height).withColumnRenamed("id", key)
