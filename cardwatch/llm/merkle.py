"""A Merkle manifest of a table, kept as a persistent tree whose versions share untouched nodes.

Leaves are ordered within groups; every eight neighbours become one node, level by level, until a group has one
node, its subroot.  The subroots, by the group's bytes (null first), become the root in the same way.

The tree is cut into aligned blocks of 8^4 leaves, each built in a task by itself.  The tops of the blocks are the leaves of
the next, distributed stage, and so on.  A stage hands back to each of its leaves the siblings on the way to the root, so a
block below can continue its versions to the root without seeing other blocks.  An altered leaf makes one version:
``Tree.put`` copies the leaf's ancestors and points at all other nodes of the tree as they were.

A null field is ``-`` and an empty text ``0:``, so the two differ.  Rows without id come first and are never altered by a
rule on ids.  Rows of one group and id are ordered by their leaf digest; rows equal in all fields have equal leaves, so any
order of them gives one tree.  Null is a group of its own.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.llm.numbering import numbered
from cardwatch.llm.store import written

FANOUT = 8
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def digest(*parts: bytes) -> bytes:
    """SHA-256 of the parts end to end, as hex."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


class Tree:
    """Nodes that never change: a digest and the numbers of its children.  ``put`` makes a new version."""

    def __init__(self, leaves: Sequence[bytes], levels: int):
        self.digests, self.children = list(leaves), [()] * len(leaves)
        row = list(range(len(leaves)))
        for _ in range(levels):
            row = [self._node(tuple(row[i : i + FANOUT])) for i in range(0, len(row), FANOUT)]
        self.levels, self.root = levels, row[0]

    def _node(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest(*[self.digests[c] for c in children]))
        self.children.append(children)
        return len(self.digests) - 1

    def _way(self, position: int) -> list[tuple[int, int]]:
        """(node, which child) from the root down to a leaf's parent."""
        node, way = self.root, []
        for level in reversed(range(self.levels)):
            at = position // FANOUT**level % FANOUT
            way.append((node, at))
            node = self.children[node][at]
        return way

    def path(self, position: int) -> list[tuple[bytes, bytes]]:
        """The siblings to the left and right of a leaf and its ancestors, from below."""
        out = []
        for node, at in reversed(self._way(position)):
            around = [self.digests[c] for c in self.children[node]]
            out.append((b"".join(around[:at]), b"".join(around[at + 1 :])))
        return out

    def put(self, position: int, leaf: bytes) -> list[int]:
        """A version with another leaf: the numbers of its own nodes, leaf first, root last; all others are shared."""
        self.digests.append(leaf)
        self.children.append(())
        own = [len(self.digests) - 1]
        for node, at in reversed(self._way(position)):
            old = self.children[node]
            own.append(self._node((*old[:at], own[-1], *old[at + 1 :])))
        return own


def _tree(block: pa.Table, most: int) -> tuple[pa.Table, Tree]:
    """The block's rows in order and their tree, of ``most`` levels, or fewer if one node is left of the group."""
    block, levels = block.sort_by("pos"), 0
    while levels < most and FANOUT**levels < block["n"][0].as_py():
        levels += 1
    return block, Tree([x.encode() for x in block["digest"].to_pylist()], levels)


def _blocked(rows: DataFrame, levels: int) -> DataFrame:
    return rows.withColumn("block", F.expr(f"pos div {FANOUT**levels}"))


def _tops(rows: DataFrame, levels: int) -> DataFrame:
    """(grp, pos, digest, n) of the top of every block; ``of`` is the number of leaves the group had below."""

    def build(block: pa.Table) -> pa.Table:
        of, (_, tree) = block["n"][0].as_py(), _tree(block, levels)
        return pa.table({"grp": [block["grp"][0].as_py()], "pos": [block["block"][0].as_py()],
                         "digest": [tree.digests[tree.root].decode()], "n": [-(-of // FANOUT**levels)], "of": [of]})

    narrow = _blocked(rows.select("grp", "pos", "digest", "n"), levels)
    return narrow.groupBy("grp", "block").applyInArrow(build, "grp string, pos long, digest string, n long, of long")


def _upwards(rows: DataFrame, levels: int, label: str) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Each stage's leaves and tops, and (grp, digest) of the groups' last nodes."""
    stages, last = [], None
    while True:
        tops = written(_tops(rows, levels), f"{label}-tops")
        done = tops.filter(F.col("of") <= FANOUT**levels).select("grp", "digest")
        stages.append((rows, tops))
        last = done if last is None else last.union(done)
        rows = tops.filter(F.col("of") > FANOUT**levels).drop("of")
        if rows.isEmpty():
            return stages, last


def _paths(members: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """(grp, pos, path) of each member of the blocks: the path within its block, then that of the block."""

    def expand(block: pa.Table, above: pa.Table) -> pa.Table:
        schema = pa.schema({"grp": pa.string(), "pos": pa.int64(), "path": pa.list_(pa.struct({"left": pa.string(), "right": pa.string()}))})
        if not block.num_rows:
            return schema.empty_table()
        block, tree = _tree(block, levels)
        rest = above["path"][0].as_py()
        ways = [[{"left": a.decode(), "right": b.decode()} for a, b in tree.path(i)] + rest for i in range(block.num_rows)]
        return pa.table({"grp": block["grp"].to_pylist(), "pos": block["pos"].to_pylist(), "path": ways}, schema)

    left = _blocked(members.select("grp", "pos", "digest", "n"), levels).groupBy("grp", "block")
    return left.cogroup(paths.groupBy("grp", "block")).applyInArrow(expand, f"grp string, pos long, path {PATH}")


def _downwards(stages: list, ends: DataFrame, levels: int, label: str) -> DataFrame:
    """(grp, block, path) of the lowest stage's blocks, given (grp, path) of the groups' last nodes."""
    found = None
    for k in reversed(range(len(stages))):
        members, tops = stages[k]
        last = tops.filter(F.col("of") <= FANOUT**levels).select("grp", F.col("pos").alias("block")).join(ends, "grp")
        paths = last if found is None else last.union(found.select("grp", F.col("pos").alias("block"), "path"))
        if k == 0:
            return paths
        found = written(_paths(members, paths, levels), f"{label}-paths")


def leaf_digest(text: Column) -> Column:
    """The leaf of a row of documents whose text is ``text``."""

    def field(name: str) -> Column:
        value = (text if name == "text" else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.encode(F.concat(*[field(name) for name in FIELDS]), "UTF-8"), 256)


def manifest(docs: DataFrame, altered: Column, text: Column, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Each row's place in the tree and, where ``altered`` holds, the version in which its text is ``text``.

    doc_id, leaf, subroot, root, proof (the siblings from leaf to root end to end), folded_root (the root of the
    row's version, or of the tree as it is), verified, and ``copied``: the nodes that the version has for itself.
    Blocks have ``8^levels`` leaves; the result does not depend on it.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    leaves = docs.select(
        group.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(F.col("text")).alias("digest"),
        F.when(altered, leaf_digest(text)).alias("changed"), F.monotonically_increasing_id().alias("row"),
    )
    ranked = numbered(written(leaves, "merkle-leaves"), "grp", ["doc_id", "digest", "row"], "merkle-ranges")
    ranked = written(ranked.drop("row"), "merkle-ranked")
    stages, subroots = _upwards(ranked, levels, "merkle")

    tops = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    tops = written(numbered(written(tops, "merkle-subroots"), "grp", ["name"], "merkle-names"), "merkle-named")
    upper, last = _upwards(tops, levels, "merkle-upper")
    root = last.first()
    root = root.digest if root else None
    nothing = last.select("grp", F.array().cast(PATH).alias("path"))
    ways = _paths(tops, _downwards(upper, nothing, levels, "merkle-upper"), levels)
    ends = tops.join(ways.select("pos", "path"), "pos").select(F.col("name").alias("grp"), "path")
    paths = _downwards(stages, written(ends, "merkle-ends"), levels, "merkle").join(
        subroots.select("grp", F.col("digest").alias("subroot")), "grp")

    kinds = {"doc_id": pa.int64(), "leaf": pa.string(), "subroot": pa.string(), "proof_sha256": pa.string(),
             "folded_root": pa.string(), "copied": pa.list_(pa.string())}
    schema = pa.schema(kinds)

    def versions(block: pa.Table, above: pa.Table) -> pa.Table:
        if not block.num_rows:
            return schema.empty_table()
        block, tree = _tree(block, levels)
        rest = [(x["left"].encode(), x["right"].encode()) for x in above["path"][0].as_py()]
        original, changed = block["digest"].to_pylist(), block["changed"].to_pylist()
        proofs, roots, copies = [], [], []
        for i, new in enumerate(changed):
            way = tree.path(i)
            proofs.append(digest(*[a + b for a, b in way + rest]).decode())
            if new is None:
                own, ahead = [original[i].encode()], way + rest
            else:
                own, ahead = [tree.digests[node] for node in tree.put(i, new.encode())], rest
            for before, after in ahead:
                own.append(digest(before, own[-1], after))
            roots.append(own[-1].decode())
            copies.append([] if new is None else [x.decode() for x in own])
        return pa.table({"doc_id": block["doc_id"].to_pylist(), "leaf": original, "subroot": above["subroot"].to_pylist() * block.num_rows,
                         "proof_sha256": proofs, "folded_root": roots, "copied": copies}, schema)

    members = _blocked(ranked, levels).groupBy("grp", "block")
    found = members.cogroup(paths.groupBy("grp", "block")).applyInArrow(
        versions, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string, copied array<string>")
    return found.select(
        "doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"), "copied",
    )
