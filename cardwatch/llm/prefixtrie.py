"""A trie of conversation prefixes in tables of slots.

A node is a distinct sequence of first turns; its digest chains the digests of (role, text).  Nodes are dealt to
shards by whole subtrees; a shard gives its digests slots by a minimal perfect hash whose slots remember their digest,
scatters the counts into flat arrays and adds them up through an array of parent slots, deepest turns first.

Subtrees of more than about ``most`` turns are not given to one shard: their upper nodes wait, take up the sums of the
subtrees below, and are dealt in the same way with a larger limit, until those that remain fit one table.  A conversation
that starts very many others is combined before it is shuffled.  What a shard holds is bounded by ``most`` turns, or the
turns of a single conversation that has more.

Turns go by ``turn`` (null first), then by digest.  Null roles and texts are empty.  Rows without conv_id
belong to no conversation and are left out.  An empty table has no node.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from cardwatch.llm.slots import SlotTable, digest_words
from cardwatch.llm.store import written

FAMILY = 5
LENGTHS = 9
SHARD_TURNS = 1 << 15
GROWTH = 64
BROADCAST_NODES = 200_000
IDS_PER_PIECE = 4096
SHARD_BITS = 24
EMPTY = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a rebuilt conversation takes from the first one of its family."""
    return F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % LENGTHS


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, digest, bytes) of every turn, from rank 0; no text is shuffled."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.encode(content, "UTF-8"), 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest"))
    return turns.select("conv_id", (place - 1).alias("rank"), "digest", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, part, rank, digest, bytes): a start (part -1), shared turns (0) and own turns (1) of each conversation."""
    shared, base = shared_turns(F.col("conv_id")), F.col("conv_id") - F.col("conv_id") % FAMILY
    names = turns.select("conv_id").distinct()
    heads = turns.filter(f"conv_id % {FAMILY} = 0 and rank < {LENGTHS - 1}").withColumnRenamed("conv_id", "base")
    taken = names.withColumn("base", base).join(heads, "base").filter(F.col("rank") < shared)
    return (
        names.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("rank"), F.lit(None).cast("binary").alias("digest"),
                     F.lit(0).cast("long").alias("bytes"))
        .union(taken.select("conv_id", F.lit(0), "rank", "digest", "bytes"))
        .union(turns.filter(F.col("rank") >= shared).select("conv_id", F.lit(1), "rank", "digest", "bytes"))
    )


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of all prefixes, from rows in order; a conversation may go on in the next batch."""
    node, depth = b"", 0
    for batch in batches:
        nodes, parents, depths = [], [], []
        for digest in batch.column("digest").to_pylist():
            if digest is None:
                parent, node, depth = None, hashlib.sha256(b"").digest(), 0
            else:
                parent, depth = node, depth + 1
                node = hashlib.sha256(parent + digest).digest()
            nodes.append(node)
            parents.append(parent)
            depths.append(depth)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(depths, pa.int64()), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()),
             batch.column("bytes"), batch.column("turns")], ["conv_id", "depth", "node", "parent", "bytes", "turns"])


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, bytes, left): all prefixes of all rebuilt conversations; ``left`` turns follow."""
    rows = rebuilt(turns).withColumn("turns", F.count("*").over(Window.partitionBy("conv_id")) - 1)
    chained = rows.sortWithinPartitions("conv_id", "part", "rank").mapInArrow(
        _chain, "conv_id long, depth long, node binary, parent binary, bytes long, turns long")
    return chained.select("conv_id", "depth", "node", "parent", "bytes", (F.col("turns") - F.col("depth")).alias("left"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) as texts of some thousand ids each."""
    node, ids = None, []
    out: list[tuple[bytes, int, str]] = []

    def close() -> None:
        if ids:
            out.append((node, ids[0], ",".join(map(str, ids))))
            ids.clear()

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.string())], ["node", "first", "ids"])
        out.clear()
        return made

    for rows in batches:
        for at, conv_id in zip(rows.column("node").to_pylist(), rows.column("conv_id").to_pylist()):
            if at != node or len(ids) == IDS_PER_PIECE:
                close()
                node = at
            ids.append(conv_id)
        yield batch()
    close()
    yield batch()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces in order; one running hash, however long the list is."""
    node, running = None, None
    for rows in batches:
        done = []
        for at, ids in zip(rows.column("node").to_pylist(), rows.column("ids").to_pylist()):
            if at != node:
                if running:
                    done.append((node, running.hexdigest()))
                node, running = at, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield _ended(done)
    yield _ended([(node, running.hexdigest())] if running else [])


def _ended(done: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())],
                                      ["node", "ends"])


def _ends(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, ends) of the nodes at which several conversations end.

    A digest of a list is one chain, so the list of one node is hashed in one task; it is read in order, in
    texts of some thousand ids that are joined by range in as many tasks as there are ranges.
    """
    several = nodes.filter("n_ends > 1").select("node")
    ended = rows.filter("left = 0").select("node", "conv_id").join(several, "node", "left_semi")
    ranges = written(ended, "trie-ends").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = written(ranges.mapInArrow(_pieces, "node binary, first long, ids string"), "trie-pieces")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_streamed, "node binary, ends string")


def add_up(shard: pa.Table) -> pa.Table:
    """n_children, n_leaves, saved and the parent's conv_id of a shard's nodes, on arrays ordered by slot.

    ``children``, ``leaves`` and ``below`` are what the subtrees of other shards hand up to a node.
    """
    table = SlotTable(digest_words(shard["node"]))
    row_of = np.empty(len(table.slots), np.int64)
    row_of[table.slots] = np.arange(len(row_of))

    def flat(name: str) -> np.ndarray:
        values = np.empty(len(row_of), np.int64)
        values[table.slots] = shard[name].to_numpy()
        return values

    parent = np.empty(len(row_of), np.int64)
    parent[table.slots] = table.find(digest_words(shard["parent"]))
    depth, conv_id = flat("depth"), flat("conv_id")
    children, leaves = flat("children"), flat("leaves")
    saved = (flat("n_convs") - 1) * flat("bytes") + flat("below")
    inner = parent >= 0
    np.add.at(children, parent[inner], 1)
    leaves[children == 0] = 1
    order = np.flatnonzero(inner)
    order = order[np.argsort(-depth[order], kind="stable")]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []:
        np.add.at(saved, parent[level], saved[level])
        np.add.at(leaves, parent[level], leaves[level])
    up = pa.array(conv_id[parent], mask=~inner)
    columns = {"node": shard["node"].take(pa.array(row_of)), "parent": shard["parent"].take(pa.array(row_of)),
               "inner": inner, "up": up, "n_children": children, "n_leaves": leaves, "saved": saved}
    return pa.table(columns)


ADDED = "node binary, parent binary, inner boolean, up long, n_children long, n_leaves long, saved long"


def _bounded(nodes: DataFrame, n: int) -> DataFrame:
    return F.broadcast(nodes) if n <= BROADCAST_NODES else nodes


def _shards(rows: DataFrame, high: DataFrame, low: DataFrame, n: int) -> DataFrame:
    """The low nodes with the shard of the subtree they are in: that of the first low node on a conversation's way."""
    place = F.pmod(F.xxhash64("node"), F.lit(n))
    code = F.shiftleft("depth", SHARD_BITS).bitwiseOR(place)
    first = rows.join(high, "node", "left_anti").groupBy("conv_id").agg(F.min(code).alias("code"))
    return low.join(first, "conv_id").withColumn("shard", F.col("code").bitwiseAND(F.lit((1 << SHARD_BITS) - 1))).drop("code")


def _handed(added: DataFrame, earlier: DataFrame | None, high: DataFrame) -> DataFrame:
    """(parent, children, leaves, below): what subtrees hand up to the nodes that wait, in this and earlier rounds."""
    new = added.filter("not inner").groupBy("parent").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("below"))
    if earlier is None:
        return new
    still = earlier.join(high.select(F.col("node").alias("parent")), "parent", "left_semi")
    return still.unionByName(new).groupBy("parent").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "below")])


def _summed(rows: DataFrame, nodes: DataFrame, most: int) -> list[DataFrame]:
    """``add_up`` of all nodes, from the small subtrees to the root."""
    done, handed, limit, waiting, count = [], None, most, nodes, nodes.count()
    while True:
        last = count <= most
        low = waiting if last else waiting.filter(F.col("weight") <= limit)
        high = waiting.filter("false") if last else written(waiting.filter(F.col("weight") > limit), "trie-high")
        above = 0 if last else high.count()
        names = _bounded(high.select("node"), above)
        if last:
            dealt = low.withColumn("shard", F.lit(0).cast("long"))
        else:
            dealt = _shards(rows, names, low, min(-(-count // most), (1 << SHARD_BITS) - 1))
        if handed is None:
            dealt = dealt.withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "below")})
        else:
            dealt = dealt.join(handed.withColumnRenamed("parent", "node"), "node", "left").na.fill(0, ["children", "leaves", "below"])
        added = written(dealt.groupBy("shard").applyInArrow(add_up, ADDED), "trie-added")
        tops = high.select(F.col("node").alias("parent"), F.col("conv_id").alias("over"))
        done.append(added.join(_bounded(tops, above), "parent", "left").withColumn("up", F.coalesce("up", "over")))
        if not above:
            return done
        handed = written(_handed(added, handed, high), "trie-handed")
        owners = high.select("conv_id").distinct()
        rows = written(rows.join(names, "node", "left_semi").join(owners, "conv_id", "left_semi"), "trie-ways")
        waiting, count, limit = high, above, limit * GROWTH


def trie(conversations: DataFrame, most: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; shards get about ``most`` turns each."""
    rows = written(prefixes(written(turn_digests(conversations), "trie-turns")), "trie-prefixes")
    ends = F.col("left") == 0
    nodes = written(
        rows.groupBy("node", "parent", "depth", "bytes").agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(F.col("left") + 1).alias("weight"),
            F.count(F.when(ends, 1)).alias("n_ends"), F.min(F.when(ends, F.col("conv_id"))).alias("end"),
        ), "trie-nodes")
    added = None
    for part in _summed(rows, nodes, most):
        added = part if added is None else added.union(part)
    added = added.select("node", "up", "n_children", "n_leaves", "saved")
    found = nodes.join(added, "node").join(_ends(rows, nodes), "node", "left")
    one = F.sha2(F.encode(F.col("end").cast("string"), "UTF-8"), 256)
    return found.select(
        "conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.when(F.col("n_ends") == 0, F.lit(EMPTY)).when(F.col("n_ends") == 1, one).otherwise(F.col("ends")).alias("ends_sha256"),
        F.lower(F.hex("node")).alias("prefix"),
    )
