"""Prefix trie of conversations: which beginnings are shared, and what sharing saves.

A turn is named by a code of 20 bytes: the MD5 of role and text, then the text's
length.  A conversation is the row of its turns' codes, so texts are read once and never
shuffled.  Rows are dealt to shards by ranges of (codes, conversation); a shard turns
them into a matrix of turn ids, a column for each depth, padded with zeros where a
conversation has ended.  A lexicographic sort makes the members of every node
neighbours.  Where a row differs from the one above it, in this column or in one before,
a node starts: the change masks are accumulated by OR from column to column, and
``reduceat`` sums each depth between its starts.  Long conversations are taken in
strips of columns, so that few of them cost no wide matrix.

Only nodes on the path of a shard's first or last row can have members elsewhere.  These
are kept as partial rows, one for each shard, side and depth, and recombined by Spark:
equal prefixes are added up, and what lies below them is summed along the paths.  A
group of equal conversations may fill many shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import land

CODE = 20  # bytes: MD5 and the text's length
EVERY = 5  # conversations that share a base
# Bytes of codes in a shard, columns of a strip, conversations in one piece of an id list.
SHARD_BYTES = 4 << 20
STRIP = 16
LISTED = 50_000
_NOBODY = hashlib.sha256(b"").hexdigest()

_PARTS = (
    "kind string, shard int, side int, depth long, key binary, up_key binary, conv_id long, up_conv long, "
    "bytes long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
)


def _code(role: Column, text: Column) -> Column:
    """Hexadecimal code of a turn."""
    size = F.octet_length(text)
    named = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.concat(named, F.lpad(F.lower(F.hex(size.cast("long"))), 8, "0"))


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): the codes of a conversation's turns, ordered by turn, null first.

    Null roles and texts are empty.  Equal turns are ordered by their codes, so repeated
    rows stay; rows without a conv_id take no part.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), "turn", _code(role, text).alias("code")).alias("at"),
    )
    ordered = F.array_sort(F.collect_list("at"))["code"]
    return turns.groupBy("conv_id").agg(F.unhex(F.array_join(ordered, "")).alias("path"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Each conversation with the first turns of its base, the one with the id ``c - c % 5``."""
    paths = land(paths, "paths").withColumn("h", shared_turns(F.col("conv_id")))
    base = paths.where(F.col("conv_id") % EVERY == 0).select(
        F.col("conv_id").alias("base"), F.expr(f"substring(path, 1, {8 * CODE})").alias("head")
    )
    taken = F.expr(f"substring(coalesce(head, X''), 1, cast({CODE} * h as int))")
    own = F.expr(f"substring(path, cast({CODE} * h + 1 as int))")
    joined = paths.join(base, F.col("conv_id") - F.col("conv_id") % EVERY == F.col("base"), "left")
    return joined.select("conv_id", F.concat(taken, own).alias("path"))


def _turn_ids(codes: np.ndarray) -> np.ndarray:
    """Ids from one, in the order of the codes."""
    high, low = codes[:, :8].copy().view(">u8")[:, 0], codes[:, 8:16].copy().view(">u8")[:, 0]
    size = codes[:, 16:].copy().view(">u4")[:, 0]
    order = np.lexsort((size, low, high))
    ids = np.empty(len(codes), np.int64)
    fresh = np.ones(len(codes), bool)
    same = np.ones(max(0, len(codes) - 1), bool)
    for part in (high, low, size):
        part = part[order]
        same &= part[1:] == part[:-1]
    fresh[1:] = ~same
    ids[order] = np.cumsum(fresh)
    return ids


class Trie:
    """Nodes of the rows of one shard; arrays by node, root first, depth after depth."""

    def __init__(self, conv: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
        offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        ids = _turn_ids(codes) if len(codes) else np.zeros(0, np.int64)
        sizes = codes[:, 16:].copy().view(">u4")[:, 0].astype(np.int64) if len(codes) else ids
        self.end = np.zeros(len(conv), np.int64)  # of each row, the node of all its turns
        up, least = [np.array([-1])], [np.array([conv.min()])]
        members, last = [np.array([len(conv)])], [np.zeros(1, np.int64)]
        self.firsts = [0, 1]  # of each depth, its first node
        for left in range(0, int(lengths.max(initial=0)), STRIP):
            rows = np.flatnonzero(lengths > left)
            cells = offsets[rows, None] + left + np.arange(STRIP)
            there = left + np.arange(STRIP) < lengths[rows, None]
            matrix = np.where(there, ids[np.minimum(cells, len(ids) - 1)], 0)
            order = np.lexsort((conv[rows], *matrix.T[::-1], self.end[rows]))
            rows, matrix = rows[order], matrix[order]
            change = np.ones(matrix.shape, bool)
            change[1:] = matrix[1:] != matrix[:-1]
            change[1:, 0] |= self.end[rows[1:]] != self.end[rows[:-1]]
            change = np.logical_or.accumulate(change, axis=1)
            for column in range(STRIP):
                at = np.flatnonzero(matrix[:, column])
                if not len(at):
                    break
                starts = np.flatnonzero(change[at, column])
                inside = rows[at]
                counts = np.add.reduceat(np.ones(len(at), np.int64), starts)
                up.append(self.end[inside[starts]])
                least.append(np.minimum.reduceat(conv[inside], starts))
                members.append(counts)
                last.append(sizes[offsets[inside[starts]] + left + column])
                first = self.firsts[-1]
                self.end[inside] = np.repeat(np.arange(first, first + len(starts)), counts)
                self.firsts.append(first + len(starts))
        self.up, self.least = np.concatenate(up), np.concatenate(least)
        self.members, self.bytes = np.concatenate(members), np.concatenate(last)
        self.depth = np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))

    def path_to(self, node: int) -> list[int]:
        """Nodes from the root to this one."""
        found = []
        while node >= 0:
            found.append(node)
            node = int(self.up[node])
        return found[::-1]

    def sums(self, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children, leaves and saved bytes below each node, without what edge nodes themselves count."""
        inner = ~edge
        children = np.bincount(self.up[1:][inner[1:]], minlength=len(self.up))
        leaves = ((np.bincount(self.up[1:], minlength=len(self.up)) == 0) & inner).astype(np.int64)
        saved = np.where(inner, (self.members - 1) * self.bytes, 0)
        for first, after in zip(self.firsts[-2:0:-1], self.firsts[:1:-1]):
            # Children of one node are neighbours.
            parents = self.up[first:after]
            starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
            for values in (leaves, saved):
                values[parents[starts]] += np.add.reduceat(values[first:after], starts)
        return children, leaves, saved


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [batch for batch in batches if batch.num_rows]
    if not batches:
        return
    shard = TaskContext.get().partitionId()
    conv = np.concatenate([np.asarray(batch["conv_id"]) for batch in batches])
    paths = [path for batch in batches for path in batch["path"].cast(pa.binary()).to_pylist()]
    lengths = np.array([len(path) // CODE for path in paths])
    trie = Trie(conv, np.frombuffer(b"".join(paths), np.uint8).reshape(-1, CODE), lengths)

    ranked = lambda row: (paths[row], int(conv[row]))
    ends = [min(range(len(paths)), key=ranked), max(range(len(paths)), key=ranked)]
    edge = np.zeros(len(trie.up), bool)
    side_of = np.zeros(len(trie.up), np.int64)
    keys: dict[int, bytes] = {}
    edges = []
    for side, row in enumerate(ends):
        digest = hashlib.blake2b(digest_size=16)
        above = None
        for depth, node in enumerate(trie.path_to(int(trie.end[row]))):
            if depth:
                digest.update(paths[row][(depth - 1) * CODE : depth * CODE])
            key = digest.copy().digest()
            # A node on both paths counts on the first.
            edges.append((side, depth, node, key, above, node not in keys))
            if node not in keys:
                keys[node], edge[node], side_of[node] = key, True, side
            above = key
    children, leaves, saved = trie.sums(edge)

    order = np.lexsort((conv, trie.end))
    starts = np.flatnonzero(np.concatenate([[True], np.diff(trie.end[order]) != 0]))
    listed = np.full(len(trie.up), _NOBODY, object)
    pieces = []
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        node = int(trie.end[order[start]])
        if not edge[node]:
            listed[node] = hashlib.sha256(",".join(map(str, conv[order[start:stop]].tolist())).encode()).hexdigest()
            continue
        for part, at in enumerate(range(start, stop, LISTED)):
            names = ",".join(map(str, conv[order[at : min(stop, at + LISTED)]].tolist()))
            pieces.append({"kind": "ends", "shard": shard, "side": part, "key": keys[node], "ends": names})

    inner = np.flatnonzero(~edge)
    parent = trie.up[inner]
    loose = edge[parent] if len(inner) else np.zeros(0, bool)
    count = len(inner)
    none = pa.nulls(count, pa.binary())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(["node"] * count, pa.string()),
            pa.array(np.full(count, shard), pa.int32()),
            pa.array(side_of[parent], pa.int32(), mask=~loose),
            pa.array(trie.depth[inner], pa.int64()),
            none,
            none,
            pa.array(trie.least[inner], pa.int64()),
            pa.array(trie.least[parent], pa.int64(), mask=loose),
            pa.array(trie.bytes[inner], pa.int64()),
            pa.array(trie.members[inner], pa.int64()),
            pa.array(children[inner], pa.int64()),
            pa.array(leaves[inner], pa.int64()),
            pa.array(saved[inner], pa.int64()),
            pa.array(listed[inner].tolist(), pa.string()),
        ],
        schema=_SCHEMA,
    )
    rows = [
        {
            "kind": "edge", "shard": shard, "side": side, "depth": depth, "key": key, "up_key": above,
            "conv_id": int(trie.least[node]), "bytes": int(trie.bytes[node]),
            "n_convs": int(trie.members[node]) * fresh, "n_children": int(children[node]) * fresh,
            "n_leaves": int(leaves[node]) * fresh, "saved_tokens": int(saved[node]) * fresh,
        }
        for side, depth, node, key, above, fresh in edges
    ]
    for start in range(0, len(rows), 5000):
        yield pa.RecordBatch.from_pylist(rows[start : start + 5000], schema=_SCHEMA)
    for piece in pieces:
        yield pa.RecordBatch.from_pylist([piece], schema=_SCHEMA)


_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (x.split() for x in _PARTS.split(", "))])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each key's id list; its pieces arrive in order and none is kept."""
    held, digest = None, None

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([held], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends"]
        )

    for batch in batches:
        for key, names in zip(batch["key"].to_pylist(), batch["ends"].to_pylist()):
            if key != held:
                if held is not None:
                    yield done()
                held, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(names.encode())
    if held is not None:
        yield done()


def _recombined(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edge nodes by key, and each slot (shard, side, depth) with its node's smallest member."""
    slots = parts.where("kind = 'edge'").select(
        "shard", "side", "depth", "key", "up_key", "conv_id", "bytes", "n_convs", "n_children", "n_leaves", "saved_tokens"
    )
    merged = slots.groupBy("key").agg(
        F.max("up_key").alias("up_key"),
        F.max("depth").alias("depth"),
        F.max("bytes").alias("bytes"),
        F.min("conv_id").alias("conv_id"),
        F.min(F.struct("shard", "side")).alias("owner"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = land(merged, "edges")
    more = merged.groupBy(F.col("up_key").alias("of")).agg(F.count(F.lit(1)).alias("more"))
    merged = merged.join(more, F.col("key") == F.col("of"), "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    )
    merged = land(merged.drop("of", "more"), "edges")
    # Each edge node adds its own part to one path, its owner's; a node's subtree is then
    # the sum, over the paths through it, of what they own from its depth on.
    own = merged.select(
        F.col("key").alias("of"),
        F.col("owner.shard").alias("own_shard"),
        F.col("owner.side").alias("own_side"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saving"),
    )
    placed = slots.select("shard", "side", "depth", "key").join(
        own,
        (F.col("key") == F.col("of")) & (F.col("shard") == F.col("own_shard")) & (F.col("side") == F.col("own_side")),
        "left",
    )
    deeper = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))
    below = placed.select(
        "key",
        F.sum(F.coalesce("leaf", F.lit(0))).over(deeper).alias("leaf"),
        F.sum(F.coalesce("saving", F.lit(0))).over(deeper).alias("saving"),
    )
    below = below.groupBy(F.col("key").alias("of")).agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    nodes = merged.join(below, F.col("key") == F.col("of")).withColumns(
        {"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") + F.col("saving")}
    )
    nodes = land(nodes.drop("of", "leaf", "saving", "owner"), "edges")
    names = nodes.select(F.col("key").alias("of"), F.col("conv_id").alias("slot_conv"))
    named = slots.select(F.col("shard").alias("slot_shard"), F.col("side").alias("slot_side"),
                         (F.col("depth") + 1).alias("slot_depth"), "key")
    named = named.join(names, F.col("key") == F.col("of")).drop("of", "key")
    return nodes, land(named, "slots")


def prefix_trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path of turn codes).

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.  A conversation without turns is a
    member of the root; no conversations have no nodes.  A path is one value, so a
    conversation may have up to about 100 million turns.  The id list of one node is
    hashed in order by one task, which reads it piece by piece and keeps none.
    """
    paths = land(paths, "rebuilt")
    spark = paths.sparkSession
    total = paths.agg(F.sum(F.octet_length("path") + 16)).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-total // shard_bytes))
    dealt = paths.repartitionByRange(shards, "path", "conv_id")
    parts = land(dealt.mapInArrow(_sharded, _PARTS), "parts")
    edges, slots = _recombined(parts)

    pieces = parts.where("kind = 'ends'").select("key", "shard", "side", "ends")
    pieces = pieces.repartition("key").sortWithinPartitions("key", "shard", "side").select("key", "ends")
    ends = pieces.mapInArrow(_listed, "key binary, ends string")
    parents = edges.select(F.col("key").alias("of"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    outer = (
        edges.join(parents, F.col("up_key") == F.col("of"), "left")
        .drop("of")
        .join(ends, "key", "left")
        .select(*columns, F.coalesce("ends", F.lit(_NOBODY)).alias("ends_sha256"))
    )
    inner = parts.where("kind = 'node'")
    at = (
        (F.col("shard") == F.col("slot_shard"))
        & (F.col("side") == F.col("slot_side"))
        & (F.col("depth") == F.col("slot_depth"))
    )
    inner = inner.join(slots, at, "left").withColumn("parent_conv_id", F.coalesce("up_conv", "slot_conv"))
    return outer.unionByName(inner.select(*columns, F.col("ends").alias("ends_sha256")))
