"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into equal cells.  A document's cell comes from its text's hash,
so equal texts start at one place; each shard holds many virtual nodes on the
ring.  A cell's rows go to the first shard clockwise that has room, and what
overflows a full shard walks on.  A shard's bound is its exact share of the rows,
so counts differ by one at most, while most rows stay where the ring alone
would have put them.

Only counts per cell take part in the walk: a table of ``cells`` rows however
many documents there are.  It yields slices (cell, from rank, to rank) -> (shard,
first slot).  A row then needs its rank within its cell, for which every cell is
cut into ``parts`` by a hash of the row, counted, and ranked part by part, so
that a text with a third of all rows is ranked by many tasks.  Rows travel as a
few numbers; no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import bytes_of, crc_of, land, let

SHARDS = 16
NODES = 32  # virtual nodes of a shard
CELLS = 1024
PARTS = 64


def _cell(key: Column, cells: int) -> Column:
    return F.pmod(key, F.lit(cells)).cast("int")


def ring(shards: int, nodes: int, cells: int) -> Column:
    """The virtual nodes as an array of (cell, tie, shard), clockwise."""

    def node(i: Column) -> Column:
        place = F.xxhash64(F.lit("node"), i % shards, F.floor(i / shards))
        return F.struct(
            _cell(place, cells).alias("cell"), place.alias("tie"), (i % shards).cast("int").alias("shard")
        )

    return F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(shards * nodes - 1)), node))


def walk(counts: DataFrame, shards: int = SHARDS, nodes: int = NODES, cells: int = CELLS) -> DataFrame:
    """Slices of the cells: (cell, begin, end, shard, slot), from counts (cell, n).

    One row of ``cells`` counts is folded from cell zero on; the state is each
    shard's room.  Slices of no rows are not made.
    """
    total = F.aggregate("loads", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    share, over = F.floor(total / shards), total % shards
    quota = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: (share + F.when(i < over, 1).otherwise(0)).cast("long"),
    )
    empty = F.array().cast("array<struct<cell:int,begin:bigint,end:bigint,shard:int,slot:bigint>>")

    def clockwise(around: Column, cell: Column) -> Column:
        """Distinct shards in the order in which the ring meets them from a cell on."""
        start = F.size(F.filter(around, lambda node: node["cell"] < cell))
        owners = F.transform(around, lambda node: node["shard"])
        ahead = F.slice(owners, start + 1, F.lit(shards * nodes))
        return F.array_distinct(F.concat(ahead, F.slice(owners, F.lit(1), start)))

    def offer(state: Column, shard: Column, load: Column) -> Column:
        """The shard takes what it has room for; the rest stays for the next one."""
        room = F.element_at(state["room"], shard + 1)
        taken = F.least(room, state["left"])
        begin = load["n"] - state["left"]
        piece = F.struct(
            load["cell"].alias("cell"),
            begin.alias("begin"),
            (begin + taken).alias("end"),
            shard.alias("shard"),
            (F.element_at(state["quota"], shard + 1) - room).alias("slot"),
        )
        return F.when(
            taken > 0,
            F.struct(
                F.transform(
                    state["room"], lambda x, i: F.when(i == shard, x - taken).otherwise(x)
                ).alias("room"),
                state["quota"].alias("quota"),
                (state["left"] - taken).alias("left"),
                F.concat(state["pieces"], F.array(piece)).alias("pieces"),
            ),
        ).otherwise(state)

    def fill(state: Column, load: Column) -> Column:
        begun = F.struct(
            state["room"].alias("room"),
            state["quota"].alias("quota"),
            load["n"].alias("left"),
            state["pieces"].alias("pieces"),
        )
        return F.aggregate(load["shards"], begun, lambda inner, shard: offer(inner, shard, load))

    loads = counts.agg(F.array_sort(F.collect_list(F.struct("cell", "n"))).alias("loads"))
    ways = let(
        ring(shards, nodes, cells),
        lambda around: F.transform(
            "loads",
            lambda x: F.struct(
                x["cell"].alias("cell"), x["n"].alias("n"), clockwise(around, x["cell"]).alias("shards")
            ),
        ),
    )
    walked = loads.select(quota.alias("quota"), ways.alias("loads"))
    start = F.struct(
        F.col("quota").alias("room"),
        F.col("quota").alias("quota"),
        F.lit(0).cast("long").alias("left"),
        empty.alias("pieces"),
    )
    folded = walked.select(F.aggregate("loads", start, fill)["pieces"].alias("pieces"))
    return folded.select(F.explode("pieces").alias("piece")).select("piece.*")


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    nodes: int = NODES,
    cells: int = CELLS,
    parts: int = PARTS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    ``size`` is the text's bytes plus one.  Null texts are like empty ones, rows
    without doc_id and repeated rows are rows like others, ties among equal rows
    are broken arbitrarily between rows that cannot be told apart.  No documents,
    no rows; further columns are not read.
    """
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    spread = F.pmod(F.xxhash64(docs["doc_id"], F.lit("part")), F.lit(parts)).cast("int")
    rows = land(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            (bytes_of(docs["text"]) + 1).alias("size"),
            crc_of(docs["text"]).alias("text_crc32"),
            key.alias("key"),
            _cell(key, cells).alias("cell"),
            spread.alias("part"),
        ),
        "shard_keys",
    )
    counts = land(rows.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n")), "shard_counts")
    pieces = walk(counts.groupBy("cell").agg(F.sum("n").alias("n")), shards, nodes, cells)
    pieces = land(pieces, "shard_slices")
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("cell", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("cell", "part").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["cell", "part"])
    ranked = ranked.withColumn("rank", F.col("nth") + F.col("ahead"))
    # At most cells * shards slices, whatever the data: small enough to send to all.
    slices = F.broadcast(pieces.withColumnRenamed("cell", "at"))
    placed = ranked.join(
        slices,
        (F.col("cell") == F.col("at")) & (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("end")),
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("slot") + F.col("rank") - F.col("begin")).alias("slot"),
    )
