"""Near-duplicate documents by SimHash over a segment-popcount embedding.

A fingerprint of 64 bits is cut into 32 segments of two bits.  The vector of the
segments' bit counts is an embedding in which the Manhattan distance is never
larger than the number of differing bits.  So two fingerprints that differ in at
most ``most`` bits lie within that Manhattan distance, and a range join on a grid
of the embedding finds them: the 32 dimensions form ``blocks`` groups, and as
every unit of distance touches one group only, some ``blocks - most`` groups
agree entirely.  Each combination of so many groups is one grid whose cells are
the points of that subspace; fingerprints meet in a common cell, are held against
the Manhattan bound, and then compared bit by bit.

Only components are wanted, so the fingerprints of a cell are first compared with its
smallest one: a dense cell becomes a star, as many links as fingerprints.  Then those are
compared whose components still differ, and what is kept of their links is which
components meet.  A pair is only kept in the first grid in which it meets.

Equal texts share a fingerprint and are joined by it before any search, so a
group of copies costs one row per grid however large it is.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import components, land
from flowlens.llm.overlap import Chosen, in_sieve, key_of, similar_texts
from flowlens.llm.sieve import sieve_of_column

SHINGLE = 4
SEED = 42
MOST = 4  # differing bits of a link
BLOCKS = 7
SEGMENTS = 32
EVEN = 0x5555555555555555
# Above this many hashes a byte histogram counts bits faster than unpacking them.
LONG_TEXT = 2000
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one text as a signed 64-bit integer; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
        stops = ends[shingle - 1 :].tolist()
        hashes = np.fromiter(
            (digest(joined[i:j], seed) for i, j in zip(begins, stops)), np.uint64, len(begins)
        )
    columns = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    if len(hashes) > LONG_TEXT:
        counts = np.concatenate(
            [np.bincount(columns[:, i], minlength=256) @ _BITS_OF_BYTE for i in range(8)]
        )
    else:
        counts = np.unpackbits(columns, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(text) for text in texts], dtype="int64")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; a null text has fingerprint zero like an empty one."""
    return docs.select("doc_id", _fingerprint("text").alias("fp"))


def popcounts(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each in its own two bits."""
    upper = F.shiftrightunsigned(fp, 1)
    ones = fp.bitwiseXOR(upper).bitwiseAND(F.lit(EVEN))
    twos = fp.bitwiseAND(upper).bitwiseAND(F.lit(EVEN))
    return ones.bitwiseOR(F.shiftleft(twos, 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed vectors of counts from 0 to 2.

    Per segment the counts' exclusive or is 01 or 11 at distance one and 10 at two.
    """
    apart = a.bitwiseXOR(b)
    low = apart.bitwiseAND(F.lit(EVEN))
    high = F.shiftrightunsigned(apart, 1).bitwiseAND(F.lit(EVEN))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """Bits of each group of segments."""
    cuts = [round(i * SEGMENTS / blocks) for i in range(blocks + 1)]
    return [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:])]


def _points(distinct: DataFrame, most: int, blocks: int) -> DataFrame:
    """Each fingerprint once per grid: own (the grid), upto, cell and counts beside its columns.

    Spark sizes these rows as if there were one a fingerprint and not one a grid, so joins of
    them name the merge join: they would else be sent to the driver and to all executors.
    """
    if blocks <= most:
        raise ValueError("more groups of segments than differing bits are needed")
    masks = block_masks(blocks)
    grids = []
    for chosen in combinations(range(blocks), blocks - most):
        mask = sum(masks[i] for i in chosen)
        own = sum(1 << i for i in chosen)
        upto = (2 << chosen[-1]) - 1  # groups up to the last chosen one
        cell = F.col("counts").bitwiseAND(F.lit(_signed(mask)))
        grids.append(F.struct(F.lit(own).alias("own"), F.lit(upto).alias("upto"), cell.alias("cell")))
    points = distinct.withColumn("counts", popcounts(F.col("fp")))
    return points.select("*", F.explode(F.array(*grids)).alias("grid")).select(*points.columns, "grid.*")


def _near(a: Column, b: Column, most: int) -> Column:
    """Within the Manhattan bound, and then by the bits themselves."""
    return (manhattan(popcounts(a), popcounts(b)) <= most) & (F.bit_count(a.bitwiseXOR(b)) <= most)


def star_links(distinct: DataFrame, most: int = MOST, blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) of each cell's fingerprints to the cell's smallest, b."""
    points = _points(distinct.select("fp"), most, blocks)
    cells = points.groupBy("own", "cell").agg(F.min("fp").alias("b"), F.max("fp").alias("last"))
    cells = cells.where("b <> last").drop("last")
    joined = points.join(cells.hint("merge"), ["own", "cell"]).where(F.col("fp") != F.col("b"))
    return joined.where(_near(F.col("fp"), F.col("b"), most)).select(F.col("fp").alias("a"), "b").distinct()


def _meetings(rooted: DataFrame, most: int, blocks: int) -> DataFrame:
    """Rows a and b of ``rooted`` (fp, root) that are near and of different roots, each pair once."""
    points = _points(rooted, most, blocks)
    masks = block_masks(blocks)
    a, b = points.alias("a"), points.alias("b")
    apart = F.col("a.counts").bitwiseXOR(F.col("b.counts"))
    agreed = sum(
        (
            F.when(apart.bitwiseAND(F.lit(_signed(mask))) == 0, F.lit(1 << i)).otherwise(F.lit(0))
            for i, mask in enumerate(masks)
        ),
        F.lit(0),
    )
    return a.join(
        b.hint("merge"),
        (F.col("a.own") == F.col("b.own"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.col("a.root") != F.col("b.root"))
        & (manhattan(F.col("a.counts"), F.col("b.counts")) <= most)
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= most)
        & (agreed.bitwiseAND(F.col("a.upto")) == F.col("a.own")),
    )


def near_links(distinct: DataFrame, most: int = MOST, blocks: int = BLOCKS) -> DataFrame:
    """All pairs (a, b) of different fingerprints that differ in at most ``most`` bits."""
    alone = distinct.select("fp", F.col("fp").alias("root"))
    return _meetings(alone, most, blocks).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def meeting_roots(rooted: DataFrame, most: int = MOST, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (a, b) of different roots that have near fingerprints; ``rooted`` is (fp, root)."""
    met = _meetings(rooted, most, blocks)
    return met.select(F.col("a.root").alias("a"), F.col("b.root").alias("b")).distinct()


def near_components(distinct: DataFrame, most: int = MOST, blocks: int = BLOCKS) -> DataFrame:
    """(node, root) of every fingerprint that is near to another; ``root`` is the smallest reached."""
    stars = land(star_links(distinct, most, blocks), "stars")
    starred = land(components(stars), "star_roots")
    rooted = distinct.join(starred, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )
    # The stars' roots stand for their fingerprints, so that the second search has only those that meet.
    meetings = land(meeting_roots(land(rooted, "rooted"), most, blocks), "meetings")
    joined = land(components(meetings), "joined_roots")
    over = joined.select(F.col("node").alias("from"), F.col("root").alias("to"))
    moved = starred.join(over, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"))
    alone = joined.join(starred.select(F.col("node").alias("starred")), F.col("node") == F.col("starred"), "left_anti")
    return moved.unionByName(alone)


def near_duplicates(docs: DataFrame, most: int = MOST, blocks: int = BLOCKS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), root (long) and component_id.

    Texts: null and blank ones have fingerprint zero and link like any other.
    Repeated rows stay repeated.  ``root`` is the component's smallest fingerprint,
    ``component_id`` its smallest doc_id; rows without a doc_id take part, and a
    component of such rows alone has none.  An empty table gives no rows; further
    columns are not read.
    """
    rows = land(fingerprints(docs), "fingerprints")
    distinct = land(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = near_components(distinct.select("fp"), most, blocks).withColumnRenamed("root", "low")
    named = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "first", F.coalesce("low", "fp").alias("root")
    )
    named = land(named, "named")
    least = land(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    classes = land(named.join(least, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_texts(docs: DataFrame, chosen: Chosen | None = None) -> DataFrame:
    """Pairs (a, b) of texts, named by ``key_of``, whose fingerprints are in one component.

    The texts are those of ``docs`` (text, and mark with ``chosen``) that are chosen.  Each is
    linked to the smallest of its component, so there are fewer links than texts.
    """
    chosen = chosen or Chosen()

    @F.pandas_udf(T.LongType())
    def chosen_fingerprint(texts: pd.Series, marks: pd.Series) -> pd.Series:
        found = [fingerprint_of(text) if one else None for text, one in zip(texts, chosen.of(marks))]
        return pd.Series(found, dtype="Int64")

    mark = docs["mark"] if chosen.sent else F.lit(0)
    rows = docs.select(key_of(docs["text"]).alias("key"), chosen_fingerprint(docs["text"], mark).alias("fp"))
    rows = land(rows.where("fp is not null"), "text_fingerprints")
    found = near_components(land(rows.select("fp").distinct(), "distinct"))
    placed = rows.join(found, rows["fp"] == found["node"], "left").select("key", F.coalesce("root", "fp").alias("of"))
    placed = land(placed, "placed_texts")
    heads = placed.groupBy("of").agg(F.min("key").alias("a"), F.max("key").alias("last")).where("a <> last")
    links = placed.join(heads, "of").where("key <> a").select("a", F.col("key").alias("b")).distinct()
    return land(links, "near_texts")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest doc_id.

    Components link texts with a five-word shingle similarity of 0.8 or more.  Those whose
    fingerprints differ in at most ``MOST`` bits are found by the grids (``near_texts``) and
    compared; as four bits stand for a similarity far above 0.8, an exact join
    (``overlap.similar_texts``) finds the links of the texts that are then still apart.  One row stays of each component, also
    where it occurs several times, where its doc_id has several texts in the component or
    one in another component, and where no row has a doc_id.  Null texts are alike.  An
    empty table stays empty; all columns stay as they are, whatever their names.

    Of copies, one is searched for near-duplicates; a fixed bitmap (``sieve``) of these
    tells the others.  Most rows stay: another one, of the rows in doubt, tells which stay for
    certain, so only the others are shuffled.
    """
    named = docs.select(key_of(docs["text"]).alias("key"), docs["doc_id"].alias("id"))
    groups = land(named.groupBy("key", "id").agg(F.count(F.lit(1)).alias("rows")), "groups")
    mark = F.xxhash64("key", "id")
    row = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
    rows = docs.select(row, key_of(docs["text"]).alias("key"), docs["doc_id"].alias("id"))
    first = groups.groupBy("key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("one"))
    first = first.select("key", "one.id").select(mark.alias("mark"))
    chosen = Chosen(docs.sparkSession.sparkContext.broadcast(sieve_of_column(first, "mark")))
    searched = rows.select(F.col("row.text").alias("text"), mark.alias("mark"))
    found = land(similar_texts(searched, chosen, near_texts(searched, chosen)), "similar")
    # The smallest doc_id of a component, with the smallest of its texts; null comes last.
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    best = groups.join(found.hint("merge"), groups["key"] == found["node"], "left")
    best = best.groupBy(F.coalesce("root", "key").alias("of")).agg(F.min(rank).alias("best"))
    best = best.select(F.col("best.key").alias("kept"), F.col("best.id").alias("kept_id"))
    same = (F.col("key") == F.col("kept")) & F.col("id").eqNullSafe(F.col("kept_id"))
    stays = groups.join(best.hint("merge"), same, "left").select("key", "id", "rows", F.col("kept").isNotNull().alias("stays"))
    doubtful = land(stays.where("not stays or rows > 1").select("key", "id", "stays"), "doubtful")

    rows = rows.withColumn("doubt", in_sieve(docs, doubtful.select(mark.alias("mark")))(mark))
    certain = rows.where(~F.col("doubt")).select("row.*")
    left = doubtful.select(F.col("key").alias("at"), F.col("id").alias("at_id"), "stays")
    doubted = rows.where("doubt").join(
        left.hint("merge"), (F.col("key") == F.col("at")) & F.col("id").eqNullSafe(F.col("at_id")), "left"
    )
    doubted = land(doubted.where("stays or stays is null").select("row", "key", "id", "stays"), "doubted")
    cleared = doubted.where("stays is null").select("row.*")
    once = doubted.where("stays").groupBy("key", "id").agg(F.first("row").alias("row")).select("row.*")
    return certain.unionByName(cleared).unionByName(once)
