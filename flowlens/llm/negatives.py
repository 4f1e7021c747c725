"""Hard negatives by exact integer products, several candidates to one multiplication.

A component is ``floor(256 * x)``, so a score is an inner product of integers.  The
components of several candidates are biased to be non-negative and laid side by side
in the separated fields of one wide integer (Kronecker packing).  One multiplication
of that integer by an anchor's component multiplies every candidate in it; the sums
over all components cannot leave their fields, so the scores are cut out exactly.

The wide integer has up to 53 bits and is held in a double: products and sums of such
integers are exact there, and a matrix product does them for many anchors at once.
Components that need more go through Python's unbounded integers in the same way.

Anchors are a fiftieth of the rows.  They are cut into slices of a bounded size; each
slice is sent to all tasks and held against every row, block by block.  Only the best
few rows of each block leave a task, so no pair table ever exists.  A first pass finds
the positives; the second searches below their scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import land

EVERY = 50  # rows whose id is divisible by this are anchors
POSITIVES = 5
NEGATIVES = 3
# Bounds of a negative's score in hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
MANTISSA = 53
# Bytes of one slice of anchors, and rows of a block of candidates.
SLICE_BYTES = 8 << 20
BLOCK = 4096

_PAIRS = "anchor long, anchor_id long, positive_id long, positive_score long"
_FOUND = f"{_PAIRS}, place long, negative_id long, negative_score long"


def relabelled(vec_id: Column, label: Column, every: int = 7, labels: int = 10) -> Column:
    """The next label, cyclically, where the id is divisible by ``every``."""
    return F.when(vec_id % every == 0, (label + 1) % labels).otherwise(label)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select("vec_id", "label", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole
    )


class Packed:
    """Candidates of one length, packed for products with anchors of at most ``largest`` components."""

    def __init__(self, candidates: np.ndarray, largest: np.ndarray):
        self.rows, self.width = candidates.shape
        self.bias = -candidates.min(axis=0) if self.rows else np.zeros(self.width)
        shifted = candidates + self.bias
        # No sum of a field leaves [-reach, reach].
        reach = sum(int(a) * int(b) for a, b in zip(largest, shifted.max(axis=0) if self.rows else largest))
        self.reach = reach
        self.bits = max(1, (2 * reach + 1).bit_length())
        self.fields = max(1, MANTISSA // self.bits)
        self.wide = self.bits > MANTISSA
        kind = object if self.wide else np.float64
        if self.wide:
            self.fields = 8
            shifted = np.array([[int(x) for x in row] for row in shifted], dtype=object).reshape(shifted.shape)
        words = -(-self.rows // self.fields)
        padded = np.zeros((words * self.fields, self.width), dtype=kind)
        padded[: self.rows] = shifted
        # Candidate w * fields + f lies in field f of word w.
        self.words = np.zeros((self.width, words), dtype=kind)
        for field in range(self.fields):
            unit = 1 << (self.bits * field)
            self.words += padded[field :: self.fields].T * (unit if self.wide else float(unit))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, one row per anchor, as integers."""
        if self.wide:
            anchors = np.array([[int(x) for x in row] for row in anchors], dtype=object).reshape(anchors.shape)
            bias = np.array([int(x) for x in self.bias], dtype=object)
        else:
            bias = self.bias
        count = len(anchors)
        products = (anchors @ self.words).reshape(count, -1)
        offset = sum(self.reach << (self.bits * field) for field in range(self.fields))
        mask = (1 << self.bits) - 1
        if self.wide:
            products = products + offset
        else:
            products = products.astype(np.int64) + offset
        out = np.empty((count, products.shape[1], self.fields), dtype=products.dtype)
        for field in range(self.fields):
            out[:, :, field] = (products >> (self.bits * field)) & mask
        out = out.reshape(count, -1)[:, : self.rows]
        back = (anchors @ bias).reshape(count, 1) if self.width else np.zeros((count, 1))
        if not self.wide:
            return out - (back.astype(np.int64) + self.reach)
        exact = out - (back + self.reach)
        if exact.size and max(abs(int(exact.max())), abs(int(exact.min()))) >= 1 << 63:
            raise OverflowError("a score does not fit a long")
        return exact.astype(np.int64)


class _Block:
    """Candidates ordered by label and id: ids, labels and components."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, width: int):
        sizes = np.asarray(batch["embedding"].combine_chunks().value_lengths(), dtype=np.int64)
        flat = batch["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        chosen = np.flatnonzero(sizes == width)
        at = starts[chosen, None] + np.arange(width)
        ids = np.asarray(batch["vec_id"], dtype=np.int64)[chosen]
        labels = np.asarray(batch["label"], dtype=np.int64)[chosen]
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        flat = flat.astype(np.float64) if len(flat) else np.zeros(0)
        self.values = np.floor(256.0 * flat[at[order]]).reshape(len(chosen), width)


def _blocks(batches: Iterator[pa.RecordBatch], width_of: set[int]) -> Iterator[tuple[int, _Block]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            table = pa.Table.from_batches([batch.slice(start, BLOCK)])
            for width in sorted(width_of):
                block = _Block(table, width)
                if len(block.ids):
                    yield width, block


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, ties by smaller id; ``ids`` ascend."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:most]


def _slices(anchors: DataFrame) -> Iterator[pa.Table]:
    """Landed anchors in slices of at most about ``SLICE_BYTES``, one at a time."""
    total = anchors.agg(F.sum(F.size("embedding") * 8 + 64)).first()[0] or 0
    count = -(-total // SLICE_BYTES)
    for number in range(count):
        chosen = F.pmod(F.xxhash64("anchor"), F.lit(count)) == number
        yield anchors.where(chosen).toArrow()


def _grouped(table: pa.Table) -> dict[int, dict[str, np.ndarray]]:
    """Anchors by vector length."""
    sizes = np.asarray(table["embedding"].combine_chunks().value_lengths(), dtype=np.int64)
    groups = {}
    for width in set(sizes.tolist()):
        part = table.filter(pa.array(sizes == width))
        flat = part["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        values = np.floor(256.0 * flat.astype(np.float64)).reshape(part.num_rows, width)
        groups[width] = {name: part[name].to_numpy() for name in part.column_names if name != "embedding"}
        groups[width]["values"] = values
    return groups


def _positives(rows: DataFrame, anchors: DataFrame, most: int) -> DataFrame:
    """(anchor, anchor_id, positive_id, positive_score): the first rows of the anchor's label."""
    parts = []
    for table in _slices(anchors):
        groups = _grouped(table)

        def search(batches, groups=groups):
            for width, block in _blocks(batches, set(groups)):
                own = groups[width]
                out = []
                bounds = np.flatnonzero(np.diff(block.labels, prepend=block.labels[0] - 1))
                for low, high in zip(bounds, np.append(bounds[1:], len(block.labels))):
                    asked = np.flatnonzero(own["label"] == block.labels[low])
                    if not len(asked):
                        continue
                    ids, values = block.ids[low:high], own["values"][asked]
                    scores = Packed(block.values[low:high], np.abs(values).max(axis=0)).scores(values)
                    for i, anchor in enumerate(asked):
                        others = np.flatnonzero(ids != own["anchor_id"][anchor])
                        found = others[_best(scores[i, others], ids[others], most)]
                        count = len(found)
                        out.append(
                            (
                                np.full(count, own["anchor"][anchor]),
                                np.full(count, own["anchor_id"][anchor]),
                                ids[found],
                                scores[i, found],
                            )
                        )
                yield _batch(out, 4, _PAIRS)

        parts.append(rows.mapInArrow(search, _PAIRS))
    found = _union(parts, rows, _PAIRS)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("place")


def _negatives(rows: DataFrame, asked: DataFrame, most: int) -> DataFrame:
    """The first rows of another label within the bounds of each anchor and positive."""
    parts = []
    for table in _slices(asked):
        groups = _grouped(table)

        def search(batches, groups=groups):
            for width, block in _blocks(batches, set(groups)):
                own = groups[width]
                packed = Packed(block.values, np.abs(own["values"]).max(axis=0))
                by_id = np.argsort(block.ids, kind="stable")
                out = []
                for start in range(0, len(own["anchor"]), 256):
                    scores = packed.scores(own["values"][start : start + 256])
                    for i in range(len(scores)):
                        a = start + i
                        ids, goals = own["positive_ids"][a], own["positive_scores"][a]
                        lows = -(-LOWEST * goals // 100)
                        highs = HIGHEST * goals // 100
                        row = scores[i]
                        near = (row >= lows.min()) & (row <= highs.max()) & (block.labels != own["label"][a])
                        places = by_id[near[by_id]]
                        if not len(places):
                            continue
                        places = places[np.argsort(-row[places], kind="stable")]
                        ranked = row[places]
                        begins = np.searchsorted(-ranked, -highs, side="left")
                        for place, (begin, low) in enumerate(zip(begins, lows)):
                            found = places[begin : begin + most]
                            found = found[row[found] >= low]
                            count = len(found)
                            if count:
                                out.append(
                                    (
                                        np.full(count, own["anchor"][a]),
                                        np.full(count, own["anchor_id"][a]),
                                        np.full(count, ids[place]),
                                        np.full(count, goals[place]),
                                        np.full(count, place),
                                        block.ids[found],
                                        row[found],
                                    )
                                )
                yield _batch(out, 7, _FOUND)

        parts.append(rows.mapInArrow(search, _FOUND))
    return _union(parts, rows, _FOUND)


def _batch(out: list[tuple], width: int, schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(",")]
    columns = [np.concatenate([row[i] for row in out]) if out else [] for i in range(width)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _union(parts: list[DataFrame], rows: DataFrame, schema: str) -> DataFrame:
    if not parts:
        return rows.sparkSession.createDataFrame([], schema)
    whole = land(parts[0], "found")
    for part in parts[1:]:
        whole = whole.unionByName(land(part, "found"))
    return whole


def hard_negatives(
    rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` holds vec_id, label and embedding (array of numbers); further columns are
    not read.  Anchors are the rows whose vec_id is divisible by ``every``.  An anchor's
    positives are the first other rows of its label, by score, ties by smaller id; for
    each, the negatives are the first rows of other labels whose score lies between 50
    and 95 hundredths of the positive's.  A negative positive_score has no such row.

    Rows with a null id, label or vector, or a null or non-finite component, take no
    part.  Vectors of different lengths have no score and are no partners; empty vectors
    score zero.  Repeated rows count as often as they occur, but an anchor that occurs
    several times is asked once, and no row of its id is its partner.  An empty table
    gives no rows.  A score that does not fit a long stops the query.
    """
    rows = usable(rows)
    marked = rows.where(F.col("vec_id") % every == 0).distinct()
    anchors = land(
        marked.select(
            F.monotonically_increasing_id().alias("anchor"),
            F.col("vec_id").alias("anchor_id"),
            F.col("label").cast("long").alias("label"),
            "embedding",
        ),
        "anchors",
    )
    found = _positives(rows, anchors, positives)
    pairs = found.groupBy("anchor").agg(
        F.collect_list("positive_id").alias("positive_ids"),
        F.collect_list("positive_score").alias("positive_scores"),
    )
    asked = land(anchors.join(pairs, "anchor"), "asked")
    # A repeated row may be two of an anchor's positives: each has a place of its own.
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = _negatives(rows, asked, negatives).withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
