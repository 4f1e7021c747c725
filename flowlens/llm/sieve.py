"""Bitmaps of a bounded size that say which hashes cannot matter, so their rows need no shuffle.

A sieve has a bit for each bucket of hashes.  A bit is set where a hash fell that counts; a
hash whose bit is not set is surely none of those, one whose bit is set may be.  What
passes is always looked at exactly afterwards.  The size is bounded: with more and more
hashes a sieve lets more and more through, in the end all, and never stops a row that
counts.  So it may be sent to all tasks whatever the size of the corpus.  Which hashes
occur twice is found by 42 bits of each before any bit is set, so that hashes that
occur once do not fill the sieve.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import drop_landed, land

# Buckets are 2**BITS, so a sieve has 8 MB; a block of 2**BLOCK buckets is put together by one task.
BITS = 26
BLOCK = 20
# To tell which hashes occur twice, they are dealt by their first DEAL bits, and told apart by these and the 32 that follow.
DEAL = 10
# Buckets a repeated hash at least, so that few others pass, and bounds of the sieve's size: 128 kB and 64 MB.
ROOM = 64
LEAST_BITS, MOST_BITS = 20, 29
# Hashes that a task gathers before it deals them out.
RUN = 1 << 20
_ROWS = "block int, buckets binary"


def bucket_of(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Buckets of 64-bit hashes."""
    return (hashes.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _batch(blocks: list[int] | np.ndarray, parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(parts, pa.binary())], names=["block", "buckets"])


def _rows(buckets: np.ndarray, low: int) -> Iterator[pa.RecordBatch]:
    buckets.sort()
    blocks = buckets >> low
    starts = np.flatnonzero(np.diff(blocks, prepend=-1))
    inside = (buckets & ((1 << low) - 1)).astype("<u4")
    yield _batch(blocks[starts], [inside[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(inside)])])


def dealt(batches: Iterable[np.ndarray], bits: int = BITS, low: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Rows (block, buckets) of arrays of hashes; a bucket counts once for each time it occurs."""
    held, count = [], 0
    for hashes in batches:
        held.append(bucket_of(hashes, bits))
        count += len(hashes)
        if count >= RUN:
            yield from _rows(np.concatenate(held), low)
            held, count = [], 0
    if count:
        yield from _rows(np.concatenate(held), low)


def dealt_whole(batches: Iterable[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of arrays of hashes for ``repeats``."""
    yield from dealt(batches, DEAL + 32, 32)


def _put_together(rows: DataFrame, fresh) -> DataFrame:
    """One row (block, buckets) of each block: what ``fresh()`` gives, after it was called with all of the block's buckets."""

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block_of = None, None
        for batch in batches:
            for block, raw in zip(batch["block"].to_pylist(), batch["buckets"]):
                if block != held:
                    if held is not None:
                        yield _batch([held], [block_of.packed()])
                    held, block_of = block, fresh()
                block_of.add(np.frombuffer(raw.as_buffer(), "<u4"))
        if held is not None:
            yield _batch([held], [block_of.packed()])

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(put_together, _ROWS)


class _Marked:
    """The bits of a block's buckets."""

    def __init__(self, bits: int = BLOCK):
        self.marks = np.zeros(1 << bits, bool)

    def add(self, buckets: np.ndarray) -> None:
        self.marks[buckets] = True

    def packed(self) -> bytes:
        return np.packbits(self.marks, bitorder="little").tobytes()


class _Repeated:
    """The numbers of a block that were added twice or more, each once; memory follows the distinct ones."""

    def __init__(self):
        self.once = self.twice = np.zeros(0, np.uint32)
        self.new, self.count = [], 0

    def add(self, numbers: np.ndarray) -> None:
        self.new.append(numbers)
        self.count += len(numbers)
        if self.count > max(RUN, len(self.once)):
            self._fold()

    def _fold(self) -> None:
        numbers = np.concatenate([self.once, *self.new])
        numbers.sort()
        again = np.concatenate([[False], numbers[1:] == numbers[:-1]]) if len(numbers) else np.zeros(0, bool)
        self.once, self.twice = numbers[~again], np.union1d(self.twice, numbers[again])
        self.new, self.count = [], 0

    def packed(self) -> bytes:
        self._fold()
        return self.twice.astype("<u4").tobytes()


def _gathered(rows: DataFrame, bits: int, blocks: int) -> np.ndarray:
    """The sieve whose packed blocks are in ``rows``: as large as ``bits`` says, whatever the corpus is."""
    whole = np.zeros(1 << (bits - 3), np.uint8)
    size = len(whole) // blocks
    found = rows.toArrow()
    for block, packed in zip(found["block"].to_pylist(), found["buckets"]):
        whole[block * size : (block + 1) * size] = np.frombuffer(packed.as_buffer(), np.uint8)
    return whole


def sieve_of(rows: DataFrame) -> np.ndarray:
    """The packed bits of the buckets that occur in rows of ``dealt``."""
    return _gathered(_put_together(rows, _Marked), BITS, 1 << (BITS - BLOCK))


def sieve_of_repeated(rows: DataFrame) -> np.ndarray:
    """Sieve of the hashes that occur twice or more in rows of ``dealt_whole``.

    Only those are marked, so what else passes follows their number and the sieve's size, which
    follows it too, and not the number of hashes.
    """
    repeated = land(_put_together(rows, _Repeated), "repeated")
    count = (repeated.agg(F.sum(F.octet_length("buckets"))).first()[0] or 0) // 4
    bits = min(MOST_BITS, max(LEAST_BITS, (ROOM * count).bit_length()))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch["block"].to_pylist(), batch["buckets"]):
                block_of = _Marked(bits - DEAL)
                block_of.add(np.frombuffer(raw.as_buffer(), "<u4") >> (32 - bits + DEAL))
                yield _batch([block], [block_of.packed()])

    sieve = _gathered(repeated.mapInArrow(marked, _ROWS), bits, 1 << DEAL)
    drop_landed(repeated)
    return sieve


def may_hold(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one of those that the sieve was made of."""
    buckets = bucket_of(hashes, (len(sieve) << 3).bit_length() - 1)
    return (sieve[buckets >> 3] >> (buckets & 7).astype(np.uint8) & 1).astype(bool)


def sieve_of_column(frame: DataFrame, column: str) -> np.ndarray:
    """Sieve of a column of 64-bit hashes."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt(np.asarray(batch[column], dtype=np.int64) for batch in batches)

    return sieve_of(frame.select(F.col(column)).mapInArrow(hashes, _ROWS))
