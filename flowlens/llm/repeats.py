"""Removal of byte strings that occur more than once, by suffix arrays of what may repeat.

Every 400-byte string has a seed: the substring of 200 bytes with the smallest hash in
it, the leftmost of equals.  Equal strings have equal seeds at equal places, so a string
repeats only among the strings of its seed.  Neighbouring strings mostly share a seed;
a piece is the text of such a run, and the corpus is tiled with pieces once.

A seed that occurs once has no repeats.  A seed whose pieces are all equal repeats in
whole; equal pieces of other seeds do so too, and one of them stands for all.  Only
pieces that differ and share a seed need a closer look: they are the edges of copies.
Their texts are fetched, and the suffix array of a seed's pieces (``suffixes``) brings
equal strings together: neighbours in it that agree in 400 bytes are repeats.  As all
pieces of a suffix array hold the seed, and equal strings hold it at one place, one
symbol stands for it there.

A seed may be very frequent, such as a line that a third of all documents hold.  The
strings of such a seed are dealt by their place relative to it into halves, quarters
and so on; those of one part share a longer core, which makes a smaller group, at the
end the string itself.  So each suffix array covers a bounded group and nothing is left
out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import drop_landed, land
from flowlens.llm.suffixes import suffix_array

LENGTH = 400
SEED = 200
# Bytes of one suffix array at most, bytes of one task's groups, bytes hashed at a time.
GROUP_BYTES = 1 << 19
TASK_BYTES = 1 << 20
CHUNK = 1 << 19
_PLACE_BITS = 24
_WORD = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse

_PIECES = "key binary, pieces array<struct<start int, last int, upto int, at int, seed long, p1 long, p2 long>>"
_TEXTS = "seed long, key binary, start int, last int, at int, need boolean, p1 long, p2 long, piece binary"
_SPANS = "key binary, low int, high int"


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return values ^ (values >> np.uint64(32))


_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))


def _powers(factor: int, count: int) -> np.ndarray:
    steps = np.full(count, factor & _WORD, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_UP = _powers(_FACTOR, CHUNK + LENGTH + 2)
_DOWN = _powers(pow(_FACTOR, -1, 1 << 64), CHUNK + LENGTH + 2)


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each run of ``width``."""
    count, reach = len(values) - width + 1, 1
    while 2 * reach <= width:
        values = np.minimum(values[: len(values) - reach], values[reach:])
        reach *= 2
    return np.minimum(values[:count], values[width - reach : width - reach + count])


def seeds_of(text: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``length`` bytes, its seed's place; and the hash at each place."""
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_OF_BYTE[text] * _DOWN[: len(text)], out=sums[1:])
    count = len(text) - seed + 1
    hashes = _mixed((sums[seed:] - sums[:count]) * _UP[:count])
    ranked = (hashes & np.uint64(_WORD << _PLACE_BITS & _WORD)) | np.arange(count, dtype=np.uint64)
    least = _window_least(ranked, length - seed + 1)
    return (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64), hashes.view(np.int64)


def _digest(text: memoryview | bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _slices(texts: list) -> Iterator[list[tuple[int, int, memoryview]]]:
    """(text number, offset, bytes) in lots of about ``CHUNK``; long texts overlap at the cuts."""
    lot, held = [], 0
    for number, text in enumerate(texts):
        whole = memoryview(text)
        for offset in range(0, max(0, len(whole) - LENGTH + 1), CHUNK):
            part = whole[offset : offset + CHUNK + LENGTH - 1]
            if lot and held + len(part) > CHUNK + LENGTH:
                yield lot
                lot, held = [], 0
            lot.append((number, offset, part))
            held += len(part)
    if lot:
        yield lot


def _pieces_of(texts: list) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The text number of each piece, and its columns."""
    numbers, columns = [], {name: [] for name in ("start", "last", "upto", "at", "seed", "p1", "p2")}
    for lot in _slices(texts):
        joined = b"".join(part for _, _, part in lot)
        data = np.frombuffer(joined, np.uint8)
        place, hashes = seeds_of(data)
        sizes = np.array([len(part) for _, _, part in lot])
        begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        # Strings that cross from one slice to the next are none.
        counts = sizes - LENGTH + 1
        of = np.repeat(np.arange(len(lot)), counts)
        starts = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[of]
        chosen = place[starts]
        fresh = np.flatnonzero(np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(of) != 0)]))
        first, last = starts[fresh], starts[np.append(fresh[1:], len(starts)) - 1]
        own = of[fresh]
        view = memoryview(joined)
        ids = b"".join([_digest(view[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())])
        ids = np.frombuffer(ids, np.int64).reshape(-1, 2)
        # Equal pieces that follow each other, as in a run of one character, are one row.
        same = (ids[1:] == ids[:-1]).all(axis=1) & (own[1:] == own[:-1]) & (first[1:] == last[:-1] + 1)
        heads = np.flatnonzero(np.concatenate([[True], ~same]))
        ends = np.append(heads[1:], len(first)) - 1
        shift = np.array([offset for _, offset, _ in lot])[own[heads]] - begins[own[heads]]
        numbers.append(np.array([number for number, _, _ in lot])[own[heads]])
        columns["start"].append(first[heads] + shift)
        columns["last"].append(last[heads] + shift)
        columns["upto"].append(last[ends] + shift)
        columns["at"].append(chosen[fresh][heads] + shift)
        columns["seed"].append(hashes[chosen[fresh][heads]])
        columns["p1"].append(ids[heads, 0])
        columns["p2"].append(ids[heads, 1])
    if not numbers:
        return np.zeros(0, np.int64), {name: np.zeros(0, np.int64) for name in columns}
    return np.concatenate(numbers), {name: np.concatenate(parts) for name, parts in columns.items()}


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {name: pa.int32() for name in ("start", "last", "upto", "at")}
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        numbers, columns = _pieces_of(texts)
        counts = np.bincount(numbers, minlength=len(texts))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        pieces = pa.StructArray.from_arrays(
            [pa.array(values, kinds.get(name, pa.int64())) for name, values in columns.items()],
            names=list(columns),
        )
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces)
        yield pa.RecordBatch.from_arrays([batch["key"].cast(pa.binary()), lists], names=["key", "pieces"])


def _key(text: Column) -> Column:
    """Names a text by 128 bits."""
    return F.unhex(F.md5(text))


def _distinct(texts: DataFrame) -> DataFrame:
    """(key, packed) of each different text, one row however many copies there are."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            small = [pack(text) for text in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["key"].cast(pa.binary()), pa.array(small, pa.binary())], names=["key", "packed"]
            )

    return texts.mapInArrow(packed, "key binary, packed binary").groupBy("key").agg(
        F.first("packed").alias("packed")
    )


def _opened(column: pa.Array) -> list[bytes]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(value) for value in column.cast(pa.binary()).to_pylist()]


def _fetched(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """The asked pieces with their bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, whole in enumerate(_opened(batch["packed"])):
                rows = batch["asked"][number].as_py()
                for row in rows:
                    row["key"] = batch["key"][number].as_py()
                    row["piece"] = whole[row["start"] : row["last"] + LENGTH]
                yield from _rows(rows, _TEXTS)

    fields = ("seed", "start", "last", "at", "need", "p1", "p2")
    by_text = asked.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("asked"))
    return _distinct(texts).join(by_text, "key").mapInArrow(cut, _TEXTS)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def _rows(rows: list[dict], schema: str) -> Iterator[pa.RecordBatch]:
    fields = pa.schema([(name, _ARROW[kind]) for name, kind in (x.split() for x in schema.split(","))])
    for start in range(0, len(rows), 2000):
        yield pa.RecordBatch.from_pylist(rows[start : start + 2000], schema=fields)


def repeated_starts(pieces: list[bytes], seeds: list[int]) -> list[np.ndarray]:
    """For each piece, the starts of its strings that occur elsewhere in these pieces.

    ``seeds`` are the places of the seed they share; no string starts behind it.
    """
    marked = len(pieces)
    symbols = []
    for number, (piece, at) in enumerate(zip(pieces, seeds)):
        data = np.frombuffer(piece, np.uint8).astype(np.int64) + marked
        # A sign of its own ends each piece; the last is the smallest of all.
        symbols += [data[:at], [marked + 256], data[at + SEED :], [marked - 1 - number]]
    whole = np.concatenate(symbols)
    counts = np.array([len(piece) - LENGTH + 1 for piece in pieces])
    sizes = np.array([len(piece) - SEED + 2 for piece in pieces])
    begins = np.cumsum(sizes) - sizes
    inside = np.zeros(len(whole), bool)
    for begin, count in zip(begins, counts):
        inside[begin : begin + count] = True
    order = suffix_array(whole)
    order = order[inside[order]]
    # Suffixes with equal beginnings are neighbours.
    strings = np.lib.stride_tricks.sliding_window_view(whole, LENGTH - SEED + 1)
    equal = np.zeros(max(0, len(order) - 1), bool)
    for start in range(0, len(equal), 4096):
        left, right = order[start : start + 4096], order[start + 1 : start + 4097]
        equal[start : start + 4096] = (strings[left[: len(right)]] == strings[right]).all(axis=1)
    hit = np.zeros(len(whole), bool)
    hit[order[:-1][equal]] = True
    hit[order[1:][equal]] = True
    return [np.flatnonzero(hit[begin : begin + count]) for begin, count in zip(begins, counts)]


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that repeat; rows arrive ordered by group."""
    held: list[dict] = []

    def settle() -> list[dict]:
        if not held:
            return []
        # Equal pieces need one entry; that they repeat is known without it.
        different: dict[bytes, list[dict]] = {}
        for row in held:
            different.setdefault(row["piece"], []).append(row)
        pieces = list(different)
        out = []
        seeds = [different[piece][0]["at"] - different[piece][0]["start"] for piece in pieces]
        for piece, found in zip(pieces, repeated_starts(pieces, seeds) if len(pieces) > 1 else [[]]):
            rows = different[piece]
            if len(rows) > 1:
                found = np.arange(len(piece) - LENGTH + 1)
            if not len(found):
                continue
            breaks = np.flatnonzero(np.diff(found) > 1)
            lows = found[np.concatenate([[0], breaks + 1])].tolist()
            highs = (found[np.concatenate([breaks, [len(found) - 1]])] + LENGTH).tolist()
            out += [
                {"key": row["key"], "low": row["start"] + low, "high": row["start"] + high}
                for row in rows
                if row["need"]
                for low, high in zip(lows, highs)
            ]
        return out

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["seed"] != row["seed"]:
                yield from _rows(settle(), _SPANS)
                held.clear()
            held.append(row)
    yield from _rows(settle(), _SPANS)


def _halved(parts: int):
    """Cuts pieces by their strings' places relative to the seed into so many parts."""
    cuts = [-(i * (LENGTH - SEED + 1) // -parts) for i in range(parts + 1)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for low, high in zip(cuts, cuts[1:]):
                    # Strings that begin from ``high - 1`` down to ``low`` bytes before the seed.
                    start = max(row["start"], row["at"] - high + 1)
                    last = min(row["last"], row["at"] - low)
                    if start > last:
                        continue
                    piece = row["piece"]
                    core = piece[row["at"] - low - row["start"] : row["at"] - high + 1 + LENGTH - row["start"]]
                    own = piece[start - row["start"] : last + LENGTH - row["start"]]
                    group = hashlib.blake2b(core, digest_size=8, salt=low.to_bytes(4, "big")).digest()
                    digest = np.frombuffer(_digest(own), np.int64).tolist()
                    out.append(
                        row
                        | {"seed": int.from_bytes(group, "big", signed=True), "start": start, "last": last}
                        | {"p1": digest[0], "p2": digest[1], "piece": own}
                    )
            yield from _rows(out, _TEXTS)

    return cut


def _alike() -> Column:
    return (F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2"))


def _grown(rows: DataFrame, group_bytes: int) -> DataFrame:
    sizes = rows.groupBy("seed").agg(
        F.sum(F.octet_length("piece") + 1).alias("bytes"), F.count(F.lit(1)).alias("pieces"), _alike().alias("alike")
    )
    return land(sizes.where("pieces > 1").withColumn("large", F.col("bytes") > group_bytes), "sizes")


def _closer(rows: DataFrame, group_bytes: int) -> DataFrame:
    """(key, low, high) of what repeats among the landed pieces that share a seed."""
    found, parts = [], 1
    while True:
        sizes = _grown(rows, group_bytes)
        total = sizes.where("not large and not alike").agg(F.sum("bytes")).first()[0] or 0
        tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
        small = rows.join(sizes.where("not large and not alike").select("seed"), "seed")
        ordered = small.repartition(tasks, "seed").sortWithinPartitions("seed")
        found.append(land(ordered.mapInArrow(_solved, _SPANS), "spans"))
        whole = rows.join(sizes.where("alike").select("seed"), "seed").where("need")
        found.append(land(whole.select("key", F.col("start").alias("low"), (F.col("last") + LENGTH).alias("high")), "spans"))
        large = sizes.where("large and not alike").select("seed")
        if large.isEmpty():
            break
        parts *= 2
        again = rows.join(large, "seed").mapInArrow(_halved(min(parts, LENGTH - SEED + 1)), _TEXTS)
        rows = land(again, "halved")
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def repeated_spans(texts: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(key, low, high): byte ranges of each text that are covered by repeated strings.

    ``texts`` holds key and text, one row for each occurrence of a text.
    """
    long = texts.where(F.octet_length("text") >= LENGTH)
    tiled = land(long.mapInArrow(_tiled, _PIECES), "tiled")
    pieces = tiled.select("key", F.inline("pieces"))
    times = (F.col("upto") - F.col("last")) / (F.col("last") - F.col("start") + 1) + 1
    counted = pieces.groupBy("seed").agg(F.sum(times).alias("times"), _alike().alias("alike"))
    shared = land(counted.where("times > 1").select("seed", "alike"), "shared")
    hits = land(pieces.join(shared, "seed").withColumn("times", times), "hits")
    drop_landed(tiled, shared)

    whole = hits.where("alike").select("key", F.col("start").alias("low"), (F.col("upto") + LENGTH).alias("high"))
    mixed = hits.where("not alike")
    kinds = mixed.groupBy("seed", "p1", "p2").agg(
        F.sum("times").alias("times"), F.min(F.struct("key", "start", "last", "at")).alias("one")
    )
    kinds = land(kinds, "kinds")
    copies = mixed.join(kinds.where("times > 1").select("seed", "p1", "p2"), ["seed", "p1", "p2"])
    copies = copies.select("key", F.col("start").alias("low"), (F.col("upto") + LENGTH).alias("high"))
    open_ = kinds.groupBy("seed").agg(F.min("times").alias("least")).where("least = 1").select("seed")
    asked = kinds.join(open_, "seed").select("seed", "p1", "p2", "one.*", (F.col("times") == 1).alias("need"))
    closer = _closer(land(_fetched(long, asked), "texts"), group_bytes)
    return whole.unionByName(copies).unionByName(closer)


_RESULT = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def merged(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that the ranges cover."""
    order = np.argsort(lows, kind="stable")
    lows, highs = lows[order], np.maximum.accumulate(highs[order]) if len(order) else highs
    heads = np.flatnonzero(np.concatenate([[True], lows[1:] > highs[:-1]])) if len(lows) else np.zeros(0, np.int64)
    return lows[heads], highs[np.append(heads[1:], len(lows)) - 1] if len(lows) else highs


def _removed(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
            out = {name: [] for name in names}
            for number, whole in enumerate(_opened(batch["packed"])):
                spans = batch["spans"][number].values
                lows = np.asarray(spans.field("low")) if spans is not None else np.zeros(0, np.int64)
                highs = np.asarray(spans.field("high")) if spans is not None else np.zeros(0, np.int64)
                lows, highs = merged(lows, highs)
                edges = zip([0, *highs.tolist()], [*lows.tolist(), len(whole)])
                kept = b"".join(whole[a:b] for a, b in edges)
                out["n_bytes"].append(len(whole))
                out["n_removed"].append(len(whole) - len(kept))
                out["n_spans"].append(len(lows))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode("utf-8", "replace") if with_text else None)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array(out[name], kind) for name, kind in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays([batch["key"].cast(pa.binary()), *columns], names=["key", *names])

    return cut


def without_repeats(docs: DataFrame, with_text: bool = False, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept of every row of ``docs``.

    Texts are taken as UTF-8 bytes, null as empty.  Each byte that a 400-byte string
    covers which also starts anywhere else, in the same text or another row's, is
    removed; so a text that stands in two rows, repeated rows included, goes whole if
    it has 400 bytes.  ``kept`` is the rest (null unless ``with_text``); bytes of a
    character that was cut become replacement characters in it, while the digest is
    of the bytes.  Rows keep their doc_id, null or repeated ones too; an empty table
    gives no rows, further columns are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", _key(F.col("text")).alias("key"), "text")
    spans = repeated_spans(texts.select("key", "text"), group_bytes).distinct()
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    whole = _distinct(texts.select("key", "text")).join(spans, "key", "left")
    result = land(whole.mapInArrow(_removed(with_text), _RESULT), "result")
    return texts.select("doc_id", "key").join(result, "key").drop("key")
