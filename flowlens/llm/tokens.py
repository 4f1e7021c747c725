"""Token ids in directly addressable codes.

A segment holds the ids of some documents.  Ids are cut into chunks of eight bits,
the lowest first: level one has the first chunk of every id, level two the second
chunk of those ids that have one, and so on.  A bitmap per level marks the ids that
continue, and a directory counts the marks before every 512th bit.  The place of an
id on the next level is the number of marks before it, so any token is read with a
few look-ups and no block is decoded.

Documents are dealt out by ranges of doc_id and sorted, so segments in order of
(part, seq) hold the corpus in ascending doc_id order.  Segments are rows of a
Parquet file: written by tasks, committed by Spark, readable from any machine.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import land

END_ID = 0
CHUNK = 8
STRIDE = 512  # bits between two counts of a directory
SEGMENT = 1 << 20  # ids after which a segment is closed
MAGIC = b"DAC1"
# Pieces cut and looked up together, but for a longer text.
_KNOWN_PIECES = 300_000
# Parts remembered by a worker; beyond, it starts anew.
_KNOWN_PARTS = 600_000
# Blanks other than the space and the line feed.
_OTHER_BLANKS = "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# What a text holds where its words are not all after one space.
_ODD = f"^[ \n]|[ \n]$|  | \n|\n |{_OTHER_BLANKS}"
_CHUNKS = re.compile(r"\s*\S+|\s+")
# A word of letters, maybe with punctuation behind it: the pre-tokenizer always parts the two.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_STEM = f"^(?P<stem>{_LETTERS})(?P<marks>[#*$%&|!,.;:?]*)$"
_WORD = re.compile(f" {_LETTERS}")


def encode(ids: np.ndarray) -> bytes:
    """The code of a sequence of non-negative ids below 2**32."""
    rest = np.asarray(ids, np.uint32)
    out = []
    while True:
        chunk = (rest & 0xFF).astype(np.uint8)
        rest = rest >> CHUNK
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        marks = np.bitwise_count(np.pad(bitmap, (0, -len(bitmap) % (STRIDE // 8))))
        sums = marks.reshape(-1, STRIDE // 8).sum(1, dtype=np.int64)
        before = np.concatenate([[0], np.cumsum(sums)]).astype("<u4")
        out.append((chunk.tobytes(), bitmap.tobytes(), before.tobytes()))
        rest = rest[more]
        if not len(rest):
            break
    head = struct.pack("<4sI", MAGIC, len(out))
    sizes = b"".join(struct.pack("<III", *map(len, level)) for level in out)
    return head + sizes + b"".join(part for level in out for part in level)


class Code:
    """Reader of one segment: all ids, or any of them by its place."""

    def __init__(self, data: bytes):
        magic, levels = struct.unpack_from("<4sI", data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = 8 + 12 * levels
        self.levels = []
        for level in range(levels):
            parts = []
            for size, kind in zip(struct.unpack_from("<III", data, 8 + 12 * level), ("u1", "u1", "<u4")):
                parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append(parts)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, place: int) -> int:
        if not 0 <= place < len(self):
            raise IndexError(place)
        value = 0
        for level, (chunks, bitmap, before) in enumerate(self.levels):
            value |= int(chunks[place]) << (CHUNK * level)
            byte, bit = divmod(place, 8)
            if not bitmap[byte] >> bit & 1:
                break
            begin = place // STRIDE * (STRIDE // 8)
            ahead = np.bitwise_count(bitmap[begin:byte]).sum(dtype=int)
            ahead += int(bitmap[byte] & ((1 << bit) - 1)).bit_count()
            place = int(before[place // STRIDE]) + int(ahead)
        return value

    def all(self) -> np.ndarray:
        ids = self.levels[0][0].astype(np.uint32)
        places = np.arange(len(ids))
        for level in range(1, len(self.levels)):
            bitmap = self.levels[level - 1][1]
            marked = np.unpackbits(bitmap, count=len(places), bitorder="little").astype(bool)
            places = places[marked]
            ids[places] |= self.levels[level][0].astype(np.uint32) << (CHUNK * level)
        return ids


class _Numbered(dict):
    """Texts to numbers in the order in which they were first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        number = self[text] = len(self)
        self.new.append(text)
        return number

    def taken(self) -> list[str]:
        """The texts numbered since the last call."""
        new, self.new = self.new, []
        return new


class _Column:
    """Numbers appended in blocks."""

    def __init__(self, kind: type):
        self.held, self.used = np.empty(1 << 16, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.used + len(values) > len(self.held):
            grown = np.empty(max(2 * len(self.held), self.used + len(values)), self.held.dtype)
            grown[: self.used] = self.held[: self.used]
            self.held = grown
        self.held[self.used : self.used + len(values)] = values
        self.used += len(values)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for letters from U+0100 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class Encoder:
    """Ids of texts, word by word, as a whole text would be encoded.

    The pre-tokenizer never lets a token run from a character that is not blank
    into a blank.  So a text may be cut before every blank run, and the ids of the
    pieces laid end to end.  A piece is one part, or letters and the punctuation
    behind them as two.  Arrow cuts the texts and finds their distinct pieces, stems
    and marks; distinct parts are numbered, and the ids of a part are remembered, for
    as many of them as memory allows.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model if _is_plain(self.library) else None
        self.letters = _byte_letters()
        self._forget_parts()

    def _forget_parts(self) -> None:
        self.part = _Numbered()
        self.flat, self.begins, self.sizes = _Column(np.uint32), _Column(np.int64), _Column(np.int64)

    def _ids_of(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts.  A space and letters are one word to the pre-tokenizer, so they go to the model as they are."""
        found: list[list[int]] = [[]] * len(parts)
        others = []
        for i, part in enumerate(parts):
            if self.model and _WORD.fullmatch(part):
                if part.isascii():
                    word = self.letters[0x20] + part[1:]
                else:
                    word = part.encode().decode("latin-1").translate(self.letters)
                found[i] = [token.id for token in self.model.tokenize(word)]
            elif part:
                others.append(i)
        encoded = self.library.encode_batch_fast([parts[i] for i in others], add_special_tokens=False)
        for i, encoding in zip(others, encoded):
            found[i] = encoding.ids
        return found

    def _numbers(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.part.__getitem__, parts), np.int64, len(parts))

    def _learn(self) -> None:
        """Ids of the parts numbered since the last call."""
        found = self._ids_of(self.part.taken())
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.begins.extend(self.flat.used + np.cumsum(sizes) - sizes)
        self.sizes.extend(sizes)
        self.flat.extend(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())))

    def _numbered(self, distinct: pa.Array, before: str = "") -> np.ndarray:
        """Part numbers of a column's values, each distinct one looked up once."""
        coded = distinct.dictionary_encode()
        return self._numbers([before + text for text in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]

    def _plain_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Two parts of each piece of texts whose words are all after one space, and the pieces of each text."""
        cut = pc.split_pattern(texts, " ")
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary
        found = pc.extract_regex(pieces, _STEM)
        stemmed = found.is_valid().to_numpy(zero_copy_only=False)
        stems = found.filter(found.is_valid())
        of = np.full((len(pieces), 2), self.part[""])
        of[stemmed, 0] = self._numbered(stems.field(0), " ")
        of[stemmed, 1] = self._numbered(stems.field(1))
        of[~stemmed, 0] = self._numbers([" " + piece for piece in pieces.filter(found.is_null()).to_pylist()])
        parts = of[coded.indices.to_numpy()]
        lengths = pc.list_value_length(cut).to_numpy().astype(np.int64)
        # No space is before the first piece of a text, so that one stands as it is.
        heads = np.cumsum(lengths) - lengths
        parts[heads, 0] = self._numbers(cut.flatten().take(pa.array(heads)).to_pylist())
        parts[heads, 1] = self.part[""]
        return parts, lengths

    def _odd_parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any texts; each piece stands as it is."""
        cut = [_CHUNKS.findall(text) for text in texts]
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        parts = np.full((int(lengths.sum()), 2), self.part[""])
        parts[:, 0] = self._numbers(list(chain.from_iterable(cut)))
        return parts, lengths

    def _laid(self, parts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Ids of each text: those of its parts end to end."""
        parts = parts.reshape(-1)
        counts = self.sizes.held[parts]
        ends = np.cumsum(counts)
        ids = self.flat.held[np.repeat(self.begins.held[parts] - ends + counts, counts) + np.arange(counts.sum())]
        stops = np.concatenate([[0], ends])[2 * np.cumsum(lengths)]
        return np.split(ids, stops[:-1])

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """Ids of each text, in runs of texts that bound the pieces held at once."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        ends = np.cumsum(pc.count_substring(texts, " ").to_numpy().astype(np.int64) + 1)
        cuts = np.flatnonzero(np.diff(ends // _KNOWN_PIECES, prepend=0)).tolist()
        found: list[np.ndarray] = []
        for begin, end in pairwise([0, *cuts, len(texts)]):
            found += self._encode_run(texts.slice(begin, end - begin))
        return found

    def _encode_run(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.part) > _KNOWN_PARTS:
            self._forget_parts()
        odd = pc.match_substring_regex(texts, _ODD)
        plain, others = self._plain_parts(texts.filter(pc.invert(odd))), self._odd_parts(texts.filter(odd).to_pylist())
        self._learn()
        found: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        is_odd = odd.to_numpy(zero_copy_only=False)
        for kind, (parts, lengths) in ((False, plain), (True, others)):
            if len(lengths):
                for place, ids in zip(np.flatnonzero(is_odd == kind).tolist(), self._laid(parts, lengths)):
                    found[place] = ids
        return found


def _is_plain(library) -> bool:
    """Whether the tokenizer is byte-level BPE that only parts words, with nothing before or between."""
    said = json.loads(library.to_str())
    parting = said["pre_tokenizer"] or {}
    return (
        said["normalizer"] is None
        and parting.get("type") == "ByteLevel"
        and parting.get("use_regex", True)
        and not parting["add_prefix_space"]
        and said["model"]["type"] == "BPE"
        and said["truncation"] is None
    )


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One encoder per Python worker: its memory outlives a task."""
    return Encoder(path)


_SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
_READ = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("nth", pa.int64()),
        ("doc_id", pa.int64()),
        ("offset", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
TEXTS = 1000  # documents handed to the encoder together


def write_segments(docs: DataFrame, tokenizer: str, end_id: int = END_ID, segment: int = SEGMENT) -> DataFrame:
    """Segments (part, seq, doc_ids, lengths, payload) of all rows, landed.

    A null text is like an empty one and has the end id only.  Rows without doc_id
    come first; rows with the same one follow each other, by text.  An empty table
    gives no segments; further columns are not read.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, found, total = [], [], 0

        def closed() -> pa.RecordBatch:
            row = {
                "part": part,
                "seq": seq,
                "doc_ids": doc_ids,
                "lengths": [len(ids) for ids in found],
                "payload": encode(np.concatenate(found)),
            }
            return pa.RecordBatch.from_pylist([row], _SEGMENTS)

        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS):
                some = batch.slice(begin, TEXTS)
                for doc_id, ids in zip(some[0].to_pylist(), encoder.encode(some[1])):
                    doc_ids.append(doc_id)
                    found.append(np.append(ids, np.uint32(end_id)))
                    total += len(found[-1])
                    if total >= segment:
                        yield closed()
                        seq, doc_ids, found, total = seq + 1, [], [], 0
        if found:
            yield closed()

    schema = "part int, seq int, doc_ids array<long>, lengths array<long>, payload binary"
    return land(ordered.mapInArrow(build, schema), "segments")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = Code(row["payload"]).all().astype("<u4")
            ends = np.cumsum(np.array(row["lengths"], np.int64))
            begins = ends - row["lengths"]
            crcs = [zlib.crc32(ids[i:j]) for i, j in zip(begins.tolist(), ends.tolist())]
            count = len(crcs)
            columns = [
                pa.array([row["part"]] * count, pa.int32()),
                pa.array([row["seq"]] * count, pa.int32()),
                pa.array(range(count), pa.int64()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(begins, pa.int64()),
                pa.array(row["lengths"], pa.int64()),
                pa.array(crcs, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_READ)


def read_documents(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the segments.

    ``start`` counts the ids before it in the whole corpus: of the parts before,
    of the part's segments before, and of the segment's documents before.
    """
    sizes = segments.select(
        "part", "seq", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x).alias("size")
    )
    until = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    parts = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("size").over(until), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    starts = starts.join(parts, F.col("part") == F.col("of")).select(
        F.col("part").alias("p"), F.col("seq").alias("s"), (F.col("before") + F.col("ahead")).alias("begin")
    )
    schema = "part int, seq int, nth long, doc_id long, offset long, n_tokens long, ids_crc32 long"
    # A segment is one row of some megabytes, so rows are spread before they are decoded.
    read = segments.select("part", "seq", "doc_ids", "lengths", "payload").mapInArrow(_read, schema)
    found = read.join(starts, (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")))
    return found.select("doc_id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
