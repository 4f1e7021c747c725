"""Benchmark decontamination: a BM25 inverted index of the test items, block-max WAND.

The index holds the test items; every passage of every document is a query.
Impacts are BM25 weights divided by the item's weight against itself, so that a
score of one means that the passage holds all of the item's terms, and one
threshold suits short and long items.  All items above the threshold are
retrieved, then the text itself is compared: five-word shingles of the whole
item, and where the benchmark has an answer column, of question and answer too.
Items of fewer than five words have no shingle; they are looked up as they are.

Before the lists of a passage are walked, WAND's test for whether any item can
reach the threshold is made for all passages of a batch at once: an item's
commonest terms, whose impacts add up to little, are taken as present, and the
impacts of its other, essential terms are added up where they occur.  Passages
in which no item's bound reaches the threshold are done.

The index goes to the executors in slices of bounded size, one after the other: each
slice is asked in a pass of its own and forgotten before the next is built.  Document
frequencies are those of all items.
"""

from __future__ import annotations

import math
import string
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import land

SHINGLE = 5
OVERLAP = 0.8  # of the item's shingles
PART_OVERLAP = 0.5  # of the question's and of the answer's shingles, each
SCORE = 0.5  # normalised BM25
K1, B = 1.2, 0.75
COMMON = 0.2  # of an item's own score: what its commonest terms may add up to
BLOCK = 64  # postings of a block
SLICE_BYTES = 16 << 20  # text of the items in one index
HIT = "array<struct<item_id:bigint,score:double,overlap:double,question:double,answer:double>>"

FOUND = "doc_id long, item_id long, score double, overlap double, question double, answer double"

_MARKS = str.maketrans(dict.fromkeys(string.punctuation, " "))


def words_of(text: str | None) -> list[str]:
    """Lower-case words; blanks and ASCII punctuation part them."""
    return (text or "").lower().translate(_MARKS).split()


def shingles(words: list[str], size: int = SHINGLE) -> list[tuple[str, ...]]:
    return list(zip(*[words[i:] for i in range(size)]))


@dataclass
class Item:
    """The words of a test item's question, and of its answer where it has one of its own."""

    item_id: int
    words: list[str]
    answer: list[str] = field(default_factory=list)

    @property
    def whole(self) -> list[str]:
        return self.words + self.answer


def share_of(words: list[str], present: set[tuple[str, ...]], text: list[str]) -> float:
    """Share of a part's shingles that a text holds; a part without any is there or not."""
    own = shingles(words)
    if own:
        return sum(one in present for one in own) / len(own)
    return float(not words or holds(text, words))


def holds(text: list[str], words: list[str]) -> bool:
    """Whether the words stand in the text one after the other."""
    return any(text[i : i + len(words)] == words for i, word in enumerate(text) if word == words[0])


class Index:
    """Inverted lists of one slice of items, in blocks with their largest impact."""

    def __init__(self, items: list[Item], frequency: dict[str, int], total: int, mean_length: float):
        # Short items are found by their first word, not by score.
        self.short: dict[str, list[Item]] = {}
        for item in items:
            if 0 < len(item.whole) < SHINGLE:
                self.short.setdefault(item.whole[0], []).append(item)
        items = [item for item in items if len(item.whole) >= SHINGLE]
        self.items = items
        self.terms: dict[str, int] = {}
        lists: list[list[tuple[int, float]]] = []
        essential: list[tuple[int, int, float]] = []
        self.rest = np.zeros(len(items))
        for number, item in enumerate(items):
            counts: dict[str, int] = {}
            for word in item.whole:
                counts[word] = counts.get(word, 0) + 1
            norm = K1 * (1 - B + B * len(item.whole) / mean_length)
            weight = {
                word: math.log(1 + (total - frequency[word] + 0.5) / (frequency[word] + 0.5))
                * n * (K1 + 1) / (n + norm)
                for word, n in counts.items()
            }
            own = sum(weight.values())
            common = 0.0
            for word in sorted(weight, key=lambda w: (-frequency[w], w)):
                term = self.terms.setdefault(word, len(self.terms))
                if term == len(lists):
                    lists.append([])
                impact = weight[word] / own
                lists[term].append((number, impact))
                if common + impact <= COMMON:
                    common += impact
                else:
                    essential.append((term, number, impact))
            self.rest[number] = common
        self.lists = [([n for n, _ in entries], [w for _, w in entries]) for entries in lists]
        self.tops = [max(weights) for _, weights in self.lists]
        starts = [range(0, len(numbers), BLOCK) for numbers, _ in self.lists]
        self.blocks = [
            (
                [numbers[min(i + BLOCK, len(numbers)) - 1] for i in begins],
                [max(weights[i : i + BLOCK]) for i in begins],
            )
            for (numbers, weights), begins in zip(self.lists, starts)
        ]
        self.essential: list[list[tuple[int, float]]] = [[] for _ in items]
        for term, number, impact in essential:
            self.essential[number].append((term, impact))
        essential.sort()
        owners = np.array([term for term, _, _ in essential], np.int64)
        self.begins = np.searchsorted(owners, np.arange(len(self.terms) + 1))
        self.essential_items = np.array([n for _, n, _ in essential], np.int64)
        self.essential_impacts = np.array([w for _, _, w in essential])
        self.is_essential = np.zeros(len(self.terms) + 1, bool)  # last: no term
        self.is_essential[owners] = True
        self.stride = max([64, *(len(item.whole) for item in items)])

    def promising(self, cells: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Passages and items that may reach the threshold, as first cell times items plus item.

        A passage is two cells of ``stride`` words that follow each other; given are
        the cells' essential terms.  An item, never longer than a cell, lies in one.
        """
        size = len(self.items)
        pairs = np.unique(cells * len(self.terms) + terms)
        cells, terms = np.divmod(pairs, len(self.terms))
        counts = self.begins[terms + 1] - self.begins[terms]
        places = np.repeat(self.begins[terms] - np.cumsum(counts) + counts, counts)
        places += np.arange(len(places))
        keys = np.repeat(cells, counts) * size + self.essential_items[places]
        found, inverse = np.unique(keys, return_inverse=True)
        sums = np.bincount(inverse, self.essential_impacts[places], len(found))
        if not len(found):
            return found
        following = np.minimum(np.searchsorted(found, found + size), len(found) - 1)
        bound = sums + np.where(found[following] == found + size, sums[following], 0)
        return found[bound + self.rest[found % size] >= SCORE - 1e-9]

    def bound(self, number: int, passage: set[int]) -> bool:
        """Whether an item can reach the threshold in a passage, by its essential terms."""
        own = self.essential[number]
        return sum(w for term, w in own if term in passage) + self.rest[number] >= SCORE - 1e-9

    def search(self, terms: Iterable[int], least: float = SCORE) -> list[tuple[int, float]]:
        """All items whose score for the terms is at least ``least``, by block-max WAND."""
        least -= 1e-9
        cursors = [(self.lists[t][0][0], 0, t) for t in set(terms)]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for place, (_, _, term) in enumerate(cursors):
                bound += self.tops[term]
                if bound >= least:
                    pivot = place
                    break
            if pivot is None:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            near, ends = 0.0, []
            for _, _, term in cursors[: pivot + 1]:
                lasts, tops = self.blocks[term]
                block = bisect_left(lasts, target)
                if block < len(lasts):
                    near += tops[block]
                    ends.append(lasts[block])
            if near < least:
                following = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
                jump = min([following, *(end + 1 for end in ends)])
                cursors = self._advance(cursors, pivot + 1, max(jump, target + 1))
            elif cursors[0][0] == target:
                score = sum(self.lists[t][1][place] for _, place, t in cursors[: pivot + 1])
                if score >= least:
                    found.append((target, score))
                cursors = self._advance(cursors, pivot + 1, target + 1)
            else:
                cursors = self._advance(cursors, pivot, target)
        return found

    def _advance(self, cursors: list, count: int, target: float) -> list:
        """Move the first cursors to their next item from ``target`` on; ended lists go."""
        left = cursors[count:]
        for number, place, term in cursors[:count]:
            numbers = self.lists[term][0]
            if number < target:
                place = bisect_left(numbers, target, place)
            if place < len(numbers):
                left.append((numbers[place], place, term))
        return left

    def verified(self, number: int, score: float, present: set[tuple[str, ...]], text: list[str]) -> dict | None:
        """Overlap of an item's shingles with a document's: whole, question and answer."""
        item = self.items[number]
        row = {
            "item_id": item.item_id, "score": score, "overlap": share_of(item.whole, present, text),
            "question": None, "answer": None,
        }
        good = row["overlap"] >= OVERLAP
        if item.answer:
            row |= {part: share_of(words, present, text) for part, words in (("question", item.words), ("answer", item.answer))}
            good = good and min(row["question"], row["answer"]) >= PART_OVERLAP
        return row if good else None

    def short_hits(self, text: list[str]) -> Iterator[dict]:
        """The items of few words that a text holds as they are."""
        for word in set(text) & self.short.keys():
            for item in self.short[word]:
                if holds(text, item.whole):
                    parts = 1.0 if item.answer else None
                    yield {"item_id": item.item_id, "score": 1.0, "overlap": 1.0, "question": parts, "answer": parts}

    def hits(self, texts: list[str | None]) -> list[list[dict]]:
        """The items that each text holds."""
        results: list[list[dict]] = [list(self.short_hits(words_of(text))) if self.short else [] for text in texts]
        if not self.items:
            return results
        none = len(self.terms)
        at, cells, terms, sequences = 0, [], [], []
        for text in texts:
            ids = np.fromiter(map(self.terms.get, words_of(text), repeat(none)), np.int64)
            places = np.flatnonzero(self.is_essential[ids])
            sequences.append((at, ids))
            cells.append(at + places // self.stride)
            terms.append(ids[places])
            at += len(ids) // self.stride + 2  # a gap, so that no passage spans two texts
        begins = np.array([begin for begin, _ in sequences])
        best: dict[tuple[int, int], float] = {}
        likely = self.promising(np.concatenate(cells), np.concatenate(terms)).tolist() if texts else ()
        for cell, keys in groupby(likely, lambda key: key // len(self.items)):
            row = int(np.searchsorted(begins, cell, side="right")) - 1
            begin, ids = sequences[row]
            first = (cell - begin) * self.stride
            passage = set(ids[first : first + 2 * self.stride].tolist()) - {none}
            # A term in both cells was counted twice: once more, with each term once.
            if any(self.bound(key % len(self.items), passage) for key in keys):
                for number, score in self.search(passage):
                    best[row, number] = max(score, best.get((row, number), 0.0))
        opened, words, present = -1, [], set()
        for (row, number), score in sorted(best.items()):
            if opened != row:
                opened, words = row, words_of(texts[row])
                present = set(shingles(words))
            found = self.verified(number, score, present, words)
            if found:
                results[row].append(found)
        return results


@F.pandas_udf(T.ArrayType(T.StringType()))
def _terms(texts: pd.Series) -> pd.Series:
    return pd.Series([words_of(text) for text in texts], dtype=object)


def indexes(benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, Index]]:
    """(slices left, index) of each slice of items, built as it is asked for.

    A slice holds about ``slice_bytes`` of text, or one item.  An ``answer`` column is an
    item's answer; without one the text is all there is.
    """
    answer = benchmark["answer"] if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = land(
        benchmark.select(
            benchmark["item_id"].cast("long").alias("item_id"),
            F.coalesce(F.octet_length(benchmark["text"]), F.lit(0)).alias("size"),
            _terms(benchmark["text"]).alias("words"),
            _terms(answer).alias("answer"),
        ).withColumn("terms", F.concat("words", "answer")).where(F.size("terms") > 0),
        "items",
    )
    total, words, size = items.agg(F.count(F.lit(1)), F.sum(F.size("terms")), F.sum("size")).first()
    if not total:
        return
    frequency = land(
        items.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").count(), "frequency"
    )
    slices = max(1, math.ceil(2 * size / slice_bytes))
    number = F.pmod(F.xxhash64("item_id", "terms"), F.lit(slices))
    for which in range(slices):
        part = items.where(number == which)
        rows = part.select("item_id", "words", "answer").orderBy("item_id", "words", "answer").collect()
        counts = frequency.join(
            part.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi"
        ).collect()
        own = [Item(row["item_id"], row["words"], row["answer"]) for row in rows]
        yield slices - which - 1, Index(own, {row["term"]: row["count"] for row in counts}, total, words / total)


def _asked(docs: DataFrame, index: Index, text: str):
    """The items of an index that a row's text holds, and the index as it was sent."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf(HIT)
    def hits(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.hits(texts.tolist()), dtype=object)

    return hits(docs[text]), sent


def contaminated(docs: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row for each document and test item it holds.

    Columns doc_id, item_id, score (best of its passages, 1: all terms), and the shares of
    the item's shingles that the document holds: overlap (0.8 at least), and for items with
    an answer question and answer (0.5 at least each), else null.  An item of fewer than
    five words is held where its words stand one after the other.  A passage is two
    stretches as long as the longest item, so an item scattered wider is none.  Null and
    empty texts hold nothing, empty items are held nowhere, an empty benchmark by nothing;
    documents and items that occur twice count twice; rows without doc_id keep their null.
    Further columns are not read.
    """
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    found = None
    for left, index in indexes(benchmark, slice_bytes):
        held, sent = _asked(rows, index, "text")
        hits = rows.select("doc_id", F.explode(held).alias("hit")).select("doc_id", "hit.*")
        if left or found is not None:
            hits = land(hits, "hits")
            sent.destroy()
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else rows.sparkSession.createDataFrame([], FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns.

    What holds an item is said at ``contaminated``.  Rows without a text stay, repeated rows
    stay repeated, columns keep their names whatever they are; an empty benchmark drops none.
    """
    rows = docs
    for left, index in indexes(benchmark, slice_bytes):
        held, sent = _asked(rows, index, "text")
        rows = rows.where(F.size(held) == 0)
        if left:
            rows = land(rows, "clean")
            sent.destroy()
    return rows
