"""Repeated byte strings against counting every one of them; suffix arrays against sorting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from flowlens.llm import common, repeats
from flowlens.llm.suffixes import suffix_array

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def brute(rows):
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    digest = lambda b, i: hashlib.blake2b(b[i : i + 400], digest_size=12).digest()
    seen = Counter(digest(b, i) for _, b in texts for i in range(len(b) - 399))
    out = []
    for doc, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[digest(b, i)] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, hit in zip(b, gone) if not hit)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, schema=DOCS, **options):
    result = repeats.without_repeats(spark.createDataFrame(rows, schema), **options).drop("kept")
    return sorted(map(tuple, result.collect()), key=str)


def words(rng, count):
    return " ".join(rng.choice(["é", "ab", "lorem", "ipsum", "dolor", "sit", "xx", "tempor"]) for _ in range(count))


@pytest.mark.parametrize("symbols", [1, 2, 5])
def test_suffix_array_equals_sorting(symbols):
    rng = random.Random(symbols)
    for count in [*range(12)] * 40 + [300]:
        text = [rng.randint(1, symbols) for _ in range(count)] + [0]
        assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_needs_a_smallest_end():
    assert len(suffix_array(np.array([], int))) == 0
    with pytest.raises(ValueError, match="smallest"):
        suffix_array(np.array([1, 0, 1]))


@pytest.mark.parametrize("group_bytes", [repeats.GROUP_BYTES, 3000])
def test_equals_counting_every_string(spark, group_bytes):
    rng = random.Random(3)
    passage, line, base = words(rng, 120), words(rng, 45), words(rng, 900)
    rows = [(0, None), (1, ""), (2, "a" * 1500), (3, "ab" * 700), (4, passage), (5, "z" * 399), (5, "z" * 399)]
    rows += [(6, words(rng, 30) + passage + words(rng, 60)), (7, words(rng, 200) + passage[:500]), (None, words(rng, 300))]
    rows += [(8, words(rng, 250))] * 3
    # A line that a third of the texts hold, with different surroundings; near copies.
    rows += [(10 + i, words(rng, 25) + line + words(rng, 25) + line[:200] + words(rng, 40)) for i in range(30)]
    rows += [(100 + i, base[: i * 37] + "#" + base[i * 37 + 5 :]) for i in range(10)]
    want = brute(rows)
    assert sum(row[2] for row in want) > 40_000
    assert found(spark, rows, group_bytes=group_bytes) == want


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(4)
    passage = words(rng, 150)
    long = "".join(f"{rng.random()} " for _ in range(30_000))
    rows = [(1, long + passage + long[1000:3000]), (2, passage), (3, long[70_000:530_000])]
    assert found(spark, rows) == brute(rows)


def test_empty_table_clashing_columns_and_kept_text(spark):
    assert found(spark, []) == []
    rows = [(1, "x" * 10, 5, b"k", 1), (2, "y" * 900, 5, b"k", 1)]
    frame = spark.createDataFrame(rows, DOCS + ", seed int, key binary, n_bytes int")
    kept = {row.doc_id: row.kept for row in repeats.without_repeats(frame, with_text=True).collect()}
    assert kept == {1: "x" * 10, 2: ""}
