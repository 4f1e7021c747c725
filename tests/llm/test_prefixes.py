"""The conversation prefix trie against a trie of dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from flowlens.llm import common, prefixes

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in sorted(own.items()):
        h = zlib.crc32(str(conv).encode()) % 9
        path = tuple(own.get(conv - conv % 5, [])[:h] + turns[h:])
        ends[path].append(conv)
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or int(not children[path])
        last = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * last + sum(saved[c] for c in children[path])
    return sorted(
        (
            min(found), len(path), min(members[path[:-1]]) if path else None, len(found), len(children[path]),
            leaves[path], saved[path], hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
        )
        for path, found in members.items()
    )


def found(spark, rows, schema=TURNS, **options):
    frame = spark.createDataFrame(rows, schema)
    trie = prefixes.prefix_trie(prefixes.rebuilt(prefixes.sequences(frame)), **options)
    assert trie.columns == COLUMNS
    return sorted(map(tuple, trie.collect()))


def conversations(seed, count, longest):
    rng = random.Random(seed)
    texts = ["", "yes", "no", "é" * 3, "a\0b", "word " * 50]
    rows = []
    for conv in rng.sample(range(3 * count), count):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(texts)))
    return rows


@pytest.mark.parametrize("shard_bytes", [200, 1 << 20])
def test_equals_a_trie_of_dictionaries(spark, shard_bytes):
    rows = conversations(1, 120, 5)
    # A third of all conversations are equal; some are much deeper than a strip.
    rows += [row for conv in range(1000, 1060) for row in [(conv, 0, "user", "same"), (conv, 1, None, "same")]]
    rows += [(conv, turn, "user", str(turn // 7)) for conv in (2000, 2001, 2005, 2007) for turn in range(90 + conv % 5)]
    assert found(spark, rows, shard_bytes=shard_bytes) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (7, None, "", ""), (7, 5, "x", None)]
    rows += [(None, 0, "user", "lost"), (9, 0, "user", "long " * 40_000), (-3, 2, "user", "b")]
    want = brute([row for row in rows if row[0] != -3])
    assert found(spark, [row for row in rows if row[0] != -3]) == want
    assert len(found(spark, rows)) >= len(want)
    again = [row + (1, b"x") for row in rows if row[0] != -3]
    assert found(spark, again, TURNS + ", path int, key binary") == want


def test_turnless_conversation_is_a_member_of_the_root(spark):
    """A conversation shorter than what it takes from a missing base has no turns left."""
    conv = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 3)
    rows = [(conv, 0, "user", "a"), (conv, 1, "user", "b")]
    digest = hashlib.sha256(str(conv).encode()).hexdigest()
    assert found(spark, rows) == [(conv, 0, None, 1, 0, 1, 0, digest)]


def test_no_conversations(spark):
    assert found(spark, []) == []


def test_id_lists_are_hashed_piece_by_piece(spark, monkeypatch):
    rows = [(conv * 5, 0, "user", "same") for conv in range(40)]
    assert found(spark, rows, shard_bytes=100) == brute(rows)
