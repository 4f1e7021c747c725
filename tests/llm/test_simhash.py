"""Dense balls of fingerprints, and odd inputs of the near-duplicate classes."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import common, simhash


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def signed(value):
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >= 1 << 63 else value


def frame(spark, values):
    return spark.createDataFrame([(signed(v),) for v in values], "fp long")


def brute(values):
    """Smallest member of the component of each fingerprint."""
    values = [signed(v) for v in values]
    bits = np.array(values, dtype=np.int64).view(np.uint64)
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= 4):
            a, b = top(v), top(values[i + 1 + j])
            root[max(a, b)] = min(a, b)
    return {v: top(v) for v in values}


def test_a_dense_ball_has_as_many_links_as_fingerprints(spark):
    """2,081 fingerprints within two bits of one: two million pairs, one component."""
    base = 0x0F1E2D3C4B5A6978
    ball = [base] + [base ^ (1 << i) for i in range(64)] + [base ^ (1 << i) ^ (1 << j) for i, j in combinations(range(64), 2)]
    points = frame(spark, ball)
    stars = simhash.star_links(points)
    links = stars.count()
    assert links <= 35 * len(ball)
    roots = common.components(stars)
    met = simhash.meeting_roots(points.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root")))
    assert met.count() <= len(ball)
    found = {row.node: row.root for row in simhash.near_components(points).collect()}
    assert found == brute(ball)


def test_chains_and_balls_equal_brute_force(spark):
    random = np.random.default_rng(5)
    values = set()
    for _ in range(12):
        value = int(random.integers(0, 1 << 63))
        for _ in range(25):
            for bit in random.choice(64, int(random.integers(1, 6)), replace=False):
                value ^= 1 << int(bit)
            values.add(value)
    found = {row.node: row.root for row in simhash.near_components(frame(spark, sorted(values))).collect()}
    want = brute(sorted(values))
    alone = {v for v in want if list(want.values()).count(want[v]) == 1}
    assert found == {v: root for v, root in want.items() if v not in alone}


def test_empty_table_null_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e", 1, 2), (None, "a b c d e", 1, 2), (4, "a b c d e", 1, 2), (9, None, 1, 2), (None, "", 1, 2)],
        "doc_id long, text string, fp int, root int",
    )
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fp", "root", "component_id"]
    assert sorted((r.doc_id or 0, r.component_id) for r in found.collect()) == [(0, 4), (0, 4), (0, 9), (4, 4), (9, 9)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_takes_any_column_names(spark):
    schema = "doc_id long, text string, __kept int, __text int, key int, id int, stays int, doubt int"
    rows = [(i, text, 1, 2, 3, 4, 5, 6) for i, text in [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z u v w"), (3, None)]]
    docs = spark.createDataFrame(rows + rows[2:3], schema)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "", r.stays) for r in kept.collect()) == [
        (1, "a b c d e f", 5), (3, "", 5), (3, "x y z u v w", 5),
    ]


def test_keep_one_compares_the_texts_that_fingerprints_link(spark, monkeypatch):
    own = " ".join(f"w{i}" for i in range(2000))
    many = " ".join(["again"] * 400)
    fooled = [f"{many} " + " ".join(f"{name}{i}" for i in range(30)) for name in ("a", "b")]
    texts = [(1, own), (2, f"{own} end"), (3, f"{own} end"), (4, fooled[0]), (5, fooled[1]), (6, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    proposed, real = [], simhash.near_texts

    def near_texts(*args):
        found = real(*args)
        proposed.extend(found.collect())
        return found

    monkeypatch.setattr(simhash, "near_texts", near_texts)
    # Alike fingerprints are no proof: the texts are compared.
    assert sorted(row.doc_id for row in simhash.keep_one(docs).collect()) == [1, 4, 5, 6]
    assert len(proposed) == 2


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies with one and with two other words: the latter are similar to the former only."""
    from flowlens.llm import overlap

    base = [f"w{i}" for i in range(150)]
    # Strange words stand far apart, and each place is used in turn.
    places = [(7 * i) % 140 + 5 for i in range(240)]
    texts = [[*base] for _ in places]
    for i, place in enumerate(places):
        texts[i][place] = f"x{i}"
        if i % 6:
            texts[i][(place + 70) % 140 + 5] = f"y{i}"
    frame = spark.createDataFrame([(i, " ".join(words)) for i, words in enumerate(texts)], "doc_id long, text string")
    compared = []
    verified = overlap._verified

    def counted(pairs, texts):
        compared.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(overlap, "_verified", counted)
    found = overlap.similar_texts(frame).collect()
    assert len(found) == len(texts) and len({row.root for row in found}) == 1
    assert sum(compared) < 50 * len(texts), compared


def test_rounds_of_components_write_files_by_their_links_not_by_the_partitions(spark, monkeypatch):
    """A round over few links has one file a step, though shuffles have 8 partitions that are not merged."""
    files = {}

    def landed(frame, name, land=common.land):
        back = land(frame, name)
        files.setdefault(name, []).append(len(back.inputFiles()))
        return back

    monkeypatch.setattr(common, "land", landed)
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        links = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
        roots = {row.node: row.root for row in common.components(links).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert roots == {i: 0 for i in range(31)}
    assert set(files["low"] + files["large"] + files["small"]) == {1}


def test_components_that_meet_only_across_stars_are_joined(spark):
    """Two stars whose smallest fingerprints are far apart, and a lone pair, against brute force."""
    values = [0, 0b1111, 0b11111111, 0xFFF, 0xFFFF, 1 << 40, (1 << 40) | 1, -1]
    values += [0xFFFF | (0xF << 20), 0xFFFF | (0xFF << 20), -2]
    want = brute(values)
    rows = simhash.near_components(frame(spark, values)).collect()
    assert len({row.node for row in rows}) == len(rows)
    found = {row.node: row.root for row in rows}
    assert {value: found.get(value, value) for value in values} == want


def test_the_sieve_of_repeated_hashes_is_filled_by_these_alone(spark):
    from flowlens.llm import sieve

    draw = np.random.default_rng(5)
    hashes = np.unique(draw.integers(-(1 << 63), 1 << 63, 400_000, dtype=np.int64))
    again, alone = hashes[::100], np.delete(hashes, np.s_[::100])
    rows = spark.createDataFrame([(part.tolist(),) for part in [*np.array_split(hashes, 7), again, again[:9]]], "found array<long>")

    def seen(batches):
        yield from sieve.dealt_whole(np.array(found.as_py()) for batch in batches for found in batch["found"])

    held = sieve.sieve_of_repeated(rows.mapInArrow(seen, "block int, buckets binary"))
    assert len(held) == 1 << (sieve.LEAST_BITS - 3)
    assert sieve.may_hold(held, again).all()
    # As many buckets as hashes, and most of these would pass if each that occurs once marked its bucket.
    assert sieve.may_hold(held, alone).mean() < 0.01
    nothing = sieve.sieve_of_repeated(rows.where("false").mapInArrow(seen, "block int, buckets binary"))
    assert not sieve.may_hold(nothing, hashes).any()
