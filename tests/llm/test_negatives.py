"""Hard negatives against all scores by hand."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from flowlens.llm import common, negatives

ROWS = "vec_id long, label int, embedding array<float>"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def brute(rows):
    used = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, label, v in {(i, n, tuple(v)): (i, n, v) for i, n, v in used if i % 50 == 0}.values():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, n) for i, n, w in used if i != a and len(w) == len(v)]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            hits = sorted(
                s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score
            )[:3]
            out += [(a, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(hits, 1)]
    return sorted(out)


def found(spark, rows, schema=ROWS):
    result = negatives.hard_negatives(spark.createDataFrame(rows, schema))
    assert result.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"),
        ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    return sorted(map(tuple, result.collect()))


def vectors(seed, count, width, scale=1.0):
    rng = random.Random(seed)
    return [(i, rng.randint(0, 2), [rng.gauss(0.2, 1) * scale for _ in range(width)]) for i in range(count)]


@pytest.mark.parametrize("slice_bytes", [200, 8 << 20])
def test_equals_all_scores_by_hand(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(negatives, "SLICE_BYTES", slice_bytes)
    rows = vectors(1, 320, 6)
    rows += [(i, i % 3, [0.5] * 6) for i in range(400, 520)]  # a very common vector
    want = brute(rows)
    assert len(want) > 30 and found(spark, rows) == want


def test_nulls_lengths_ties_and_repeated_rows(spark):
    rows = vectors(2, 120, 4) + vectors(3, 60, 3)
    rows += [(None, 1, [1.0] * 4), (150, None, [1.0] * 4), (200, 1, None), (250, 1, [1.0, None, 1.0, 1.0])]
    rows += [(300, 1, [1.0, math.nan, 1.0, 1.0]), (350, 1, [math.inf] * 4), (400, 1, []), (450, 2, []), (3, 1, [])]
    rows += [(100, 0, [1.0, 0.5, 0.25, 0.0])] * 2 + [(101, 0, [0.9, 0.5, 0.0, 0.0])] * 2
    rows += [(102 + i, 1, [0.7, 0.2, 0.0, 0.1]) for i in range(6)]
    want = brute(rows)
    assert found(spark, rows) == want
    wider = [row + (1, 2) for row in rows]
    assert found(spark, wider, ROWS + ", anchor int, place int") == want


def test_components_beyond_a_double_are_exact(spark):
    """Products that need more than 53 bits go through unbounded integers."""
    rows = vectors(4, 60, 3, 50_000.0)
    want = brute(rows)
    assert want and max(row[4] for row in want) > 1 << 47
    assert found(spark, rows) == want
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, vectors(5, 60, 3, 1e30))


def test_no_rows_and_no_anchors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, 1, [1.0])]) == []


def test_fields_of_a_packed_word_do_not_touch():
    rng = np.random.default_rng(1)
    for reach in (1, 3, 200, 1 << 20):
        candidates = rng.integers(-reach, reach + 1, (37, 8)).astype(float)
        anchors = rng.integers(-reach, reach + 1, (5, 8)).astype(float)
        packed = negatives.Packed(candidates, np.abs(anchors).max(axis=0))
        assert (packed.scores(anchors) == anchors.astype(int) @ candidates.astype(int).T).all()
    small = negatives.Packed(np.ones((10, 4)), np.ones(4))
    assert small.fields > 4
