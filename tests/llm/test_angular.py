"""Hard negatives against brute force, and the bounds against exact scores."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triplens.llm import angular

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x int, low double"
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100):
    """Python integers throughout; ties of score and id cannot be told apart in the result."""
    kept = []
    for vec_id, vector, label in rows:
        if label is not None and vector and all(v is not None and math.isfinite(v) for v in vector):
            kept.append((vec_id, [math.floor(256 * float(np.float32(v))) for v in vector], label))
    out = []
    for a, (vec_id, x, label) in enumerate(kept):
        if vec_id is None or vec_id % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), i is None, i or 0, b, i, m) for b, (i, y, m) in enumerate(kept) if b != a]
        scored.sort()
        for p in [s for s in scored if s[5] == label][:5]:
            wanted = [s for s in scored if s[5] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]]
            out += [(vec_id, p[4], rank, s[4], -p[0], -s[0]) for rank, s in enumerate(wanted[:5], 1)]
    return sorted(out, key=repr)


def found(spark, rows, every=100):
    df = spark.createDataFrame([(*row, "clash", 1, 2.0) for row in rows], SCHEMA).repartition(3)
    got = angular.mine(df, lambda i: i % every == 0, F.col("label"))
    assert got.columns == RESULT
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK_ROWS", 40), ("CHUNK_BLOCKS", 3), ("BLOCK_VISITS", 2), ("REFERENCES", 5)):
        monkeypatch.setattr(angular, name, value)


def test_clustered_rows(spark, small_blocks):
    """Copies, ties, near rows, and blocks that many anchors visit."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=8)).tolist(), int(rng.integers(4))) for i in range(300)]
    rows += [(i, rows[10][1], i % 3) for i in range(300, 500)]
    want = brute(rows, 50)
    assert len(want) > 100 and found(spark, rows, 50) == want


def test_odd_rows(spark, small_blocks):
    """Null, zero, short, huge and non-finite vectors, null labels and ids, repeated ids, labels without others."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist(), i % 3) for i in range(60)]
    rows += [(0, rows[5][1], 0), (0, rows[5][1], 1), (None, rows[6][1], 0), (None, rows[7][1], 1), (100, [0.0] * 4, 1), (200, [0.0] * 4, 2)]
    rows += [(300, rows[1][1], 9), (400, [-0.001] * 4, 0), (500, [30_000.0, 1.0, 2.0, 3.0], 1), (501, [29_000.0, 1.0, 2.0, 3.0], 2), (502, [31_000.0, 1.0, 2.0, 3.0], 1)]
    dropped = [(600, None, 1), (700, [1.0, None, 0.0, 0.0], 1), (800, [float("nan")] * 4, 1), (900, [float("inf")] * 4, 1), (1000, [1.0] * 4, None)]
    assert found(spark, rows + dropped, 100) == brute(rows, 100)
    more = [(1100, [1.0] * 3, 0), (1200, [], 0), (1300, [1e30] * 4, 0)]  # another length, empty, too long for scores
    assert found(spark, rows + more, 100) == brute(rows, 100)


def test_empty(spark):
    assert found(spark, []) == [] and found(spark, [(100, None, 1)]) == [] and found(spark, [(100, [1.0], 1)]) == []


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.integers(0, 2**32 - 1), st.sampled_from([1, 300, 2**20]), st.integers(1, 6))
def test_bounds_hold(size, seed, scale, references):
    """Scores lie within the bounds of their rows, and these within the bounds of a block."""
    rng = np.random.default_rng(seed)
    rows = np.floor(scale * rng.normal(size=(12, size)))
    rows[3], rows[4], rows[5] = rows[2], -rows[2], 0
    norms = np.sqrt((rows * rows).sum(axis=1))
    angles = angular.angles_to(rows, norms, angular.choose_references(rows, references))
    least, largest = angular.score_bounds(norms, angles, norms, norms, angles, angles)
    exact = angular.scores(rows, rows)
    assert (least <= exact).all() and (exact <= largest).all()
    block = slice(2, 9)
    low, high = angular.score_bounds(
        norms, angles, norms[block].min(keepdims=True), norms[block].max(keepdims=True),
        angles[block].min(axis=0)[None], angles[block].max(axis=0)[None],
    )
    assert (low[:, 0] <= exact[:, block].min(axis=1)).all() and (exact[:, block].max(axis=1) <= high[:, 0]).all()


def test_large_products_are_exact():
    rows = np.array([[2.0**29, 1.0], [2.0**29 - 1, 3.0]])
    assert angular.scores(rows, rows).tolist() == [[2**58 + 1, 2**29 * (2**29 - 1) + 3], [2**29 * (2**29 - 1) + 3, (2**29 - 1) ** 2 + 9]]


def test_bounds_skip_blocks(spark, small_blocks):
    """Of well separated groups an anchor visits few blocks only."""
    rng = np.random.default_rng(4)
    centres = np.eye(8)
    rows = [(i, (centres[i % 8] + 0.02 * rng.normal(size=8)).tolist(), i % 2, "", 0, 0.0) for i in range(1600)]
    df = spark.createDataFrame(rows, SCHEMA)
    integers = angular.integer_rows(df, F.col("label"), "vec_id", "embedding", 256).cache()
    blocks = angular.in_blocks(angular.measured(integers), lambda i: i % 100 == 0, 5).cache()
    ranges = angular.ranges_of(blocks, len(blocks.first().angles)).cache()
    anchors = blocks.where("anchor").withColumn("high", F.lit(math.inf)).drop("block", "anchor")
    visits = angular.visits(anchors, ranges, ranges.count())
    assert 16 <= visits.count() < 0.4 * 16 * ranges.count()
