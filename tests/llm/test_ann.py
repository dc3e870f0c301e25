"""Neighbours by the multi-index against brute force."""

import numpy as np

from triplens.llm import ann

SCHEMA = "vec_id long, embedding array<float>, id string, vector int"


def brute(rows, k):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for at in np.flatnonzero(ids % 50 == 0):
        score = (vectors * vectors[at]).sum(1) / (np.sqrt((vectors**2).sum(1)) * np.sqrt((vectors[at] ** 2).sum()))
        others = np.flatnonzero(ids != ids[at])
        order = others[np.lexsort((ids[others], -score[others]))][:k]
        out[int(ids[at])] = [(int(ids[o]), float(score[o])) for o in order]
    return out


def found(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA).repartition(4)
    out = {}
    for r in sorted(ann.search(df, lambda i: i % 50 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_walk_is_in_order_of_distance():
    rng = np.random.default_rng(5)
    first, second = rng.random(9), rng.random(7)
    cells = ann.walk(first, second, np.ones((9, 7), int), 63)
    sums = [first[i] + second[j] for i, j in cells]
    assert len(set(cells)) == 63 and np.all(np.diff(sums) >= 0)


def test_recall_scores_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ENTRIES", 100)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * rng.normal(size=16)).tolist()) for i in range(1200)]
    rows += [(i, rows[0][1]) for i in range(1200, 1600)]  # many copies of one vector
    got, want = found(spark, rows), brute(rows, 5)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert [i for i, _ in got[0]] == [1200, 1201, 1202, 1203, 1204]
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, near in got.items():
        for i, score in near:
            a, b = vectors[q], vectors[i]
            assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    want, got = brute(rows, 5), {}
    for r in ann.search(df, lambda i: i % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in near}) for q, near in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 2.0])]
    odd = [(50, None), (100, []), (150, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    got = found(spark, good + odd)
    assert {q: [i for i, _ in near] for q, near in got.items()} == {0: [1, 2]}
    assert found(spark, []) == {} and found(spark, odd[:2]) == {} and found(spark, good[:1]) == {}
