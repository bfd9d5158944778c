"""Tree search against all distances."""

import math

import numpy as np
from signpost.llm import kmeans_tree
from signpost.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, leaf string"


def exact(rows, every=100, k=10):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        away = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        away[q] = math.inf
        order = np.lexsort((ids, away))[: min(k, len(ids) - 1)]
        out[int(ids[q])] = [(int(ids[i]), float(away[i])) for i in order]
    return out


def collect(frame, **more):
    found = {}
    for r in sorted(kmeans_tree.nearest(frame, **more).collect()):
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


def recall(got, want):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def vectors(n, seed=1, dim=8):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=dim).astype(np.float32).tolist()) for i in range(n)]


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_SAMPLE", 20)
    monkeypatch.setattr(kmeans_tree, "BLOCK", 64)
    rows = vectors(3000)
    got, want = collect(spark.createDataFrame([(*r, "x") for r in rows], KIND)), exact(rows)
    assert recall(got, want) >= 0.9
    place = dict(rows)
    for q, found in got.items():
        for i, score in found:
            assert abs(score - math.dist(place[q], place[i])) < 1e-12


def test_ties_go_to_smaller_ids(spark):
    """A vector that most rows have."""
    rows = [(i, [1.0, 2.0]) for i in range(900)] + [(1000 + i, [float(i), -1.0]) for i in range(50)]
    got = collect(spark.createDataFrame([(*r, "x") for r in rows], KIND))
    assert [i for i, _ in got[0]] == list(range(1, 11)) and [i for i, _ in got[500]] == list(range(10))
    assert got == exact(rows)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0])]
    rows += [(None, [1.0, 1.0]), (7, [1.0]), (100, [0.0, 0.0]), (1, [0.0, 1.0]), (200, None), (8, [2.0, 0.0])]
    got = collect(spark.createDataFrame([(*r, "x") for r in rows], KIND))
    assert got == {0: [(8, 1.0), (1, math.sqrt(2))]}
    assert collect(spark.createDataFrame([], KIND)) == {}
    assert collect(spark.createDataFrame([(0, [1.0], "x")], KIND)) == {}


def test_best_bin_first_visits_every_leaf():
    data = np.array([v for _, v in vectors(2000)])
    tree, leaves = kmeans_tree.fit(data)
    assert leaves > 10
    assert sorted(kmeans_tree.leaves_by_promise(tree, data[0])) == list(range(leaves))
    filed = kmeans_tree.file_all(tree, data)
    assert all(next(kmeans_tree.leaves_by_promise(tree, data[i])) == filed[i] for i in range(100))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = {}
    for r in QUERIES["op5_nearest"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(got, exact([tuple(r) for r in rows])) >= 0.9
