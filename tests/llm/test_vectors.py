import numpy as np
import pytest
from pyspark.sql import functions as F

from vidstrata.llm import vector_search


def expected(ids, vectors, asked, k):
    out = set()
    for i in asked:
        scores = vectors @ vectors[i]
        best = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out |= {(int(ids[i]), n + 1, int(ids[j]), int(scores[j])) for n, j in enumerate(best)}
    return out


@pytest.mark.parametrize("peak", [3, 1 << 27])
def test_top_k_equals_brute_force(spark, monkeypatch, peak):
    for name, size in (("SHARD_ROWS", 90), ("QUERY_ROWS", 7), ("LEAF_ROWS", 8)):
        monkeypatch.setattr(vector_search, name, size)
    rng = np.random.default_rng(0)
    vectors = rng.integers(-peak, peak, (400, 5))
    vectors[50:200] = vectors[0]  # a common vector: ties go by id
    ids = rng.permutation(400)
    frame = spark.createDataFrame([(int(i), [int(x) for x in v], "own") for i, v in zip(ids, vectors, strict=True)], "vec_id long, vector array<long>, query string")
    found = vector_search.top_k(frame, frame.where("vec_id % 20 = 0"), k=20).collect()
    assert {tuple(r) for r in found} == expected(ids, vectors, np.flatnonzero(ids % 20 == 0), 20)
    assert len(found) == 400


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [-0.3, 1.0]), (6, [1.0]), (7, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = frame.select("vec_id", vector_search.whole_vector(F.col("embedding"), 64).alias("vector"))
    found = vector_search.top_k(vectors, vectors.where("vec_id in (0, 1, 3)"), k=20).collect()
    x = 64 * -20 + 32 * 64  # floor(64 * -0.3) = -20
    assert sorted(tuple(r) for r in found) == [(0, 1, 6, 4096), (0, 2, 5, x), (0, 3, 7, 0)]


def test_repeated_rows(spark):
    frame = spark.createDataFrame([(0, [1]), (0, [1]), (1, [2]), (1, [2])], "vec_id long, vector array<long>")
    found = vector_search.top_k(frame, frame.where("vec_id = 0"), k=5).collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 1, 2), (0, 2, 1, 2)]


def test_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1])], "vec_id long, vector array<long>")
    assert vector_search.top_k(frame.where("false"), frame, k=5).collect() == []
    assert vector_search.top_k(frame, frame.where("false"), k=5).collect() == []
    assert vector_search.top_k(frame, frame, k=5).collect() == []


def test_closed_branches_cost_nothing():
    """Far groups of vectors: of most boxes not even the bound is worked out."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(-1000, 1000, (16, 1, 6)) * 100 + rng.integers(-20, 20, (16, 64, 6))
    vectors = vectors.reshape(-1, 6)
    leaves = vector_search.leaves_of(vectors, 8)
    assert len(leaves) == 128 and sorted(np.concatenate(leaves)) == list(range(1024))
    tree = vector_search.Tree([(x, vectors[x]) for x in leaves])
    asked = np.arange(0, 1024, 8)
    scores, ids = tree.search(asked, vectors[asked], np.full(len(asked), vector_search.LOWEST), 5)
    found = {(i, n + 1, int(ids[j, n]), int(scores[j, n])) for j, i in enumerate(asked) for n in range(5)}
    assert found == expected(np.arange(1024), vectors, asked, 5)
    assert tree.opened < 255 * len(asked) / 4
    # a k-th score from elsewhere that nothing reaches: the root's box alone is looked at
    tree.opened = 0
    scores, _ = tree.search(asked, vectors[asked], np.full(len(asked), 1 << 60), 5)
    assert (scores == vector_search.LOWEST).all() and tree.opened == len(asked)


def test_shards_out_of_reach_are_left_out(spark):
    boxes = spark.createDataFrame([(0, [-1, 2], [3, 4]), (1, [0, 0], [0, 0])], "shard int, low array<long>, high array<long>")
    rows = [(s, [2, -1], kth) for s in (0, 1) for kth in (int(vector_search.LOWEST), 0, 1, 4, 5)] + [(0, [1], 3), (0, [1], 4), (1, [], 0)]
    given = spark.createDataFrame(rows, "shard int, vector array<long>, kth long")
    kept = [(r.shard, list(r.vector), r.kth) for r in vector_search.reaching(given, boxes).collect()]
    best = {(0, (2, -1)): 4, (1, (2, -1)): 0, (0, (1,)): 3, (1, ()): 0}
    assert sorted(kept) == sorted((s, v, kth) for s, v, kth in rows if best[s, tuple(v)] >= kth)


def test_each_tree_is_built_once(spark, monkeypatch):
    """Whatever the number of queries and rounds, every vector is in one leaf of one written tree."""
    monkeypatch.setattr(vector_search, "SHARD_ROWS", 30)
    monkeypatch.setattr(vector_search, "LEAF_ROWS", 4)
    built = []
    planted = vector_search.planted
    monkeypatch.setattr(vector_search, "planted", lambda *a: built.append(planted(*a)) or built[-1])
    rng = np.random.default_rng(2)
    vectors = rng.integers(-9, 9, (300, 4))
    frame = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, vector array<long>")
    found = vector_search.top_k(frame, frame.where("vec_id % 3 = 0"), k=4).collect()
    assert {tuple(r) for r in found} == expected(np.arange(300), vectors, np.arange(0, 300, 3), 4)
    assert len(built) == 1
    ids = np.concatenate([np.frombuffer(r.ids, dtype=np.int64) for r in built[0].collect()])
    assert sorted(ids) == list(range(300))
    assert built[0].agg(F.max(F.length("ids"))).first()[0] <= 4 * 8
