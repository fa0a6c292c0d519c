import numpy as np
from pyspark.sql import functions as F

from vidstrata.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, component string, whitened int"


def whole(frame):
    return frame.select("*", whitening.on_grid(F.col("embedding"), 1024, 100_000).alias("vector"))


def check(spark, vectors, components=8, parts=3):
    rows = [(i, v, 1, "own", 2) for i, v in enumerate(vectors)]
    found = whitening.whiten(whole(spark.createDataFrame(rows, SCHEMA).repartition(parts)), components).collect()
    kept = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(vectors[i]) for i in kept), default=0)
    x = np.zeros((len(kept), width), dtype=np.int64)
    for row, i in enumerate(kept):
        x[row, : len(vectors[i])] = np.floor(1024 * np.float32(vectors[i]).astype(np.float64)) + 100_000
    return found, kept, x


def test_components_equal_an_eigendecomposition(spark):
    rng = np.random.default_rng(0)
    made = rng.normal(size=(400, 12)) * np.linspace(3, 0.2, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    vectors = [[float(c) for c in np.float32(v)] for v in made] + [None, [None] * 12, [float("nan")] * 12, [float("-inf")] + [0.0] * 11]
    vectors += vectors[:3]
    found, kept, x = check(spark, vectors)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert {(r.vec_id, r.component) for r in found} == {(i, c) for i in kept for c in range(1, 9)}
    signs = {}
    for r in found:
        row = kept.index(r.vec_id)
        assert r.n == n
        assert r.deviation == ((n * x[row] - sums) ** 2).sum()
        want = centred[row] @ axes[:, r.component - 1] / np.sqrt(values[r.component - 1])
        sign = signs.setdefault(r.component, 1 if abs(r.whitened - want) <= abs(r.whitened + want) else -1)
        assert abs(r.whitened - sign * want) < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12
        assert r.identity_error < 1e-9


def test_ill_conditioned_and_flat_directions(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-1000, 1000, (300, 3)) / 1024.0
    made = np.concatenate([base * [1000, 1, 1], base[:, :1] * 2, np.full((300, 2), 0.25)], axis=1)
    found, _, x = check(spark, made.tolist())
    assert {r.component for r in found} == {1, 2, 3}  # one direction repeats another, two have no spread
    assert max(r.identity_error for r in found) < 1e-4
    scaled = np.array([[r.whitened for r in sorted(found, key=lambda r: (r.vec_id, r.component))]]).reshape(300, 3)
    assert np.abs(scaled.T @ scaled / 300 - np.eye(3)).max() < 1e-4


def test_alike_rows_have_no_components(spark):
    for vectors in ([[1.0, 2.0]] * 5, [[1.0, 2.0]], [None], [[], []]):
        assert check(spark, vectors)[0] == []
    assert whitening.whiten(whole(spark.createDataFrame([], SCHEMA))).collect() == []


def test_short_and_huge_vectors(spark):
    found, _, x = check(spark, [[1.0, 2.0], [1.5], [], [0.0, -1.0]], components=2)
    want = {(i, c) for i in range(4) for c in (1, 2)}
    assert {(r.vec_id, r.component) for r in found} == want
    huge = spark.createDataFrame([(0, [3e38]), (1, [-3e38]), (2, [1.0])], "vec_id long, embedding array<float>")
    found = whitening.whiten(whole(huge)).collect()
    assert [r.deviation for r in found if r.vec_id < 2] == [None, None]
    assert all(abs(r.identity_error) < 1e-4 for r in found)


def test_solve_right():
    rng = np.random.default_rng(2)
    upper = np.triu(rng.normal(size=(6, 6))) + 4 * np.eye(6)
    rows = rng.normal(size=(10, 6))
    assert np.allclose(whitening.solve_right(rows, upper) @ upper, rows)
