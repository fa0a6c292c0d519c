import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vidstrata.llm import lattice
from vidstrata.llm.components import components


def test_neighbours_are_the_shortest_points():
    moves = lattice.neighbours()
    assert len(np.unique(moves, axis=0)) == 240
    assert ((moves**2).sum(axis=1) == 2).all()
    assert (lattice.nearest_point(moves) == moves).all()


def test_nearest_point():
    x = np.random.default_rng(0).normal(size=(2000, 8)) * 3
    point = lattice.nearest_point(x)
    whole = (point == np.rint(point)).all(axis=1)
    assert (whole | (point - 0.5 == np.rint(point - 0.5)).all(axis=1)).all()
    assert (point.sum(axis=1) % 2 == 0).all()
    own = ((x - point) ** 2).sum(axis=1)
    assert own.max() <= 1 + 1e-9  # the lattice's covering radius
    other = ((x[:, None] - point[:, None] - lattice.neighbours()[None]) ** 2).sum(axis=2)
    assert (own <= other.min(axis=1) + 1e-9).all()


def test_names_of_neighbouring_cells():
    """A vector moved by a lattice step has the name that its neighbour probed."""
    tables = lattice.Lattices(1000, 16, tables=2, probes=5)
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(50, 16))
    tables.projections = [np.eye(16)[:, : 8 * tables.groups] for _ in range(2)]
    names = tables.cells(unit, 1)
    x = (unit @ tables.projections[1] + tables.offsets[1]).reshape(50, tables.groups, 8)
    gain = ((x - lattice.nearest_point(x)) @ tables.moves.T).reshape(50, -1)
    for i in range(50):
        best = np.argsort(-gain[i])[:5]
        moved = []
        for step in best:
            v = unit[i].copy()
            g = step // 240
            v[8 * g : 8 * g + 8] += tables.moves[step % 240]
            moved.append(tables.cells(v[None], 1)[0, 0])
        assert set(moved) == set(names[i, 1:])


def brute(ids, vectors, least):
    """{row: (links, component)} over rows whose vectors take part."""
    width = max((len(v) for v in vectors if v is not None), default=1)
    x = np.zeros((len(ids), width))
    part = np.zeros(len(ids), bool)
    for i, v in enumerate(vectors):
        if v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x[i, : len(v)], part[i] = np.float32(v), True
    norm = np.linalg.norm(x, axis=1)
    x[part] /= norm[part, None]
    near = (x @ x.T >= least) & part & part[:, None]
    np.fill_diagonal(near, False)
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(near), strict=True):
        root[top(a)] = top(b)
    members = {}
    for i in range(len(ids)):
        members.setdefault(top(i), []).append(ids[i])
    return [(ids[i], int(near[i].sum()), min(members[top(i)])) for i in range(len(ids))]


def planted(seed=0):
    """Vectors with groups at growing distances, chains and repeats."""
    rng = np.random.default_rng(seed)
    out = [v for v in rng.normal(size=(700, 24))]
    for spread in (0.02, 0.1, 0.2, 0.3):
        for size in (2, 3, 40):
            base = rng.normal(size=24)
            out += [base + spread * np.linalg.norm(base) / np.sqrt(24) * rng.normal(size=24) for _ in range(size)]
    at = rng.normal(size=24)
    for _ in range(20):  # a chain
        out.append(at)
        at = at + 0.28 * np.linalg.norm(at) / np.sqrt(24) * rng.normal(size=24)
    out += [out[5]] * 30 + [out[5] * 2, out[6] * 0.5, -out[7]]
    return [[float(np.float32(c)) for c in v] for v in out]


ODD = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0], [2.0, 0.0], [-0.0, 3.0], [0.0, 1.0], [3e38] * 24, [1e-40] * 24]


@pytest.mark.parametrize("block", [lattice.BLOCK, 8])
def test_links_and_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "ROOTS", 1)
    vectors = planted() + ODD
    ids = [int(i) for i in np.random.default_rng(3).permutation(len(vectors)) * 3]
    rows = [(i, v, "own", 1, 2) for i, v in zip(ids, vectors, strict=True)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string, component_id int, n_links int").repartition(3)
    found = lattice.near_duplicates(given, block=block).collect()
    want = brute(ids, vectors, 0.95)
    assert sum(r[1] for r in want) > 3000
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert len(found) == len(want)
    # recall against brute force: what is found is right, and next to all of it is found
    links = sum(r[1] for r in want)
    assert all(got[i][0] <= n for i, n, _ in want)
    assert sum(n for n, _, _ in got.values()) >= 0.98 * links
    assert sum(got[i] == (n, c, i == c) for i, n, c in want) >= 0.98 * len(want)


def test_recall_at_the_limit():
    """Pairs exactly at the limit: the hardest ones."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(axis=1)[:, None] * a
    z /= np.linalg.norm(z, axis=1)[:, None]
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * z
    for rows in (10_000, 100_000_000):
        tables = lattice.Lattices(rows, 64)
        met = np.zeros(len(a), bool)
        for t in range(tables.tables):
            x, y = tables.cells(a, t), tables.cells(b, t)
            met |= (x == y[:, :1]).any(axis=1) | (y == x[:, :1]).any(axis=1)
        assert met.mean() >= 0.9


def test_strangers_seldom_meet():
    """A vector meets a few others in all tables."""
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(20_000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    tables = lattice.Lattices(len(unit), 64)
    meetings = 0
    for t in range(tables.tables):
        names = tables.cells(unit, t)
        own, sizes = np.unique(names[:, 0], return_counts=True)
        at = np.minimum(np.searchsorted(own, names), len(own) - 1)
        meetings += (sizes[at] * (own[at] == names)).sum() - len(unit)
    assert meetings < 10 * len(unit)


def test_blocks_without_a_look(spark):
    """Tight blocks are all links and far ones none; no tile is left to compare."""
    rng = np.random.default_rng(8)
    near = np.eye(16)[0] + 0.01 * rng.normal(size=(90, 16))
    far = np.eye(16)[1] + 0.01 * rng.normal(size=(90, 16))
    vectors = {i: v for i, v in enumerate(np.concatenate([near, far]).tolist())}
    frame = spark.createDataFrame([(1, b, 2, int(i), 3, vectors[i]) for i in vectors for b in [int(i >= 90)]], "group long, block int, blocks int, node long, weight long, vector array<double>")
    ball = lattice.balls(frame, 16)
    a = ball.select("group", F.col("block").alias("low"), *[F.col(c).alias(f"a_{c}") for c in ("centre", "radius", "weight", "least")])
    b = ball.select("group", F.col("block").alias("high"), *[F.col(c).alias(f"b_{c}") for c in ("centre", "radius", "weight", "least")])
    found = lattice.judged(a.join(b, "group").where("low <= high"), 0.95, 16).collect()
    assert {(r.low, r.high): r.verdict for r in found} == {(0, 0): 1, (1, 1): 1, (0, 1): -1}


def test_forest():
    root = lattice.forest(np.arange(8), np.array([0, 5, 2, 3]), np.array([4, 4, 3, 6]))
    assert root.tolist() == [0, 1, 2, 2, 0, 0, 2, 7]
    assert lattice.forest(root, np.array([7]), np.array([6])).tolist() == [0, 1, 2, 2, 0, 0, 2, 2]


def test_unit_rows_of_any_length():
    got = lattice.unit_rows(pa.array([[3.0, 4.0], [1e300], [1e-320, 0.0]]), 3)
    assert np.allclose(got, [[0.6, 0.8, 0], [1, 0, 0], [1, 0, 0]])


def test_repeated_ids_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (None, [0.0, 2.0]), (None, None)]
    found = lattice.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in found) == [
        ("1", 0, 1, True), ("1", 2, 1, True), ("2", 2, 1, False), ("None", 0, None, True), ("None", 2, 1, False)
    ]
    assert lattice.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    none = lattice.near_duplicates(spark.createDataFrame([(1, None), (2, [])], schema)).collect()
    assert {tuple(r) for r in none} == {(1, 0, 1, True), (2, 0, 2, True)}


def test_components_of_forests(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8)], "node long, root long")
    assert {tuple(r) for r in components(edges, "node", "root").collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}
