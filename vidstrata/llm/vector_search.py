"""Exact top-k by inner product with a KD-tree per shard.

Vectors are dealt into shards of about ``SHARD_ROWS`` rows. A shard's tree splits at the median of its
widest axis down to leaves of at most ``LEAF_ROWS`` rows; it is built once and written, a row for each
leaf. Each node has its tight box: a query's inner product with anything in it is at most the sum of the
better corner on each axis.

Every query starts at a shard of its own, then meets the next three, the next twelve and so on. Its k-th
score so far goes with it from round to round, and shards whose whole box can not reach it are left out
before rows are shuffled. A task has one tree at a time and lets blocks of up to ``QUERY_ROWS`` queries
stream through it, best box first: of each query's open nodes the one with the best bound is opened or,
if it is a leaf, scored, until no bound reaches the k-th score. What lies below a node that is never
opened costs nothing.

Vectors are whole numbers. Null vectors and vectors with null or non-finite components take no part;
shorter vectors count as ending in zeros. Ties go to the smaller id. Repeated rows are candidates each; a
query repeated with the same vector is answered once. A query meets no row of its own id. Without
candidates or queries the result is empty. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vidstrata.llm.common import shuffle_partitions, small_batches, stored

SHARD_ROWS = 8192
LEAF_ROWS = 128
QUERY_ROWS = 2048
WIDER = 4  # shards met after a round, as a multiple of those met before it
LOWEST = np.iinfo(np.int64).min
EXACT = float(1 << 53)


def whole_vector(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    ends = np.cumsum(sizes)
    for i, (size, end) in enumerate(zip(sizes, ends, strict=True)):
        out[i, :size] = flat[end - size : end]
    return out


def leaves_of(vectors: np.ndarray, leaf_rows: int) -> list[np.ndarray]:
    """Rows of each leaf, from median splits; a power of two of them, none empty (``leaf_rows`` of 2 or more)."""
    parts = [np.arange(len(vectors))]
    while max(map(len, parts)) > leaf_rows:
        below = []
        for rows in parts:
            own = vectors[rows]
            axis = int((own.max(axis=0) - own.min(axis=0)).argmax()) if own.shape[1] else 0
            middle = len(rows) // 2
            if own.shape[1]:
                rows = rows[np.argpartition(own[:, axis], middle)]
            below += [rows[:middle], rows[middle:]]
        parts = below
    return parts


class Tree:
    """Leaves (ids, vectors) of a shard and the boxes of all nodes; node i has nodes 2 i + 1 and 2 i + 2 below it."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray]]):
        self.leaves = leaves
        low, high = [np.stack([v.min(axis=0) for _, v in leaves])], [np.stack([v.max(axis=0) for _, v in leaves])]
        while len(low[0]) > 1:
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.largest = float(max(np.abs(self.low[:1]).max(initial=0), np.abs(self.high[:1]).max(initial=0)))
        self.opened = 0  # pairs of query and box that were worked out

    def search(self, own_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the best k rows of each query at least as good as its kth; LOWEST where there are fewer."""
        peak = float(np.abs(queries).max(initial=0)) * self.largest * max(queries.shape[1], 1)
        kind = np.float64 if peak < EXACT else np.int64
        q, low, high = queries.astype(kind), self.low.astype(kind), self.high.astype(kind)
        leaves = [(ids, vectors.T.astype(kind)) for ids, vectors in self.leaves]
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        n, first_leaf = len(q), len(leaves) - 1
        scores = np.full((n, k), LOWEST, dtype=np.int64)
        ids = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)
        kth = kth.copy()
        bounds = np.full((n, len(low)), LOWEST, dtype=np.int64)  # of open nodes

        def add(rows: np.ndarray, nodes: np.ndarray) -> None:
            bound = np.einsum("ij,ij->i", up[rows], high[nodes]) + np.einsum("ij,ij->i", down[rows], low[nodes])
            bounds[rows, nodes] = bound.astype(np.int64)
            self.opened += len(rows)

        rows = np.arange(n)
        add(rows, np.zeros(n, dtype=np.int64))
        node = np.zeros(n, dtype=np.int64)
        while len(rows):
            # from the best open node on, until the best one is a leaf
            inner = rows
            while len(inner):
                node[inner] = bounds[inner].argmax(axis=1)
                best = bounds[inner, node[inner]]
                reaches = (best > LOWEST) & (best >= kth[inner])
                node[inner[~reaches]] = -1
                inner = inner[reaches & (node[inner] < first_leaf)]
                bounds[inner, node[inner]] = LOWEST
                add(inner, 2 * node[inner] + 1)
                add(inner, 2 * node[inner] + 2)
            rows = rows[node[rows] >= 0]
            bounds[rows, node[rows]] = LOWEST
            by_leaf = rows[np.argsort(node[rows], kind="stable")]
            at = np.flatnonzero(np.diff(node[by_leaf])) + 1
            for some in np.split(by_leaf, at) if len(by_leaf) else []:
                names, vectors = leaves[node[some[0]] - first_leaf]
                found = (q[some] @ vectors).astype(np.int64)
                found[own_ids[some][:, None] == names[None, :]] = LOWEST
                most = found.max(axis=1)
                hit = (most >= kth[some]) & (most > LOWEST)
                some, found = some[hit], found[hit]
                if not len(some):
                    continue
                every = np.concatenate([scores[some], found], axis=1)
                named = np.concatenate([ids[some], np.broadcast_to(names, found.shape)], axis=1)
                take = np.lexsort((named, ~every), axis=1)[:, :k]  # ~x falls as x rises, without overflow
                scores[some] = np.take_along_axis(every, take, axis=1)
                ids[some] = np.take_along_axis(named, take, axis=1)
                kth[some] = np.maximum(kth[some], scores[some, k - 1])
        return scores, ids


def planted(rows: DataFrame, width: int) -> DataFrame:
    """(shard, leaf, ids, vectors, low, high): the tree of each shard; the box of all of it is with its first leaf."""
    leaf_rows = LEAF_ROWS

    def build(key, table):
        ids, vectors = table.column("vec_id").to_numpy(), matrix(table.column("vector"), width)
        leaves = leaves_of(vectors, leaf_rows)
        others = [None] * (len(leaves) - 1)
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()] * len(leaves), type=pa.int32()),
                "leaf": pa.array(range(len(leaves)), type=pa.int32()),
                "ids": pa.array([ids[x].astype(np.int64).tobytes() for x in leaves], type=pa.binary()),
                "vectors": pa.array([vectors[x].tobytes() for x in leaves], type=pa.binary()),
                "low": pa.array([vectors.min(axis=0).tolist(), *others], type=pa.list_(pa.int64())),
                "high": pa.array([vectors.max(axis=0).tolist(), *others], type=pa.list_(pa.int64())),
            }
        )

    schema = "shard int, leaf int, ids binary, vectors binary, low array<bigint>, high array<bigint>"
    return stored(rows.select("shard", "vec_id", "vector").groupBy("shard").applyInArrow(build, schema), "trees")


def reaching(asked: DataFrame, boxes: DataFrame) -> DataFrame:
    """Rows of ``asked`` (shard, vector, kth) whose shard may hold a score of kth or more."""
    sides = F.arrays_zip("vector", "low", "high")
    ends = [(lambda z, side=side: F.coalesce(z["vector"].cast("double") * z[side].cast("double"), F.lit(0.0))) for side in ("low", "high")]
    best = F.aggregate(F.transform(sides, lambda z: F.greatest(*(e(z) for e in ends))), F.lit(0.0), lambda a, b: a + b)
    # doubles are rounded: a bound within that error counts as reaching
    sizes = F.aggregate(F.transform(sides, lambda z: F.greatest(*(F.abs(e(z)) for e in ends))), F.lit(0.0), lambda a, b: a + b)
    return asked.join(boxes, "shard").where(best + sizes * 1e-9 >= F.col("kth")).drop("low", "high")


def searched(trees: DataFrame, wanted: DataFrame, width: int, k: int, tasks: int) -> DataFrame:
    """(query, query_id, vec_id, score): the rows of ``wanted`` stream through the tree of their shard."""
    spark = trees.sparkSession
    no_query = [F.lit(None).cast(t).alias(c) for c, t in (("query", "long"), ("vec_id", "long"), ("kth", "long"), ("vector", "array<bigint>"))]
    no_leaf = [F.lit(None).cast(t).alias(c) for c, t in (("leaf", "int"), ("ids", "binary"), ("vectors", "binary"))]
    both = trees.select("shard", F.lit(0).alias("kind"), "leaf", "ids", "vectors", *no_query).unionByName(
        wanted.select("shard", F.lit(1).alias("kind"), *no_leaf, "query", "vec_id", "kth", "vector")
    )
    both = both.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions("shard", "kind", "leaf")
    small_batches(spark, QUERY_ROWS)

    def run(batches: Iterator):
        current, leaves, tree = None, [], None
        for batch in batches:
            shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(shards)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if current != shards[a]:
                    current, leaves, tree = shards[a], [], None
                if not kinds[a]:
                    for ids, vectors in zip(part.column("ids").to_pylist(), part.column("vectors").to_pylist(), strict=True):
                        ids = np.frombuffer(ids, dtype=np.int64)
                        leaves.append((ids, np.frombuffer(vectors, dtype=np.int64).reshape(len(ids), width)))
                    continue
                if not leaves:  # no vector was dealt to this shard
                    continue
                tree = tree or Tree(leaves)
                own, ids = part.column("query").to_numpy(), part.column("vec_id").to_numpy()
                scores, names = tree.search(ids, matrix(part.column("vector"), width), part.column("kth").to_numpy(), k)
                row, at = np.nonzero(scores > LOWEST)
                found = [own[row], ids[row], names[row, at], scores[row, at]]
                yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in found], names=["query", "query_id", "vec_id", "score"])

    return both.mapInArrow(run, "query bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(query_id, rank, vec_id, score) over columns ``vec_id`` and ``vector`` (array of long) of both tables."""
    spark = vectors.sparkSession
    usable = F.col(vector).isNotNull() & F.col(vec_id).isNotNull()
    rows = vectors.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    rows = stored(rows.withColumn("place", F.xxhash64(F.monotonically_increasing_id())), "vectors")
    asked = queries.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    asked = stored(asked.distinct().withColumn("query", F.xxhash64("vec_id", "vector")), "queries")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).collect()[0]
    asked_width = asked.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).collect()[0][0]
    shards = max(-(-size.n // SHARD_ROWS), 1)
    width = max(size.width, asked_width)
    tasks = min(shards, shuffle_partitions(spark))
    trees = planted(rows.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int")), width)
    boxes = trees.where("leaf = 0").select("shard", "low", "high")

    best, met, until = None, 0, 1
    in_order = W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    while met < shards:
        # shards [met, until) as each query counts them from its own
        step = F.explode(F.sequence(F.lit(met), F.lit(until - 1))).alias("step")
        wanted = asked.withColumn("kth", F.lit(int(LOWEST)))
        if best is not None:
            known = best.where(F.col("rank") == k).select(F.col("query").alias("of"), F.col("score").alias("least"))
            wanted = asked.join(known, F.col("query") == F.col("of"), "left").withColumn("kth", F.coalesce("least", F.lit(int(LOWEST))))
        wanted = wanted.select("query", "vec_id", "vector", "kth", step)
        wanted = wanted.withColumn("shard", F.pmod(F.pmod("query", F.lit(shards)) + F.col("step"), F.lit(shards)).cast("int"))
        if best is not None:
            wanted = reaching(wanted, boxes)
        found = searched(trees, wanted, width, k, tasks)
        if best is not None:
            found = best.drop("rank").unionByName(found)
        ranked = found.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)
        best = stored(ranked, "nearest")
        met, until = until, min(until * WIDER, shards)
    return best.select("query_id", "rank", "vec_id", "score")
