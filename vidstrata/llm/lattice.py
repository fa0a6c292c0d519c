"""Near duplicates among vectors by lattice hashing.

1. Rows with the same vector make a class; from here on a class counts as one vector with its number of rows.
2. Each of several tables projects the unit vectors to groups of 8 dimensions at random and decodes every group
   to its nearest point of the E8 lattice. The points together name the vector's cell. Besides its own cell
   a vector also enters the ``PROBES`` neighbouring ones that it lies nearest to (one group moved to a neighbouring
   lattice point). The lattice's scale follows from the number of vectors: a vector of no near duplicate
   meets some ``MEETINGS`` others in all tables together, at any size; the number of tables grows with its logarithm.
3. Vectors that share a cell are compared by their cosine in double precision. What links within a cell is
   handed on as a spanning forest, not as pairs, and the components of all forests are the classes' components.
4. Links run within components only. So each component is compared within itself, every vector with every
   other, and counts its links: a link that no table has found counts as well, once its ends are in one component.

Cells and components of more than ``BLOCK`` vectors are cut into blocks by the hash of the vector, of as many vectors or, in
very large groups, of some roots of the group's size, so that blocks and pairs of blocks stay few. Blocks are compared by their
centres first: when the angles between the centres and to the farthest members leave no doubt, all
or none of the pairs are links without a look at them. What is left is compared block against block, a task for
each pair. Pairs of vectors are never rows.

Vectors that are null, all zeros, or hold null or non-finite components link with nothing and are components
of their own. Shorter vectors count as ending in zeros. A vector's multiples are other vectors of cosine 1. Rows that
repeat a vector link with each other. Rows may share an id; a null id is never a component's smallest unless no row has one.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import in_arrow, mix, pa_schema, stored
from vidstrata.llm.components import components

TABLES = 16
TABLES_A_DECADE = 8
BASE_ROWS = 1e5
PROBES = 3
MEETINGS = 4.0
LEAST_SCALE = 1.2
BLOCK = 256
ROOTS = 8
SMALL = 32
BATCH_ROWS = 8192
# Entries of a matrix of cosines, and linked pairs, that a task holds at a time
CELLS = 1 << 21
# Chance that two random unit vectors share a cell of E8 at scale 1, projections being about normal: (4 pi)^-4
MEET = (4 * math.pi) ** -4


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = [
        np.eye(8)[i] * a + np.eye(8)[j] * b for i, j in itertools.combinations(range(8), 2) for a, b in itertools.product((1, -1), repeat=2)
    ]
    halves = [np.array(signs) for signs in itertools.product((0.5, -0.5), repeat=8) if np.prod(signs) > 0]
    return np.array(pairs + halves)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole point of even sum (D8), by moving the worst rounded coordinate where the sum is odd."""
    point = np.rint(x)
    rest = x - point
    worst = np.abs(rest).argmax(axis=-1)[..., None]
    odd = point.sum(axis=-1, keepdims=True) % 2 != 0
    step = np.where(np.take_along_axis(rest, worst, -1) >= 0, 1.0, -1.0)
    moved = np.take_along_axis(point, worst, -1) + np.where(odd, step, 0.0)
    np.put_along_axis(point, worst, moved, -1)
    return point


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8: of D8, or of D8 moved by one half."""
    whole, half = nearest_even(x), nearest_even(x - 0.5) + 0.5
    near = ((x - whole) ** 2).sum(axis=-1, keepdims=True) <= ((x - half) ** 2).sum(axis=-1, keepdims=True)
    return np.where(near, whole, half)


class Lattices:
    """Tables of lattice cells for ``rows`` unit vectors of ``width`` components."""

    def __init__(self, rows: int, width: int, tables: int | None = None, probes: int = PROBES, seed: int = 7):
        self.tables = tables or TABLES + math.ceil(TABLES_A_DECADE * max(0.0, math.log10(max(rows, 1) / BASE_ROWS)))
        self.probes = probes
        chance = min(MEETINGS / (max(rows, 1) * self.tables * (1 + 2 * probes)), 0.5)
        self.groups = 1
        while (chance ** (1 / self.groups) / MEET) ** 0.125 < LEAST_SCALE:
            self.groups += 1
        self.scale = (chance ** (1 / self.groups) / MEET) ** 0.125
        random = np.random.default_rng(seed)
        size = 8 * self.groups
        self.projections = []
        for _ in range(self.tables):
            drawn = random.normal(size=(width, size))
            if width >= size:
                drawn = np.linalg.qr(drawn)[0] * math.sqrt(width)
            self.projections.append(drawn / self.scale)
        self.offsets = random.random((self.tables, size))
        self.factors = random.integers(0, 1 << 63, (self.tables, self.groups, 8), dtype=np.uint64) | np.uint64(1)
        self.moves = neighbours()

    def cells(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Of each vector its own cell's name and those of the probed ones."""
        n = len(unit)
        x = (unit @ self.projections[table] + self.offsets[table]).reshape(n, self.groups, 8)
        point = nearest_point(x)
        # a point's coordinates are multiples of one half; names add up, so a neighbour's follows from its move
        whole = lambda p: np.rint(2 * p).astype(np.int64).view(np.uint64)
        own = (whole(point) * self.factors[table]).sum(axis=(1, 2), dtype=np.uint64)
        moved = (whole(self.moves)[None] * self.factors[table][:, None]).sum(axis=2, dtype=np.uint64).ravel()
        gain = ((x - point) @ self.moves.T).reshape(n, -1)
        best = np.argpartition(-gain, self.probes, axis=1)[:, : self.probes]
        names = np.concatenate([own[:, None], own[:, None] + moved[best]], axis=1)
        return mix(names ^ mix(np.array([table + 1], dtype=np.uint64)))


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of length 1, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        out = flat.reshape(len(sizes), width)
    else:
        out = np.zeros((len(sizes), width))
        out[np.arange(width) < sizes[:, None]] = flat
    out = out / np.abs(out).max(axis=1, initial=0, keepdims=True)  # so that squares neither overflow nor vanish
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


# --- comparing the vectors of a group with each other ------------------------------------------------------------


def forest(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each node the smallest one it reaches, given what it reached before and the links a-b."""
    nodes = np.arange(len(root))
    a, b = np.concatenate([a, nodes]), np.concatenate([b, root])
    root = nodes
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked(unit: np.ndarray, tile: np.ndarray, side: np.ndarray, split: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of rows within each tile, some ``CELLS`` at a time.

    Rows come tile by tile. In a split tile the sides meet, not their own rows.
    """
    first = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    sizes = np.diff(np.append(first, len(tile)))
    at, size_of = np.repeat(first, sizes), np.repeat(sizes, sizes)
    small = size_of <= SMALL
    rows = np.arange(len(tile))
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def kept(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = ~split[a] | (side[a] != side[b])
        return a[keep], b[keep]

    for k in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        a = rows[: len(rows) - k][(small & (rows + k < at + size_of))[: len(rows) - k]]
        a = a[np.einsum("ij,ij->i", unit[a], unit[a + k]) >= least]
        held.append(kept(a, a + k))
    for begin, size in zip(first[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        own = unit[begin : begin + size]
        step = max(CELLS // int(size), 1)
        for low in range(0, size, step):
            a, b = np.nonzero(np.triu(own[low : low + step] @ own[low:].T >= least, 1))
            held.append(kept(begin + low + a, begin + low + b))
            if sum(len(x) for x, _ in held) > CELLS:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def tiles(df: DataFrame, least: float, width: int, counting: bool) -> DataFrame:
    """Compare rows (group, low, high, side, node, weight, vector) that agree in group, low and high.

    Gives (node, root) edges of the tiles' forests, or (node, links): the weight of the rows linked with each.
    """
    schema = "node bigint, links bigint" if counting else "node bigint, root bigint"

    def compare(t: pa.Table) -> pa.RecordBatch:
        keys = [t.column(c).to_numpy() for c in ("group", "low", "high")]
        change = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        tile = np.concatenate([[0], np.cumsum(change)])
        node, weight = t.column("node").to_numpy(), t.column("weight").to_numpy()
        links, root = np.zeros(len(node)), np.arange(len(node))
        for a, b in linked(unit_rows(t.column("vector"), width), tile, t.column("side").to_numpy(), keys[1] != keys[2], least):
            if counting:
                links += np.bincount(a, weight[b], len(node)) + np.bincount(b, weight[a], len(node))
            else:
                root = forest(root, a, b)
        if counting:
            out = node, np.rint(links).astype(np.int64)
        else:
            some = root != np.arange(len(node))
            out = node[some], node[root[some]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["node", "links" if counting else "root"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= BATCH_ROWS:
                t = pa.Table.from_batches(held)
                # the last tile may go on in the next batch
                ends = [t.column(c).to_numpy() for c in ("group", "low", "high")]
                whole = int(np.flatnonzero(np.any([k != k[-1] for k in ends], axis=0)).max(initial=-1)) + 1
                if whole:
                    yield compare(t.slice(0, whole))
                held, rows = t.slice(whole).to_batches(), t.num_rows - whole
        if rows:
            yield compare(pa.Table.from_batches(held))

    keys = ["group", "low", "high"]
    placed = df.repartition(*keys).sortWithinPartitions(*keys)
    return placed.select(*keys, "side", "node", "weight", "vector").mapInArrow(run, schema)


def balls(large: DataFrame, width: int) -> DataFrame:
    """Of each block its centre, the largest angle to it, its weight and its smallest node."""
    schema = "group bigint, block int, centre array<double>, radius double, weight bigint, least bigint"
    fields = pa_schema(large.sparkSession, schema)

    def ball(key, t):
        unit = unit_rows(t.column("vector"), width)
        centre = unit.sum(axis=0)
        size = np.linalg.norm(centre)
        centre = centre / size if size > 1e-6 else unit[0]
        radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max()) + 1e-7
        row = [[key[0].as_py()], [key[1].as_py()], [centre.tolist()], [radius], [int(t.column("weight").to_numpy().sum())], [int(t.column("node").to_numpy().min())]]
        return pa.table([pa.array(v, f.type) for v, f in zip(row, fields, strict=True)], schema=fields)

    return large.groupBy("group", "block").applyInArrow(ball, schema)


def judged(pairs: DataFrame, least: float, width: int) -> DataFrame:
    """Pairs of blocks with ``verdict``: 1 if all of their pairs of rows are links, -1 if none, 0 to look."""
    limit = math.acos(min(least, 1.0))

    def work(batch):
        a, b = (unit_rows(batch.column(c), width) for c in ("a_centre", "b_centre"))
        angle = np.arccos(np.clip((a * b).sum(axis=1), -1, 1))
        ra, rb = (batch.column(c).to_numpy() for c in ("a_radius", "b_radius"))
        each = (2 * ra < limit) & (2 * rb < limit)
        verdict = np.where(each & (angle + ra + rb < limit), 1, np.where(angle - ra - rb > limit, -1, 0))
        columns = ("group", "low", "high", "a_weight", "b_weight", "a_least", "b_least")
        yield {c: batch.column(c) for c in columns} | {"verdict": verdict}

    schema = "group bigint, low int, high int, a_weight bigint, b_weight bigint, a_least bigint, b_least bigint, verdict int"
    return in_arrow(pairs, work, schema)


def compared(rows: DataFrame, least: float, width: int, counting: bool, block: int = BLOCK) -> DataFrame:
    """Rows (group, size, node, weight, vector), each group compared within itself; results as of ``tiles``."""
    rows_of_block = F.greatest(F.lit(block), ROOTS * F.sqrt("size"))
    blocks = F.when(F.col("size") <= block, 1).otherwise(F.ceil(F.col("size") / rows_of_block)).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(F.col("node"), F.lit(1)), "blocks").cast("int"))
    zero = F.lit(0)
    small = rows.where("blocks = 1").withColumns({"low": zero, "high": zero, "side": zero})
    large = rows.where("blocks > 1")
    if large.isEmpty():
        return tiles(small, least, width, counting)
    ball = stored(balls(large, width), "balls")
    a = ball.select("group", F.col("block").alias("low"), *[F.col(c).alias(f"a_{c}") for c in ("centre", "radius", "weight", "least")])
    b = ball.select("group", F.col("block").alias("high"), *[F.col(c).alias(f"b_{c}") for c in ("centre", "radius", "weight", "least")])
    pairs = stored(judged(a.join(b, "group").where("low <= high"), least, width), "block_pairs")
    look = pairs.where("verdict = 0").select("group", "low", "high")
    sides = look.select("*", F.col("low").alias("block"), F.lit(0).alias("side")).unionByName(
        look.where("low < high").select("*", F.col("high").alias("block"), F.lit(1).alias("side"))
    )
    looked = large.join(sides, ["group", "block"])
    columns = ["group", "low", "high", "side", "node", "weight", "vector"]
    found = tiles(small.select(columns).unionByName(looked.select(columns)), least, width, counting)
    sure = pairs.where("verdict = 1")
    if counting:
        each = sure.select("group", F.col("low").alias("block"), F.col("b_weight").alias("links")).unionByName(
            sure.where("low < high").select("group", F.col("high").alias("block"), F.col("a_weight").alias("links"))
        )
        each = each.groupBy("group", "block").agg(F.sum("links").alias("links"))
        own = sure.where("low = high").select("group", F.col("low").alias("block"), F.lit(True).alias("itself"))
        each = each.join(own, ["group", "block"], "left")
        of_row = F.col("links") - F.when(F.col("itself"), F.col("weight")).otherwise(0)
        more = large.join(each, ["group", "block"]).select("node", of_row.alias("links"))
    else:
        between = sure.where("low < high").select(F.col("a_least").alias("node"), F.col("b_least").alias("root"))
        within = sure.where("low = high").select("group", F.col("low").alias("block"), F.col("a_least").alias("root"))
        more = between.unionByName(large.join(within, ["group", "block"]).select("node", "root"))
    return found.unionByName(more)


# --- the operator ------------------------------------------------------------------------------------------------


def entries(classes: DataFrame, lattices: Lattices, width: int) -> DataFrame:
    """(cell, node, home): the cells that each class enters."""

    def work(batch):
        unit, node = unit_rows(batch.column("vector"), width), batch.column("node").to_numpy()
        for begin in range(0, len(unit), 512):
            part = unit[begin : begin + 512]
            names = np.stack([lattices.cells(part, t) for t in range(lattices.tables)], axis=1)
            home = np.zeros(names.shape, dtype=bool)
            home[:, :, 0] = True
            each = names.shape[1] * names.shape[2]
            yield {"cell": names.ravel().view(np.int64), "node": np.repeat(node[begin : begin + 512], each), "home": home.ravel()}

    return in_arrow(classes.select("node", "vector"), work, "cell bigint, node bigint, home boolean")


def linked_classes(classes: DataFrame, rows: int, width: int, least: float, tables: int | None, probes: int, block: int = BLOCK) -> DataFrame:
    """(node, root, size): the classes that have links, by component."""
    entered = stored(entries(classes, Lattices(rows, width, tables, probes), width), "cells")
    met = entered.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("home").alias("home")).where("size > 1 AND home")
    together = entered.select("cell", "node").join(met.select("cell", "size"), "cell")
    meeting = together.join(classes.select("node", F.col("copies").alias("weight"), "vector"), "node")
    # a group meets in many cells: larger blocks, so that few of them need their centres
    edges = compared(stored(meeting.withColumnRenamed("cell", "group"), "meetings"), least, width, False, 8 * block)
    edges = stored(edges.distinct(), "edges")
    roots = components(edges, "node", "root")
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    return roots.join(sizes, "root")


def near_duplicates(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    least: float = 0.95,
    tables: int | None = None,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    ``n_links`` counts the rows whose vectors have a cosine of ``least`` or more, ``component_id`` is the smallest
    id reachable by such links, ``kept`` whether that is the row's own.
    """
    taken = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    node = F.when(usable(F.col("vector")), F.xxhash64("vector"))
    own = taken.where(usable(F.col("vector"))).withColumn("node", F.xxhash64("vector"))
    classes = own.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    classes = stored(classes, "classes")
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(1)).alias("width")).first()
    members = stored(linked_classes(classes, size.n, size.width, least, tables, probes, block), "members")
    of_class = classes.select("node", "copies", "least")
    member = members.join(classes.select("node", "copies", "least", "vector"), "node")
    first = member.groupBy("root").agg(F.min("least").alias("component"))
    group = member.select(F.col("root").alias("group"), "size", "node", F.col("copies").alias("weight"), "vector")
    links = compared(group, least, size.width, True, block).groupBy("node").agg(F.sum("links").alias("links"))
    found = members.select("node", "root").join(first, "root").join(links, "node", "left").select("node", "component", "links")
    known = of_class.join(found, "node", "left").where("copies > 1 OR component IS NOT NULL")
    known = known.select(
        "node",
        F.coalesce("component", "least").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    named = taken.select("vec_id", node.alias("node")).join(known, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return named.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
