"""Whitening of vectors by shifted CholeskyQR.

The rows, centred by their mean, are the matrix A. A distributed pass forms the Gram matrix of A; its
Cholesky factor, with a small shift on the diagonal so that it exists for any A, makes the rows nearly
orthonormal by a triangular solve. Two more passes over the solved rows remove what the shift and rounding
left, and the product of the factors is R of A = QR. The singular values and right vectors of R (a matrix
of the vectors' width) are those of A: the components, and their eigenvalues by the number of rows.

A pass sends one row for each entry of the Gram matrix and task through an aggregation; width squared
doubles reach the driver. Nothing else is collected, and rows are never shuffled.

Vectors are arrays of whole numbers (``on_grid`` brings real ones onto a grid), so that counts, sums and
deviations are exact, whatever the order of the rows. Null vectors take no part; repeated rows count as
rows each; shorter vectors count as ending in zeros, so an empty one is all zeros. Directions without spread
(singular value under 1e-10 of the largest) are no components: rows that are all alike, a single row and an
empty table give no rows at all. Equal eigenvalues keep the order in which the decomposition gives them. A
deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata.llm.common import pa_schema, stored
from vidstrata.llm.vector_search import matrix

FLAT = 1e-10
# Entries stay under this, so that a sum of 10^19 of them fits a decimal of 38 digits.
GRID_LIMIT = 1 << 61
SAFE = float(1 << 62)


def on_grid(vector: Column, scale: float, offset: int = 0) -> Column:
    """floor(scale * x) + offset of each component, kept within +-2^61; null where the vector takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cell = lambda x: F.floor(F.lit(scale) * x.cast("double"))
    bounded = lambda x: F.least(F.greatest(cell(x), F.lit(-GRID_LIMIT)), F.lit(GRID_LIMIT))
    return F.when(usable, F.transform(vector, lambda x: bounded(x) + F.lit(offset).cast("long")))


@dataclass(frozen=True)
class Whitening:
    """``components`` has a column for each component, scaled so that the projections have variance 1."""

    n: int
    sums: list[int]
    components: np.ndarray
    explained: np.ndarray
    identity_error: float

    def mean(self) -> np.ndarray:
        return means(self.sums, self.n)


def means(sums: list[int], n: int) -> np.ndarray:
    return np.array([s / n for s in sums], dtype=np.float64)


def solve_right(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """X of X @ upper = rows, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def count_and_sums(df: DataFrame, vector: str) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, []
        for batch in batches:
            column = batch.column(vector)
            width = max(np.diff(column.offsets.to_numpy()), default=0)
            x = matrix(column, width)
            n += len(x)
            peak = float(np.abs(x).max(initial=0)) * max(len(x), 1)
            own = (x if peak < SAFE else x.astype(object)).sum(axis=0).tolist()
            sums += [0] * (len(own) - len(sums))
            for i, value in enumerate(own):
                sums[i] += int(value)
        at = [-1, *range(len(sums))]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([n, *sums], pa.decimal128(38, 0))], names=["at", "total"])

    parts = df.select(vector).mapInArrow(run, "at int, total decimal(38, 0)")
    found = {r["at"]: int(r["total"]) for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect()}
    return found.get(-1, 0), [found[i] for i in range(len(found) - 1)]


def gram(df: DataFrame, vector: str, mean: np.ndarray, apply: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Q'Q where Q are the centred rows as ``apply`` turns them; ``width`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            q = apply(matrix(batch.column(vector), len(mean)) - mean)
            total += q.T @ q
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "value"])

    parts = df.select(vector).mapInArrow(run, "i int, j int, value double")
    out = np.zeros((width, width))
    for row in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["value"]
    return out


def shifted_cholesky(g: np.ndarray, n: int) -> np.ndarray:
    """Upper R with R'R = g plus a shift; the shift of the published method for n rows."""
    width, unit = len(g), np.finfo(np.float64).eps / 2
    shift = 11 * (n * width + width * (width + 1)) * unit * np.linalg.norm(g, 2)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift *= 10


def root(g: np.ndarray) -> np.ndarray:
    """F with F'F = g: Cholesky's factor, or the spectral one where g has directions without spread."""
    values, vectors = np.linalg.eigh(g)
    if values[0] > 0.5:
        return np.linalg.cholesky(g).T
    return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def fit(df: DataFrame, components: int = 8, vector: str = "vector") -> Whitening | None:
    """The whitening of all rows' vectors; None where no direction has spread."""
    n, sums = count_and_sums(df, vector)
    if not n or not sums:
        return None
    mean, width = means(sums, n), len(sums)
    first = gram(df, vector, mean, lambda a: a, width)
    if not first.any():
        return None
    r1 = shifted_cholesky(first, n)
    second = gram(df, vector, mean, lambda a: solve_right(a, r1), width)
    r2 = shifted_cholesky(second, n) if np.linalg.eigvalsh(second)[0] < 1e-8 else np.linalg.cholesky(second).T
    third = gram(df, vector, mean, lambda a: solve_right(solve_right(a, r1), r2), width)
    _, spread, right = np.linalg.svd(root(third) @ r2 @ r1)
    taken = int(min(components, (spread > FLAT * spread[0]).sum()))
    values = spread**2 / n
    scaled = right[:taken].T / np.sqrt(values[:taken])
    check = gram(df, vector, mean, lambda a: a @ scaled, taken)
    error = float(np.abs(check / n - np.eye(taken)).max())
    return Whitening(n, sums, scaled, values[:taken] / values.sum(), error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Of each row the sum of (n * x - S)^2, exact; None beyond 64 bits."""
    s = np.array([float(v) for v in sums])
    far = np.abs(n * x.astype(np.float64) - s).max(initial=0) + n
    if far * far * max(len(sums), 1) < SAFE and n * np.abs(x).max(initial=0) < SAFE and np.abs(s).max(initial=0) < SAFE:
        own = n * x - np.array(sums, dtype=np.int64)
        return (own * own).sum(axis=1).tolist()
    found = [sum((n * int(v) - t) ** 2 for v, t in zip(row, sums, strict=True)) for row in x]
    return [v if v < 1 << 63 else None for v in found]


OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def transform(df: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """A row (``vec_id``, ...) for each row and component, numbered from 1 by falling eigenvalue."""
    kind = df.schema[vec_id].dataType.simpleString()
    schema = f"`{vec_id}` {kind}, {OUT}"
    fields = pa_schema(df.sparkSession, schema)
    mean, scaled = model.mean(), model.components
    taken = scaled.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(vector), len(mean))
            rows = len(x)
            each = np.repeat(np.arange(rows), taken)
            columns = [
                batch.column(vec_id).take(pa.array(each)),
                np.tile(np.arange(1, taken + 1, dtype=np.int32), rows),
                np.full(rows * taken, model.n),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(each)),
                ((x - mean) @ scaled).ravel(),
                np.tile(model.explained, rows),
                np.full(rows * taken, model.identity_error),
            ]
            columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return df.select(vec_id, vector).mapInArrow(run, schema)


def whiten(df: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """Fit on all vectors and transform all of them; the vectors are written down once for the five passes."""
    rows = stored(df.select(vec_id, vector).where(F.col(vector).isNotNull()), "whitening")
    model = fit(rows, components, vector)
    if model is None:
        kind = df.schema[vec_id].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"`{vec_id}` {kind}, {OUT}")
    return transform(rows, model, vec_id, vector)
