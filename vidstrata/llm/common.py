"""What the operators share: written tables, batches of texts, hashed words.

Empty and very long texts, null texts and repeated rows are ordinary input everywhere. A group of
documents is worked on together up to ``CHUNK`` bytes; a longer document is a group of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata.session import work_dir

CHUNK = 1 << 18
LONG = 1 << 22
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Fixed values of a 64-bit mixer with good avalanche.
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts can be long: keep few of them in one Arrow batch."""
    spark.conf.set(BATCH_ROWS, str(rows))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a written table in the shared folder: computed once, and safe when executors go.

    Its shuffle files go when it is written, so disks hold those of one step and not of a whole job.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    schema = df.schema
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def apart(work: Callable) -> Callable:
    """Columns of the first table that begin with ``__``, as those of the operators do, have other names meanwhile."""

    @functools.wraps(work)
    def run(df: DataFrame, *args, **how) -> DataFrame:
        own = [c for c in df.columns if c.startswith("__")]
        names = {c: free_name(df, f"apart_{i}") for i, c in enumerate(own)}
        args = [names.get(a, a) if isinstance(a, str) else a for a in args]
        how = {k: names.get(v, v) if isinstance(v, str) else v for k, v in how.items()}
        done = work(df.withColumnsRenamed(names), *args, **how)
        return done.withColumnsRenamed({v: k for k, v in names.items()})

    return run


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see; a null id has an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def groups(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows that together hold about ``limit`` bytes."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number modulo 2^64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 4096), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers[:n]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_inverse = np.ones(1, dtype=np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        steps = np.full(max(n, 4096), _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _inverse = np.cumprod(steps)
    return _inverse[:n]


def _table(separators: list[int], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    inside = np.ones(256, dtype=bool)
    inside[separators] = False
    values = _VALUES.copy()
    if lower:
        values[65:91] = values[97:123]
    return inside, values


# [^\x20\x09-\x0D]+ with A-Z as a-z
PLAIN_WORDS = _table([0x20, *range(0x09, 0x0E)], lower=True)
# The same words with their capitals
CASED_WORDS = _table([0x20, *range(0x09, 0x0E)], lower=False)
# Runs of letters, digits and bytes of other characters than ASCII, as they are.
ALNUM_WORDS = _table([i for i in range(128) if not chr(i).isalnum()], lower=False)
# The same runs with A-Z as a-z
LOWER_ALNUM_WORDS = _table([i for i in range(128) if not chr(i).isalnum()], lower=True)


class Words:
    """The words of a group of texts: ``doc`` (row), ``start``, ``end`` (bytes) and ``hash`` each.

    ``cut`` marks the bytes behind which and before which a word is cut in two.
    """

    def __init__(
        self, texts: list[bytes], kind: tuple[np.ndarray, np.ndarray] = PLAIN_WORDS, cut: tuple[np.ndarray, np.ndarray] | None = None
    ):
        self.rows = len(texts)
        self.text = b"\n".join(texts)
        self.data = data = np.frombuffer(self.text, dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.doc_start = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1].astype(np.int64)
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = kind[0][data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        if cut is not None:
            at = np.flatnonzero(cut[0][data[:-1]] & cut[1][data[1:]]) + 1
            self.start = np.sort(np.concatenate([self.start, at]), kind="stable")
            self.end = np.sort(np.concatenate([self.end, at]), kind="stable")
        self.hash = mix(self._sums(kind[1], inside[1:-1])) if len(self.start) else np.empty(0, dtype=np.uint64)
        # the words of row i are first_word[i] to first_word[i + 1]
        self.first_word = np.append(np.searchsorted(self.start, self.doc_start), len(self.start))
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first_word))

    def _sums(self, values: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Of each word the sum of its bytes' values times rising powers."""
        n = len(self.data)
        if n <= LONG:
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(values[self.data] * powers(n), out=total[1:])
            return (total[self.end] - total[self.start]) * inverse_powers(n)[self.start]
        sizes = self.end - self.start
        at = np.flatnonzero(inside)
        offset = at - np.repeat(self.start, sizes)
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        return np.add.reduceat(values[self.data[at]] * powers(int(sizes.max()))[offset], first)


def shingles(words: Words, size: int = 5) -> list[np.ndarray]:
    """Of each row the sorted distinct hashes of its shingles of ``size`` words.

    Fewer words make one shingle, no words none.
    """
    h = words.hash
    joined = np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64)
    for j in range(size if len(joined) else 0):
        joined += h[j : j + len(joined)] * powers(size + 1)[j + 1]
    joined = mix(joined)
    out = []
    first = words.first_word
    for i in range(words.rows):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= size:
            out.append(np.unique(joined[a : b - size + 1]))
        elif b > a:
            own = (h[a:b] * powers(size + 1)[1 : b - a + 1]).sum() + np.uint64(b - a)
            out.append(mix(np.array([own], dtype=np.uint64)))
        else:
            out.append(h[:0])
    return out


def in_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work`` turns a list of columns' record batch into dicts of columns, batch by batch."""
    fields = pa_schema(df.sparkSession, schema)

    def run(batches):
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in fields], schema=fields
                )

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
