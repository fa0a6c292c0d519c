"""Keyset reads from a relational database through Spark's JDBC source.

The driver jar and the credentials are the caller's; nothing here opens a database by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_READ = 1_000_000
FETCH_SIZE = 10_000


def keyset_options(
    url: str, table: str, after: int, last: int, key: str = "id", partitions: int | None = None
) -> dict[str, str]:
    """Reader options that split ``after < key <= last`` into even key ranges."""
    span = max(last - after, 1)
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(after + 1),
        "upperBound": str(last + 1),
        "numPartitions": str(partitions or max(1, -(-span // ROWS_PER_READ))),
        "fetchsize": str(FETCH_SIZE),
    }


def last_key(spark: SparkSession, url: str, table: str, key: str = "id", **extra: str) -> int:
    """Largest key in the table, 0 when it is empty; the database computes it."""
    query = f"SELECT max({key}) AS last_key FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **extra).load().first()
    return int(row[0] or 0)


def read_after(
    spark: SparkSession, url: str, table: str, after: int, key: str = "id", **extra: str
) -> DataFrame:
    """Rows with a key above ``after``, read in parallel key ranges, filter pushed down."""
    last = last_key(spark, url, table, key, **extra)
    options = {**keyset_options(url, table, after, last, key), **extra}
    rows = spark.read.format("jdbc").options(**options).load()
    return rows.where((F.col(key) > after) & (F.col(key) <= last))
