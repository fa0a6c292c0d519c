"""Incremental slices of a table: by key, by time, and whole snapshots with repeated keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata.operators.keys import first_by_key
from vidstrata.sources.files import instant, utc


def after_key(df: DataFrame, last: int, key: str = "id") -> DataFrame:
    """Rows above the watermark. The whole slice at once: Spark's splits replace paging."""
    return df.where(F.col(key) > last)


def key_page(df: DataFrame, last: int, size: int, key: str = "id") -> DataFrame:
    """The next ``size`` rows above the watermark, in key order."""
    return after_key(df, last, key).orderBy(key).limit(size)


def between(df: DataFrame, since, until=None, column: str = "created_at") -> DataFrame:
    """Rows with ``since <= column < until``; rows without a time are in no interval."""
    moment: Column = F.col(column)
    rows = df.where(moment >= instant(since))
    return rows if until is None else rows.where(moment < instant(until))


def days_of(since, until=None) -> tuple[str, str | None]:
    """First and last day (``yyyy-MM-dd``) that rows with ``since <= time < until`` can lie in."""
    return utc(since).strftime("%Y-%m-%d"), None if until is None else utc(until).strftime("%Y-%m-%d")


def snapshot(df: DataFrame, order: list[str], key: str = "_id") -> DataFrame:
    """A full reload: one row per key, the first by ``order``."""
    return first_by_key(df, [key], order)
