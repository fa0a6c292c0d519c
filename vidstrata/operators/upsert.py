"""Set-based upserts: channel rows from the daily drops, and the processed-file ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.sources.channel_csv import NEW_CHANNEL, ROW_ORDER

ID_BUCKETS = 4096


def fold_rows(rows: DataFrame, order: tuple[str, ...] = ROW_ORDER) -> DataFrame:
    """Per username the number of its rows and the creation time of the last one."""
    return rows.groupBy("username").agg(
        F.count(F.lit(1)).alias("_times"),
        F.max_by("created_at", F.struct(*order)).alias("_created_at"),
    )


def number_rows(rows: DataFrame, key: str, start: int | Column, buckets: int = ID_BUCKETS):
    """Add ``id``: start+1, start+2, ... over rows with distinct ``key``.

    Ids depend on the keys alone, so a recomputed task hands out the same ones. Rows are numbered
    inside hash buckets; a bucket starts where the ones before it end. The running total is over
    ``buckets`` rows, whatever the size of the data.
    """
    start = F.lit(start) if isinstance(start, int) else start
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy(key))
    return (
        placed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("id", (start + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_offset")
    )


def upsert_channels(
    channels: DataFrame,
    rows: DataFrame,
    order: tuple[str, ...] = ROW_ORDER,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    last_id: int | None = None,
) -> DataFrame:
    """The channel table after applying ``rows`` one by one in ``order``.

    ``channels`` may be a part of the table that holds all rows of the usernames in ``rows``; ``last_id`` is then
    the highest id of the whole table.

    A new username gets the default columns and one update for each repeat; a known one gets the
    last creation time and one update per row (an unknown update count stays unknown).
    One full outer join, both sides with one row per username, so no username can be hot in the
    shuffle. What follows it reads the join several times: give a ``stage`` that writes it down.
    """
    known = channels.withColumn("_known", F.lit(True))
    merged = stage(known.join(fold_rows(rows, order), "username", "full_outer"))
    seen = F.col("_times").isNotNull()
    updated = merged.where("_known").withColumns(
        {
            "created_at": F.when(seen, F.col("_created_at")).otherwise(F.col("created_at")),
            "update_count": F.col("update_count") + F.coalesce(F.col("_times"), F.lit(0)),
        }
    )
    if last_id is None:
        last_id = merged.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    unknown = merged.where("_known IS NULL").select("username", "_times", "_created_at")
    fresh = number_rows(unknown, "username", last_id)
    defaults = {name: F.lit(value) for name, value in NEW_CHANNEL.items()}
    defaults["update_count"] = F.col("_times") - 1
    fresh = fresh.withColumns(defaults).withColumn("created_at", F.col("_created_at"))
    return schemas.conform(updated, schemas.CHANNELS).unionByName(
        schemas.conform(fresh, schemas.CHANNELS)
    )


def mark_files(ledger: DataFrame, names: DataFrame, column: str = "key") -> DataFrame:
    """The ledger with ``names`` set to inserted; one row per file name."""
    done = names.select(F.col(column).alias("file_name"), F.lit(True).alias("inserted"))
    return ledger.unionByName(done).groupBy("file_name").agg(F.max("inserted").alias("inserted"))
