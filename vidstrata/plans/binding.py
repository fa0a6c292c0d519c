"""The library's tables filled from the TPC-H-like test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.operators.silver import silver_events
from vidstrata.session import estimated_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CHANNEL_COLUMNS = {
    "id": "c_custkey + 1",
    "username": "c_name",
    "total_video_visit": "CAST(floor(abs(c_acctbal)) AS BIGINT) * 100",
    "video_count": "c_custkey % 50",
    "start_date_timestamp": "1577836800 + (c_custkey % 1500) * 86400",
    "followers_count": "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 0 "
    "ELSE CAST(floor(abs(c_acctbal)) AS BIGINT) END",
    "country": "n_name",
    "created_at": "CAST(make_date(2025, CAST(1 + c_custkey % 6 AS INT), "
    "CAST(1 + c_custkey % 28 AS INT)) AS TIMESTAMP)",
    "update_count": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 5 END",
}

VIDEO_COLUMNS = {
    "id": "CAST(o_orderkey AS STRING)",
    "owner_username": "CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE c_name END",
    "owner_id": "CAST(o_custkey AS STRING)",
    "title": "concat('title ', o_orderkey)",
    "tags": "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN '' "
    "WHEN o_orderkey % 29 = 0 THEN concat(o_orderpriority, ',', o_orderpriority, ',') "
    "ELSE concat(o_orderpriority, ',', o_orderstatus) END",
    "uid": "concat('u', o_orderkey)",
    "visit_count": "CASE WHEN o_orderkey % 31 = 0 THEN 0 "
    "ELSE CAST(floor(o_totalprice) AS BIGINT) END",
    "owner_name": "c_name",
    "duration": "o_orderkey % 3600",
    "comments": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 12 END",
    "like_count": "CASE WHEN o_orderkey % 9 = 0 THEN NULL "
    "ELSE CAST(floor(o_totalprice / 37) AS BIGINT) END",
    "is_deleted": "o_orderkey % 41 = 0",
    "created_at": "CAST(o_orderdate AS TIMESTAMP)",
    "expire_at": "TIMESTAMP '1970-01-01 00:00:00'",
    "update_count": "o_orderkey % 4",
}


def _built(rows: DataFrame, columns: dict[str, str], types: dict[str, str]) -> DataFrame:
    return rows.selectExpr(
        *[f"CAST({form} AS {types[name]}) AS {name}" for name, form in columns.items()]
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation has 25 rows at every scale
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    rows = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return _built(rows, CHANNEL_COLUMNS, schemas.CHANNELS)


def video_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the name of their customer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(video_source(spark, sf_dir), VIDEO_COLUMNS, schemas.BRONZE_VIDEOS)


def silver(spark: SparkSession, sf_dir: str, **spread) -> DataFrame:
    """Silver over the test tables.

    There is one channel per customer, so the size of the customer scan stands for the channels';
    the optimizer would multiply it by the size of ``nation``.
    """
    if not spread:
        spread = {"right_bytes": estimated_bytes(table(spark, sf_dir, "customer"))}
    return silver_events(videos(spark, sf_dir), channels(spark, sf_dir), **spread)
