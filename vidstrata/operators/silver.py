"""The silver event table: every video with the channel that owns it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vidstrata import schemas
from vidstrata.operators.keys import spread_join

SORT_KEY = ("channel_id", "video_id")


def prefixed(df: DataFrame, prefix: str, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"`{name}` AS `{prefix}_{name}`" for name in columns])


def silver_events(videos: DataFrame, channels: DataFrame, **spread) -> DataFrame:
    """Inner join on the owner's username.

    Unmatched rows drop on both sides, repeated channel rows multiply. Owners are skewed (one
    channel may hold a third of all videos), which ``spread_join`` deals with.
    """
    joined = spread_join(
        prefixed(videos, "video", schemas.BRONZE_VIDEOS),
        prefixed(channels, "channel", schemas.CHANNELS),
        "video_owner_username",
        "channel_username",
        spread_by="video_id",
        **spread,
    )
    return schemas.conform(joined, schemas.SILVER_EVENTS)
