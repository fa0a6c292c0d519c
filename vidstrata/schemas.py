"""Declared schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Distinct-count sketches merge only when they were built with the same size.
SKETCH_LG_K = 14

DOCUMENT_BODY = (
    "struct<id: string, owner_username: string, owner_id: string, title: string, tags: string, "
    "uid: string, visit_count: bigint, owner_name: string, duration: int, posted_date: string, "
    "posted_timestamp: string, comments: int, like_count: bigint, description: string, "
    "is_deleted: boolean>"
)

DOCUMENTS = {
    "_id": "string",
    "object": DOCUMENT_BODY,
    "created_at": "timestamp",
    "expire_at": "timestamp",
    "update_count": "int",
}

CHANNELS = {
    "id": "bigint",
    "username": "string",
    "total_video_visit": "bigint",
    "video_count": "bigint",
    "start_date_timestamp": "bigint",
    "followers_count": "bigint",
    "country": "string",
    "created_at": "timestamp",
    "update_count": "bigint",
}

CSV_FILES = {"file_name": "string", "inserted": "boolean"}

# Drops that were looked at and not loaded; a drop that is changed later is looked at again.
CSV_REFUSED = {"file_name": "string", "modified": "timestamp", "reason": "string"}

BRONZE_VIDEOS = {
    "id": "string",
    "owner_username": "string",
    "owner_id": "string",
    "title": "string",
    "tags": "string",
    "uid": "string",
    "visit_count": "bigint",
    "owner_name": "string",
    "duration": "int",
    "comments": "int",
    "like_count": "bigint",
    "is_deleted": "boolean",
    "created_at": "timestamp",
    "expire_at": "timestamp",
    "update_count": "int",
}

SILVER_EVENTS = {
    "video_id": "string",
    "video_owner_username": "string",
    "video_owner_id": "string",
    "video_owner_name": "string",
    "video_title": "string",
    "video_tags": "string",
    "video_uid": "string",
    "video_visit_count": "bigint",
    "video_duration": "int",
    "video_comments": "int",
    "video_like_count": "bigint",
    "video_is_deleted": "boolean",
    "video_created_at": "timestamp",
    "video_expire_at": "timestamp",
    "video_update_count": "int",
    "channel_id": "bigint",
    "channel_username": "string",
    "channel_total_video_visit": "bigint",
    "channel_video_count": "bigint",
    "channel_start_date_timestamp": "bigint",
    "channel_followers_count": "bigint",
    "channel_country": "string",
    "channel_created_at": "timestamp",
    "channel_update_count": "bigint",
}

REJECTS = {"source": "string", "raw": "string", "reason": "string"}

RUN_AUDIT = {
    "run_id": "string",
    "stage": "string",
    "status": "string",
    "rows_in": "bigint",
    "rows_out": "bigint",
    "rows_rejected": "bigint",
    "started_at": "timestamp",
    "finished_at": "timestamp",
    "message": "string",
}

MEAN_STATE = "struct<total: double, n: bigint>"

# Gold tables hold partial aggregate state, one row per key and load.
GOLD = {
    "channel_growth": {
        "channel_username": "string",
        "date": "date",
        "followers_count": "bigint",
        "total_video_visits": "bigint",
        "video_count": "bigint",
    },
    "top_channels": {
        "channel_username": "string",
        "date": "date",
        "followers_count": "bigint",
        "total_video_visits": "bigint",
        "video_count": "bigint",
        "avg_engagement_rate": MEAN_STATE,
    },
    "video_engagement": {
        "video_id": "string",
        "date": "date",
        "visit_count": "bigint",
        "like_count": "bigint",
        "engagement_rate": MEAN_STATE,
    },
    "content_popularity": {
        "tag": "string",
        "date": "date",
        "video_count": "bigint",
        "total_visits": "bigint",
        "avg_likes": MEAN_STATE,
    },
    "geographic_distribution": {
        "country": "string",
        "date": "date",
        "channel_count": "binary",
        "total_followers": "bigint",
        "total_video_visits": "bigint",
    },
    "channel_activity_trends": {
        "channel_username": "string",
        "created_date": "date",
        "start_date": "date",
        "update_count": "bigint",
        "activity_duration": "bigint",
        "average_updates_per_day": MEAN_STATE,
    },
}

TABLES = {
    "documents": DOCUMENTS,
    "document_keys": {"_id": "string"},
    "channels": CHANNELS,
    "csv_files": CSV_FILES,
    "csv_refused": CSV_REFUSED,
    "bronze_videos": BRONZE_VIDEOS,
    "bronze_channels": CHANNELS,
    "silver_events": SILVER_EVENTS,
    "silver_waiting": BRONZE_VIDEOS,
    "rejects": REJECTS,
    "run_audit": RUN_AUDIT,
    **{f"gold_{name}": columns for name, columns in GOLD.items()},
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The declared columns in the declared order and type."""
    # as text, because a Column call per cast costs the driver more than the cast itself
    casts = [f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in columns.items()]
    return df.selectExpr(*casts)
