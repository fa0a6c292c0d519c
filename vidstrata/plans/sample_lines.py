"""Raw JSON lines made from the test tables, with every kind of loose value in them.

The rules below decide by the order key which form a field takes; the SQL the queries are checked
against states the expected value by the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata.plans import binding

INPUT = {
    "k": "o_orderkey",
    "name": "coalesce(c_name, '')",
    "visits": "cast(floor(o_totalprice) AS bigint)",
    "likes": "cast(floor(o_totalprice / 37) AS bigint)",
    "secs": "unix_seconds(cast(o_orderdate AS timestamp))",
    "day_text": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "time_text": "date_format(o_orderdate, 'HH:mm:ss')",
    "tags": "concat(o_orderpriority, ',', o_orderstatus)",
}

SHARED = {
    "owner_username": """CASE WHEN k % 47 = 0 THEN NULL WHEN k % 61 = 0 THEN 'null'
        WHEN k % 59 = 0 THEN cast(k AS string) WHEN k % 53 = 0 THEN 'true'
        ELSE concat('"', name, '"') END""",
    "title": """concat('"title ', k, ' ', chr(92), '"q', chr(92), '""')""",
    "comments": """CASE WHEN k % 37 = 0 THEN '5' WHEN k % 29 = 0 THEN 'null'
        WHEN k % 8 = 0 THEN NULL WHEN k % 4 = 0 THEN '""' WHEN k % 4 = 1 THEN '"one"'
        WHEN k % 4 = 2 THEN '"one - two"' ELSE '"one - two - three"' END""",
    "is_deleted": """CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'true' WHEN 2 THEN 'false'
        WHEN 3 THEN '"false"' WHEN 4 THEN '0' ELSE '"x"' END""",
}

DAILY_BODY = SHARED | {
    "id": "CASE WHEN k % 67 = 0 THEN NULL ELSE cast(k AS string) END",
    "tags": "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 21 = 0 THEN 'null' "
    "ELSE concat('\"', tags, '\"') END",
    "visit_count": """CASE WHEN k % 17 = 0 THEN NULL WHEN k % 11 = 0 THEN 'null'
        WHEN k % 7 = 0 THEN '""' WHEN k % 43 = 0 THEN '"12.7"' WHEN k % 13 = 0 THEN 'true'
        WHEN k % 5 = 0 THEN concat(visits, '.75') WHEN k % 3 = 0 THEN concat('"', visits, '"')
        ELSE cast(visits AS string) END""",
    "duration": "cast(k % 3600 AS string)",
    "posted_timestamp": """CASE WHEN k % 41 = 0 THEN 'null' WHEN k % 23 = 0 THEN NULL
        WHEN k % 19 = 0 THEN concat('"', secs, '"') ELSE cast(secs AS string) END""",
    "like_count": """CASE WHEN k % 9 = 0 THEN 'null' WHEN k % 10 = 0 THEN NULL
        ELSE cast(likes AS string) END""",
}
DAILY_TOP = {
    "_id": "CASE WHEN k % 83 = 0 THEN NULL WHEN k % 79 = 0 THEN 'null' "
    "ELSE concat('\"', k, '\"') END",
    "created_at": """CASE WHEN k % 31 = 0 THEN '"not a date"' WHEN k % 27 = 0 THEN 'null'
        WHEN k % 25 = 0 THEN NULL WHEN k % 2 = 0 THEN concat('"', day_text, 'T', time_text, 'Z"')
        ELSE concat('"', day_text, ' ', time_text, '"') END""",
    "update_count": "CASE WHEN k % 12 = 0 THEN 'false' ELSE cast(k % 4 AS string) END",
}
DAILY_OBJECT = "CASE WHEN k % 73 = 0 THEN NULL WHEN k % 71 = 0 THEN 'null' ELSE body END"

EXTENDED_BODY = SHARED | {
    "id": """CASE WHEN k % 67 = 0 THEN NULL
        WHEN k % 2 = 0 THEN concat('{"$numberLong":"', k, '"}') ELSE cast(k AS string) END""",
    "tags": "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 0 THEN '\"\"' "
    "ELSE concat('\"', tags, '\"') END",
    "visit_count": """CASE WHEN k % 17 = 0 THEN NULL WHEN k % 11 = 0 THEN 'null'
        WHEN k % 43 = 0 THEN '{"$numberInt":"x"}'
        WHEN k % 7 = 0 THEN concat('{"$numberInt":"', visits, '"}')
        WHEN k % 5 = 0 THEN concat('{"$numberLong":"', visits, '"}')
        ELSE cast(visits AS string) END""",
    "duration": """concat('{"$numberInt":"', k % 3600, '"}')""",
    "posted_timestamp": """CASE WHEN k % 41 = 0 THEN 'null'
        ELSE concat('{"$numberLong":"', secs, '"}') END""",
    "like_count": """CASE WHEN k % 9 = 0 THEN 'null' WHEN k % 10 = 0 THEN NULL
        ELSE concat('{"$numberInt":"', likes, '"}') END""",
}
EXTENDED_TOP = {
    "_id": """CASE WHEN k % 83 = 0 THEN NULL ELSE concat('"', k, '"') END""",
    "created_at": """CASE WHEN k % 31 = 0 THEN '"2020-01-01"' WHEN k % 25 = 0 THEN NULL
        WHEN k % 2 = 0 THEN concat('{"$date":{"$numberLong":"', secs * 1000 + k % 1000, '"}}')
        ELSE cast(secs * 1000 + k % 1000 AS string) END""",
    "update_count": """concat('{"$numberInt":"', k % 4, '"}')""",
}
EXTENDED_OBJECT = """CASE WHEN k % 73 = 0 THEN NULL WHEN k % 71 = 0 THEN '"x"' ELSE body END"""

LINE = "CASE WHEN k % 97 = 0 THEN '{\"_id\": \"cut' WHEN k % 89 = 0 THEN '' ELSE line END"


def _members(fields: dict[str, str]) -> str:
    # concat_ws leaves out NULL parts, which makes the field absent
    parts = ", ".join(f"concat('\"{name}\":', {form})" for name, form in fields.items())
    return f"concat('{{', concat_ws(',', {parts}), '}}')"


def lines(spark: SparkSession, sf_dir: str, dialect: str = "daily") -> DataFrame:
    """``line_no`` and ``value``: one JSON line per order."""
    daily = dialect == "daily"
    rows = binding.video_source(spark, sf_dir).selectExpr(
        *[f"{form} AS {name}" for name, form in INPUT.items()]
    )
    rows = rows.withColumn("body", F.expr(_members(DAILY_BODY if daily else EXTENDED_BODY)))
    whole = (DAILY_TOP if daily else EXTENDED_TOP) | {
        "object": DAILY_OBJECT if daily else EXTENDED_OBJECT
    }
    rows = rows.withColumn("line", F.expr(_members(whole)))
    return rows.select(F.col("k").alias("line_no"), F.expr(LINE).alias("value"))
