"""Times the headline queries and prints one JSON line.

Each query is run once to warm up and then timed to the last row of its result.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from vidstrata.plans.catalog import QUERIES
from vidstrata.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "silver_events",
    "silver_events_spread",
    "report_channel_growth",
    "report_top_channels",
    "report_video_engagement",
    "report_content_popularity",
    "report_geographic_distribution",
    "report_channel_activity",
    "state_merge_top_channels",
    "normalize_documents",
    "normalize_extended",
    "channel_upsert",
    "dedup_first_seen",
    "append_documents",
    "csv_daily_load",
    "silver_stream",
    "compact_then_replay",
    "quality_violations",
    "time_increment",
    "lenient_timestamps",
)


def run(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name)
        times[name] = round(run(spark, name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
