import random

import pytest
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.operators import reports as r


def events(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        c = rng.choice([0, 0, 0, rng.randrange(12)])
        rows.append((
            f"v{i % 350}", rng.choice([None, "", "a,b", "a,a,", "b"]), rng.choice([None, 0, 10, 50]),
            rng.choice([None, 3, 9]), f"2024-0{rng.randrange(1, 4)}-10 05:00:00", c, f"c{c}",
            100 * c, c, 1577836800 + c * 86400 if c % 5 else 19000, [None, 0, 40, 7][c % 4],
            ["X", "Y"][c % 2], None if c == 3 else "2025-01-02 00:00:00", None if c == 2 else c))
    names = ["video_id", "video_tags", "video_visit_count", "video_like_count", "video_created_at",
             "channel_id", "channel_username", "channel_total_video_visit", "channel_video_count",
             "channel_start_date_timestamp", "channel_followers_count", "channel_country",
             "channel_created_at", "channel_update_count"]
    kinds = {n: schemas.SILVER_EVENTS[n] for n in names}
    text = {n: "string" if k == "timestamp" else k for n, k in kinds.items()}
    return schemas.conform(spark.createDataFrame(rows, schemas.ddl(text)), kinds)


def rounded(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect()),
        key=str)


@pytest.mark.parametrize("name", list(r.REPORTS))
def test_states_of_any_split_merge_to_the_one_pass_result(spark, name):
    report, rows = r.REPORTS[name], events(spark).withColumn("part", F.expr("hash(video_id) % 3"))
    parts = [report.partial(rows.where(F.col("part") == i), "2025-07-01") for i in (-2, -1, 0, 1, 2)]
    states = parts[0]
    for part in parts[1:]:
        states = states.unionByName(part)
    whole = rounded(report.one_pass(rows, "2025-07-01"))
    assert rounded(report.finish(states)) == whole
    merged = report.merge(states)
    assert merged.count() == merged.select(*report.keys).distinct().count()
    assert rounded(report.finish(merged)) == whole


def test_future_start_counts_as_one_day(spark):
    rows = events(spark).withColumn("channel_start_date_timestamp", F.lit(4102444800).cast("long"))
    got = r.CHANNEL_ACTIVITY.one_pass(rows, "2025-07-01").collect()
    assert {row["max_activity_duration"] for row in got} == {0}


def test_null_date_is_its_own_group(spark):
    got = r.CHANNEL_GROWTH.one_pass(events(spark)).where("date IS NULL").collect()
    assert [row["channel_username"] for row in got] == ["c3"]


def test_limits_and_order(spark):
    report = r.TOP_CHANNELS
    states = report.partial(events(spark))
    ten = report.result(states).collect()
    assert len(ten) == 10
    visits = [row["total_video_visits"] for row in ten]
    assert visits == sorted(visits, reverse=True)
    assert len(report.result(states, limit=3).collect()) == 3


def test_raw_counts_differ_from_merged_values(spark):
    rows = events(spark)
    states = r.CHANNEL_GROWTH.partial(rows).unionByName(r.CHANNEL_GROWTH.partial(rows))
    assert {row["followers_states"] for row in r.growth_raw_counts(states).collect()} == {2}


def test_channel_grain_counts_a_channel_once(spark):
    once = r.GEOGRAPHIC_DISTRIBUTION.one_pass(r.at_channel_grain(events(spark)))
    per_video = r.GEOGRAPHIC_DISTRIBUTION.one_pass(events(spark))
    total = lambda df: df.agg(F.sum("total_video_visits")).first()[0]
    channels = events(spark).select("channel_id", "channel_total_video_visit").distinct()
    assert total(once) == channels.agg(F.sum("channel_total_video_visit")).first()[0]
    assert total(per_video) > total(once)
