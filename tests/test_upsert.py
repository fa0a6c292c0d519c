import random

import pytest
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.operators import quality
from vidstrata.operators.upsert import mark_files, number_rows, upsert_channels


def one_by_one(channels, rows):
    """What the store does with the rows: insert, or update on conflict."""
    table = {c["username"]: dict(c) for c in channels}
    for username, created_at in rows:
        if username in table:
            row = table[username]
            row["created_at"] = created_at
            if row["update_count"] is not None:
                row["update_count"] += 1
        else:
            table[username] = {
                "username": username, "total_video_visit": 0, "video_count": 0,
                "start_date_timestamp": 1672531200, "followers_count": 0, "country": "-",
                "created_at": created_at, "update_count": 0,
            }
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_row_by_row(spark, seed):
    rng = random.Random(seed)
    channels = [
        {"id": i + 1, "username": f"u{i}", "total_video_visit": i, "video_count": 1,
         "start_date_timestamp": 5, "followers_count": None, "country": "X", "created_at": None,
         "update_count": None if i % 4 == 0 else i}
        for i in range(20)
    ]
    # u1 and a new name hold a third of the rows each
    rows = [(rng.choice(["u1", "new", f"u{rng.randrange(30)}"]), f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}")
            for i in range(600)]
    source = spark.createDataFrame(
        [(u, c, i) for i, (u, c) in enumerate(rows)], "username string, created_at string, i int"
    ).withColumn("created_at", F.col("created_at").cast("timestamp")).repartition(6)
    known = spark.createDataFrame(
        [tuple(c[name] for name in schemas.CHANNELS) for c in channels], schemas.ddl(schemas.CHANNELS))
    got = {r["username"]: r.asDict() for r in upsert_channels(known, source, ("i",)).collect()}
    want = one_by_one(channels, rows)
    assert set(got) == set(want)
    for name, row in want.items():
        for column, value in row.items():
            if column == "created_at":
                assert (got[name][column] and str(got[name][column])) == value
            elif column != "id":
                assert got[name][column] == value, (name, column)
    ids = sorted(r["id"] for r in got.values())
    assert ids == list(range(1, len(want) + 1))


def test_ids_do_not_depend_on_the_order_of_rows(spark):
    rows = spark.range(500).selectExpr("concat('n', id) AS username")
    one = {r["username"]: r["id"] for r in number_rows(rows, "username", 7, 16).collect()}
    two = {r["username"]: r["id"]
           for r in number_rows(rows.repartition(9), "username", 7, 16).collect()}
    assert one == two and sorted(one.values()) == list(range(8, 508))


def test_mark_files(spark):
    ledger = spark.createDataFrame([("a", False), ("b", True)], schemas.ddl(schemas.CSV_FILES))
    names = spark.createDataFrame([("a",), ("c",), ("c",)], "key string")
    got = sorted(tuple(r) for r in mark_files(ledger, names).collect())
    assert got == [("a", True), ("b", True), ("c", True)]


def quality_rows(spark):
    return spark.createDataFrame(
        [("a", 1, 1, 1, 1), ("a", -1, 1, 1, None), (None, 0, 0, 0, 0), ("b", None, -2, 1, -3)],
        "username string, total_video_visit long, video_count long, start_date_timestamp long, "
        "followers_count long")


def test_violations(spark):
    got = sorted((r["rule"], r["username"] or "", r["n"])
                 for r in quality.violations(quality_rows(spark)).collect())
    assert got == [
        ("followers_count >= 0", "b", 1), ("total_video_visit >= 0", "a", 1),
        ("username not null", "", 1), ("username unique", "a", 2), ("video_count >= 0", "b", 1)]


def test_require_names_what_is_wrong(spark):
    with pytest.raises(quality.QualityError, match="username unique: a"):
        quality.require(quality_rows(spark).where("username = 'a' AND video_count = 1"))
    good = quality_rows(spark).limit(1)
    assert quality.require(good) is good


def test_split_rows(spark):
    good, bad = quality.split_rows(quality_rows(spark))
    assert good.count() == 1
    assert sorted(r["rule"] for r in bad.collect()) == [
        "total_video_visit >= 0", "username not null", "video_count >= 0"]


def test_one_scan_of_the_channels_and_one_join(spark, tmp_path):
    """What is staged reads each side once; the rest reads only what was staged."""
    import datetime as dt

    known = [(1, "u1", 1, 1, 0, 1, "X", dt.datetime(2025, 1, 1), 0)]
    spark.createDataFrame(known, schemas.ddl(schemas.CHANNELS)).write.parquet(str(tmp_path / "channels"))
    drops = [("u1", dt.datetime(2025, 2, 1), 1), ("new", dt.datetime(2025, 2, 2), 2)]
    spark.createDataFrame(drops, "username string, created_at timestamp, i int").write.parquet(str(tmp_path / "drops"))
    plans = []

    def stage(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        df.write.parquet(str(tmp_path / "merged"))
        return spark.read.parquet(str(tmp_path / "merged"))

    channels, rows = (spark.read.parquet(str(tmp_path / name)) for name in ("channels", "drops"))
    after = upsert_channels(channels, rows, ("i",), stage)
    assert plans[0].count("FileScan parquet") == 2 and plans[0].count("Join") == 1
    rest = after._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "channels") not in rest and str(tmp_path / "drops") not in rest
    got = {r["username"]: (r["id"], r["update_count"]) for r in after.collect()}
    assert got == {"u1": (1, 1), "new": (2, 0)}
