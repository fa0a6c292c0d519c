"""Loads that read and write in proportion to what is new: parts, hash folders, late channels, refused drops."""

import os

import pytest

from tests.test_pipeline import channel_rows, events_of, line, lost, video_rows, visits
from vidstrata.operators import increments
from vidstrata.operators.silver import silver_events
from vidstrata.plans import daily_run, gold
from vidstrata.plans.tables import Tables
from vidstrata.sources import files, json_lines
from vidstrata.streaming import silver_view

AS_OF = "2025-07-01"


def written(tables, name):
    """Data files of a table with their modification times."""
    found = {}
    for folder, _, members in os.walk(f"{tables.root}/{name}"):
        for member in members:
            if member.endswith(".parquet"):
                path = os.path.join(folder, member)
                found[os.path.relpath(path, tables.root)] = os.stat(path).st_mtime_ns
    return found


def scanned(df):
    """Files that the scans of a DataFrame read."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plain(tables):
    joined = silver_events(tables.read("bronze_videos"), tables.read("bronze_channels"))
    return sorted((r["video_id"], r["channel_id"]) for r in joined.collect())


def test_late_channels_reach_back(spark, tables):
    def step():
        return silver_view.refresh(tables, AS_OF, late_channels=True)

    tables.append("bronze_channels", channel_rows(spark, 1), "c1")
    tables.append("bronze_videos", video_rows(spark, ("v1", 1), ("v2", 2), ("v3", 3)), "v1")
    assert step() == 1
    assert tables.read("silver_waiting").count() == 2
    tables.append("bronze_channels", channel_rows(spark, 2), "c2")
    assert step() == 1 and step() == 0
    assert {r["id"] for r in tables.read("silver_waiting").collect()} == {"v3"}
    # both sides at once
    tables.append("bronze_videos", video_rows(spark, ("v4", 2), ("v5", 4)), "v2")
    tables.append("bronze_channels", channel_rows(spark, 3, 4), "c3")
    assert step() == 3
    assert events_of(tables) == plain(tables)
    assert visits(tables) == [("u1", 10), ("u2", 20), ("u3", 10), ("u4", 10)]
    assert tables.read("silver_waiting").count() == 0
    # a channel that comes once more joins with all of its videos once more
    tables.append("bronze_channels", channel_rows(spark, 2), "c4")
    assert step() == 2
    assert events_of(tables) == plain(tables)
    # replaced as a whole: made anew
    tables.replace({"bronze_channels": channel_rows(spark, 1, 2)})
    step()
    assert events_of(tables) == plain(tables)
    assert {r["id"] for r in tables.read("silver_waiting").collect()} == {"v3", "v5"}


def test_late_channels_do_not_scan_matched_videos(spark, tables, monkeypatch):
    tables.append("bronze_channels", channel_rows(spark, 1), "c1")
    tables.append("bronze_videos", video_rows(spark, ("v1", 1), ("v2", 2)), "v1")
    silver_view.refresh(tables, AS_OF, late_channels=True)
    tables.append("bronze_channels", channel_rows(spark, 2), "c2")
    plans = []
    store = tables.change

    def change(appended, *args, **kwargs):
        plans.append(appended["silver_events"]._jdf.queryExecution().optimizedPlan().toString())
        files_of = set(appended["silver_events"].inputFiles())
        assert not any("/bronze_videos/" in f or "/silver_events/" in f for f in files_of)
        assert any("/silver_waiting/" in f for f in files_of)
        return store(appended, *args, **kwargs)

    monkeypatch.setattr(tables, "change", change)
    assert silver_view.refresh(tables, AS_OF, late_channels=True) == 1
    assert plans


def test_late_channels_after_a_crash(spark, tables, monkeypatch):
    tables.append("bronze_videos", video_rows(spark, ("v1", 1)), "v1")
    silver_view.refresh(tables, AS_OF, late_channels=True)
    tables.append("bronze_channels", channel_rows(spark, 1), "c1")
    with monkeypatch.context() as patch:
        patch.setattr(Tables, "_commit", lost)
        with pytest.raises(RuntimeError):
            silver_view.refresh(tables, AS_OF, late_channels=True)
    assert events_of(tables) == [] and tables.read("silver_waiting").count() == 1
    for _ in range(2):
        silver_view.refresh(tables, AS_OF, late_channels=True)
    assert events_of(tables) == [("v1", 1)] and visits(tables) == [("u1", 10)]
    assert tables.read("silver_waiting").count() == 0


def test_upsert_leaves_other_folders_alone(spark, tables, tmp_path):
    tables.replace({"channels": channel_rows(spark, *range(1, 200))}, watermark_of="id")
    before = written(tables, "channels")
    drop = tmp_path / "in" / "2024-01-01" / "a.csv"
    drop.parent.mkdir(parents=True)
    drop.write_text("_id,created_at\nu7,2026-01-02\nnew,2026-01-03\nu7,2026-01-04\n")
    daily_run.load_channel_drops(tables, str(tmp_path / "in"), "2024-02-01", "one")
    after = written(tables, "channels")
    assert before.items() <= after.items()
    new = {f.split("/")[3] for f in set(after) - set(before)}
    assert len(new) <= 2  # the folders of two usernames
    rows = {r["username"]: (r["id"], str(r["created_at"])[:10], r["update_count"]) for r in tables.read("channels").collect()}
    assert len(rows) == 200
    assert rows["u7"] == (7, "2026-01-04", 2) and rows["new"] == (200, "2026-01-03", 0) and rows["u8"] == (8, "2025-01-01", 0)
    # the next new channel goes on from the highest id, wherever that lies
    (drop.parent / "b.csv").write_text("_id,created_at\nnewer,2026-01-05\n")
    daily_run.load_channel_drops(tables, str(tmp_path / "in"), "2024-02-01", "one")
    rows = {r["username"]: r["id"] for r in tables.read("channels").collect()}
    assert rows["newer"] == 201 and len(rows) == 201


def test_upsert_after_a_crash(spark, tables, tmp_path, monkeypatch):
    tables.replace({"channels": channel_rows(spark, 1, 2)}, watermark_of="id")
    drop = tmp_path / "in" / "2024-01-01" / "a.csv"
    drop.parent.mkdir(parents=True)
    drop.write_text("_id,created_at\nu1,2026-01-02\nnew,2026-01-03\n")

    def load():
        daily_run.load_channel_drops(tables, str(tmp_path / "in"), "2024-02-01", "one")

    with monkeypatch.context() as patch:
        patch.setattr(Tables, "_commit", lost)
        with pytest.raises(RuntimeError):
            load()
    assert tables.read("channels").count() == 2 and tables.read("csv_files").count() == 0
    load()
    load()
    rows = {r["username"]: (r["id"], r["update_count"]) for r in tables.read("channels").collect()}
    assert rows == {"u1": (1, 1), "u2": (2, 0), "new": (3, 0)}


def test_compaction_leaves_other_months_alone(spark, tables):
    def states(created, *pairs):
        from pyspark.sql import functions as F

        videos = video_rows(spark, *pairs).withColumn("created_at", F.lit(created).cast("timestamp"))
        return gold.states(silver_events(videos, channel_rows(spark, 1)), AS_OF)["gold_video_engagement"]

    tables.append("gold_video_engagement", states("2024-01-05", ("v1", 1)), "one")
    tables.append("gold_video_engagement", states("2024-02-05", ("v2", 1)), "two")
    tables.append("gold_video_engagement", states("2024-02-05", ("v2", 1), ("v3", 1)), "three")
    before = written(tables, "gold_video_engagement")
    gold.compact(tables, ("video_engagement",))
    new = set(written(tables, "gold_video_engagement")) - set(before)
    assert new and all("yyyymm=202402" in f for f in new)
    assert before.items() <= written(tables, "gold_video_engagement").items()
    assert tables.read("gold_video_engagement").count() == 3
    assert sum(r["visit_count"] for r in tables.read("gold_video_engagement").collect()) == 40
    # nothing has grown since: nothing is written
    gold.compact(tables, ("video_engagement",))
    assert set(written(tables, "gold_video_engagement")) == set(before) | new
    # a later load adds to both months
    tables.append("gold_video_engagement", states("2024-01-05", ("v1", 1)), "four")
    assert tables.read("gold_video_engagement").count() == 4
    assert tables.grown_parts("gold_video_engagement") == ["202401"]
    gold.compact(tables, ("video_engagement",))
    assert tables.read("gold_video_engagement").count() == 3


def test_documents_ask_only_the_folders_of_their_ids(spark, tables, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text("\n".join(line(str(i)) for i in range(300)))
    daily_run.append_documents(tables, json_lines.read_lines(spark, str(tmp_path), suffix="a.json"), "one", "daily")
    assert len(written(tables, "document_keys")) > 50
    (tmp_path / "b.json").write_text(line("7") + "\n" + line("new"))
    asked = []
    read = tables.read_parts

    def read_parts(name, parts):
        found = read(name, parts)
        asked.append((name, parts))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "bucket" in plan
        return found

    monkeypatch.setattr(tables, "read_parts", read_parts)
    counts = daily_run.append_documents(tables, json_lines.read_lines(spark, str(tmp_path), suffix="b.json"), "two", "daily")
    assert counts.rows_out == 1 and asked[0][0] == "document_keys" and len(asked[0][1]) <= 2
    assert tables.read("documents").count() == 301
    assert tables.read("document_keys").count() == 301


def test_ids_of_a_root_without_them(spark, tables, tmp_path):
    (tmp_path / "a.json").write_text(line("1") + "\n" + line("2"))
    lines = json_lines.read_lines(spark, str(tmp_path))
    daily_run.append_documents(tables, lines, "one", "daily")
    old = Tables(spark, str(tmp_path / "old"))
    old.append("documents", tables.read("documents"), "before")
    assert daily_run.append_documents(old, lines, "two", "daily").rows_out == 0


def dated(ident, day):
    import json

    return json.dumps({"_id": ident, "object": {"id": 1, "owner_username": "u1"}, "created_at": f"{day}T10:00:00Z"})


@pytest.mark.parametrize("many", [62, 3])
def test_time_ranges_read_their_days(spark, tables, tmp_path, monkeypatch, many):
    monkeypatch.setattr(daily_run, "MANY_DAYS", many)
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in (1, 5, 9, 20)]
    (tmp_path / "a.json").write_text("\n".join(dated(f"{day} {i}", day) for day in days for i in range(5)))
    daily_run.append_documents(tables, json_lines.read_lines(spark, str(tmp_path)), "one", "daily")
    for since, until, want in (("2024-01-05", "2024-01-09", 1), ("2024-01-05", "2024-02-05", 4), ("2024-02-09", None, 6), ("2024-01-05T11:00:00", "2024-01-09T11:00:00", 1)):
        ranged = tables.read_range("documents", *increments.days_of(since, until))
        rows = increments.between(ranged, since, until)
        assert rows.count() == 5 * want
        plan = ranged._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "day" in plan
        folders = {r["f"].split("day=")[1].split("/")[0] for r in ranged.selectExpr("input_file_name() AS f").distinct().collect()}
        inside = {d for d in days if since[:10] <= d and (until is None or d <= until[:10])}
        assert folders == (inside if many == 62 else {d[:7] for d in inside} | {m for m in folders if m >= since[:7] and (until is None or m <= until)})
        assert len(folders) < len(days) / 2 + 1
    run = daily_run.append_videos(tables, "one", "2024-03-01")
    assert run.rows_out == 20 and run.rows_in == 60


def test_a_refused_drop_holds_no_other_back(spark, tables, tmp_path):
    day = tmp_path / "in" / "2024-01-01"
    day.mkdir(parents=True)
    (day / "good.csv").write_text("_id,created_at\nu1,2024-01-01\n")
    (day / "blank.csv").write_text("\n \n")
    (day / "empty.csv").write_text("")
    (day / "other.csv").write_text("_id,when\nu2,2024-01-01\n")
    (tmp_path / "in" / "undated").mkdir()
    (tmp_path / "in" / "undated" / "x.csv").write_text("_id,created_at\nu3,2024-01-01\n")

    def load(batch):
        return daily_run.load_channel_drops(tables, str(tmp_path / "in"), "2024-02-01", batch)

    counts = load("one")
    assert (counts.rows_in, counts.rows_out, counts.rows_rejected) == (1, 1, 4)
    reasons = {r["file_name"].split("/")[-1]: r["reason"] for r in tables.read("csv_refused").collect()}
    assert reasons == {"blank.csv": "no lines", "empty.csv": "no lines", "other.csv": "missing columns: created_at", "x.csv": "no date in key"}
    assert [r["file_name"] for r in tables.read("csv_files").collect()] == ["2024-01-01/good.csv"]
    counts = load("two")
    assert (counts.rows_in, counts.rows_rejected) == (0, 0)
    # mended, it is looked at again
    (day / "other.csv").write_text("_id,created_at\nu2,2024-01-01\n")
    os.utime(day / "other.csv", (2_000_000_000, 2_000_000_000))
    assert load("three").rows_in == 1
    assert sorted(r["username"] for r in tables.read("channels").collect()) == ["u1", "u2"]
    assert tables.read("rejects").count() == 4


def test_drops_are_scanned_once(spark, tables, tmp_path, monkeypatch):
    from vidstrata.sources import channel_csv

    day = tmp_path / "in" / "2024-01-01"
    day.mkdir(parents=True)
    for i in range(3):
        (day / f"{i}.csv").write_text(f"{'x,' * i}_id,created_at\n{'1,' * i}u{i},2024-01-0{i + 1}\n")
    calls = []
    read = channel_csv.read_lines
    monkeypatch.setattr(channel_csv, "read_lines", lambda *a: calls.append(a) or read(*a))
    monkeypatch.setattr(channel_csv, "read_text_columns", lost)
    daily_run.load_channel_drops(tables, str(tmp_path / "in"), "2024-02-01", "one")
    assert len(calls) == 1
    assert sorted(r["username"] for r in tables.read("channels").collect()) == ["u0", "u1", "u2"]


def test_empty_files_are_listed(spark, tmp_path):
    for name, size in (("a b+c.json", 0), ("d.json", 3), ("sub é/e.json", 0), ("f.csv", 0)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x" * size)
        os.utime(tmp_path / name, (1_700_000_000, 1_700_000_000))
    found = {(r["key"], r["length"], r["modified"].timestamp()) for r in files.list_files(spark, str(tmp_path), ".json").collect()}
    assert {(k, n) for k, n, _ in found} == {("a b+c.json", 0), ("d.json", 3), ("sub é/e.json", 0)}
    assert len({t for *_, t in found}) == 1
    assert files.modified_since(spark, str(tmp_path), "2023-01-01").count() == 3
    assert files.modified_since(spark, str(tmp_path), "2024-01-01").count() == 0


def test_audit_counts_rejects_after_a_crash(spark, tables, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text("broken\n{\n" + line("1"))
    lines = json_lines.read_lines(spark, str(tmp_path))
    append = tables.append_all
    with monkeypatch.context() as patch:
        patch.setattr(tables, "append_all", lambda new, *a, **k: lost() if "documents" in new else append(new, *a, **k))
        with pytest.raises(RuntimeError):
            daily_run.append_documents(tables, lines, "one", "daily")
    counts = daily_run.append_documents(tables, lines, "one", "daily")
    assert (counts.rows_in, counts.rows_out, counts.rows_rejected) == (3, 1, 2)
    assert tables.read("rejects").count() == 2


def test_views_of_parts_and_of_names_like_numbers(spark, tables):
    tables.append("bronze_channels", channel_rows(spark, 1), "001")
    tables.replace({"channels": channel_rows(spark, *range(1, 30))}, "007", watermark_of="id")
    part = tables.read("channels").limit(0)
    from vidstrata.plans.tables import bucket_of

    bucket = channel_rows(spark, 3).select(bucket_of("username")).first()[0]
    made = tables.register("t1_")
    try:
        assert spark.table("t1_bronze.channels").count() == 1
        assert spark.table("t1_lake.channels").count() == 29
        gone = tables.read_parts("channels", [bucket]).count()
        tables.change({}, {"channels": (part, [bucket])}, "emptied")
        assert tables.read("channels").count() == 29 - gone == spark.table("t1_lake.channels").count()
    finally:
        for database in made:
            spark.sql(f"DROP DATABASE {database} CASCADE")


def test_register_leaves_foreign_views_alone(spark, tables):
    spark.sql("CREATE DATABASE t2_bronze")
    spark.sql("CREATE VIEW t2_bronze.channels AS SELECT 1 AS x")
    try:
        with pytest.raises(ValueError, match="channels"):
            tables.register("t2_")
        assert spark.table("t2_bronze.channels").columns == ["x"]
    finally:
        for layer in ("bronze", "silver", "gold", "lake"):
            spark.sql(f"DROP DATABASE IF EXISTS t2_{layer} CASCADE")
