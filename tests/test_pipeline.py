"""Stored tables, the streaming view and whole runs, with crashes in between."""

import datetime as dt
import json

import pytest

from vidstrata import schemas
from vidstrata.operators.audit import Audit, Counts
from vidstrata.plans import daily_run, gold
from vidstrata.plans.tables import Tables
from vidstrata.sources import files, json_lines, relational
from vidstrata.streaming import intake, silver_view


def ledger(spark, *names):
    return spark.createDataFrame([(n, True) for n in names], schemas.ddl(schemas.CSV_FILES))


def names(tables):
    return sorted(r["file_name"] for r in tables.read("csv_files").collect())


def channel_rows(spark, *ids):
    text = schemas.CHANNELS | {"created_at": "string"}
    rows = [(i, f"u{i}", i, 1, 1577836800, 5, "X", "2025-01-01", 0) for i in ids]
    return schemas.conform(spark.createDataFrame(rows, schemas.ddl(text)), schemas.CHANNELS)


def video_rows(spark, *pairs):
    text = schemas.BRONZE_VIDEOS | {"created_at": "string", "expire_at": "string"}
    rows = [(v, f"u{c}", "1", "t", "a,b", "u", 10, "n", 1, 0, 2, False, "2024-01-01", "1970-01-01", 0)
            for v, c in pairs]
    return schemas.conform(spark.createDataFrame(rows, schemas.ddl(text)), schemas.BRONZE_VIDEOS)


def test_append_is_idempotent(spark, tables):
    assert tables.append("csv_files", ledger(spark, "a", "b"), "one") == 2
    assert tables.append("csv_files", ledger(spark, "a", "b"), "one") == 0
    assert tables.append("csv_files", ledger(spark, "c"), "two") == 1
    assert names(tables) == ["a", "b", "c"]


def test_crash_before_the_commit(spark, tables, monkeypatch):
    def crash(rows, folded=None):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", crash)
        with pytest.raises(RuntimeError):
            tables.append("bronze_channels", channel_rows(spark, 1, 2), "after-0", "id")
    assert tables.watermark("bronze_channels") is None
    assert tables.read("bronze_channels").count() == 0
    tables.append("bronze_channels", channel_rows(spark, 1, 2, 3), "after-0", "id")
    assert tables.read("bronze_channels").count() == 3
    assert tables.watermark("bronze_channels") == "3"


def test_replace_switches_all_tables_together(spark, tables, monkeypatch):
    tables.replace({"csv_files": ledger(spark, "a"), "channels": channel_rows(spark, 1)})

    def crash(rows, folded=None):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", crash)
        with pytest.raises(RuntimeError):
            tables.replace({"csv_files": ledger(spark, "z"), "channels": channel_rows(spark, 9)})
    assert names(tables) == ["a"]
    tables.replace({"csv_files": ledger(spark, "b", "c"), "channels": channel_rows(spark, 1, 2)})
    assert names(tables) == ["b", "c"] and tables.read("channels").count() == 2


def test_empty_increment_leaves_the_watermark(spark, tables):
    tables.replace({"channels": channel_rows(spark, 1, 2)})
    assert daily_run.copy_channels(tables).rows_out == 2
    assert daily_run.copy_channels(tables).rows_out == 0
    tables.replace({"channels": channel_rows(spark, 1, 2, 3)})
    assert daily_run.copy_channels(tables).rows_out == 1
    assert tables.read("bronze_channels").count() == 3
    daily_run.copy_channels(tables, mode="full")
    assert daily_run.copy_channels(tables).rows_out == 0
    assert tables.read("bronze_channels").count() == 3


def test_months_are_pruned(spark, tables):
    from vidstrata.operators.silver import silver_events

    events = silver_events(video_rows(spark, ("v1", 1)), channel_rows(spark, 1))
    gold.refresh_append(tables, events, "one", "2025-07-01")
    df = tables.read_months("gold_top_channels", "202401", "202401")
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "yyyymm" in plan
    assert tables.read_months("gold_top_channels", "202402").count() == 0


def test_time_filters_reach_the_files(spark, tables):
    from vidstrata.operators import increments

    tables.append("bronze_videos", video_rows(spark, ("v1", 1), ("v2", 1)), "one")
    rows = increments.between(tables.read("bronze_videos"), "2024-01-01", "2024-01-02")
    assert rows.count() == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan
    files = tables.path("bronze_videos") + "/batch=one"
    import pyarrow.dataset

    assert "timestamp" in str(pyarrow.dataset.dataset(files).schema.field("created_at").type)
    import pyarrow.parquet

    path = pyarrow.dataset.dataset(files).files[0]
    column = pyarrow.parquet.ParquetFile(path).schema.column(12)
    assert column.name == "created_at" and column.physical_type == "INT64"


def test_registered_tables_show_what_is_committed(spark, tables, monkeypatch):
    def shown():
        return sorted(r["id"] for r in spark.table("bronze.channels").collect())

    tables.register()
    assert shown() == [] and spark.sql("SHOW TABLES IN gold").where("NOT isTemporary").count() == 6
    tables.append("bronze_channels", channel_rows(spark, 1), "one")
    tables.register()
    assert shown() == [1]
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", lost)
        with pytest.raises(RuntimeError):
            tables.append("bronze_channels", channel_rows(spark, 9), "cut off")
    tables.append("bronze_channels", channel_rows(spark, 2), "two")
    assert shown() == [1, 2]
    tables.replace({"bronze_channels": channel_rows(spark, 1, 2, 3)})
    assert shown() == [1, 2, 3]
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")
    for name in ("documents", "channels", "csv_files", "rejects", "run_audit"):
        spark.sql(f"DROP VIEW {name}")


def lost(*args, **kwargs):
    raise RuntimeError("lost")


def test_batch_counts_once_after_replace(spark, tables):
    tables.append("csv_files", ledger(spark, "a"), "one")
    tables.replace({"csv_files": tables.read("csv_files")}, "folded")
    assert tables.append("csv_files", ledger(spark, "a"), "one") == 0
    assert names(tables) == ["a"]


def test_replayed_batch_counts_once_after_compaction(spark, tables):
    from vidstrata.operators.silver import silver_events

    events = silver_events(video_rows(spark, ("v1", 1)), channel_rows(spark, 1))
    gold.refresh_append(tables, events, "one", "2025-07-01")
    gold.compact(tables)
    gold.refresh_append(tables, events, "one", "2025-07-01")
    assert visits(tables) == [("u1", 10)]


def test_last_batch_goes_by_number_not_by_clock(spark, tables, monkeypatch):
    import vidstrata.plans.tables as module

    class Clock(dt.datetime):
        at = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)

        @classmethod
        def now(cls, tz=None):
            cls.at -= dt.timedelta(days=1)
            return cls.at

    monkeypatch.setattr(module.dt, "datetime", Clock)
    for last in (1, 2, 3):
        tables.append("bronze_channels", channel_rows(spark, last), f"b{last}", "id")
    assert tables.watermark("bronze_channels") == "3"


def test_many_loads_plan_no_list_of_names(spark, tables):
    tables.append("csv_files", ledger(spark, "a"), "first")
    row = spark.range(1000).selectExpr(
        "'csv_files' AS `table`", "0 AS version", "concat('b', id) AS batch", "cast(NULL AS string) AS watermark",
        "id + 2 AS number", "false AS folded", "current_timestamp() AS committed_at")
    row.coalesce(1).write.mode("append").parquet(f"{tables.root}/commits")
    plan = tables.read("csv_files")._jdf.queryExecution().executedPlan().toString()
    assert "b999" not in plan
    assert names(tables) == ["a"]


def events_of(tables):
    return sorted((r["video_id"], r["channel_id"]) for r in tables.read("silver_events").collect())


def visits(tables):
    return sorted((r["channel_username"], r["total_video_visits"])
                  for r in gold.report(tables, "top_channels").collect())


def test_view_is_triggered_by_videos_only(spark, tables):
    tables.append("bronze_channels", channel_rows(spark, 1), "c1")
    tables.append("bronze_videos", video_rows(spark, ("v1", 1), ("v2", 2)), "v1")
    silver_view.refresh(tables, "2025-07-01")
    tables.append("bronze_channels", channel_rows(spark, 2), "c2")
    assert silver_view.refresh(tables, "2025-07-01") == 0
    assert events_of(tables) == [("v1", 1)]
    tables.append("bronze_videos", video_rows(spark, ("v3", 2)), "v2")
    assert silver_view.refresh(tables, "2025-07-01") == 1
    assert events_of(tables) == [("v1", 1), ("v3", 2)]
    assert visits(tables) == [("u1", 10), ("u2", 10)]
    assert [r["followers_states"] for r in gold.growth_as_stored(tables).collect()] == [1, 1]
    silver_view.rebuild(tables, "2025-07-01")
    assert silver_view.refresh(tables, "2025-07-01") == 0
    assert events_of(tables) == [("v1", 1), ("v2", 2), ("v3", 2)]
    assert visits(tables) == [("u1", 10), ("u2", 20)]


@pytest.mark.parametrize("with_first", [False, True])
@pytest.mark.parametrize("step", ["silver written", "gold written"])
@pytest.mark.parametrize("job", ["refresh", "rebuild"])
def test_view_after_a_crash(spark, tables, monkeypatch, job, step, with_first):
    tables.append("bronze_channels", channel_rows(spark, 1), "c1")
    if with_first:
        tables.append("bronze_videos", video_rows(spark, ("v0", 1)), "v0")
        silver_view.refresh(tables, "2025-07-01")
    tables.append("bronze_videos", video_rows(spark, ("v1", 1)), "v1")
    before = events_of(tables), visits(tables)
    with monkeypatch.context() as patch:
        if step == "silver written":
            patch.setattr(gold, "states", lost)
        else:
            patch.setattr(Tables, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            getattr(silver_view, job)(tables, "2025-07-01")
    assert (events_of(tables), visits(tables)) == before
    silver_view.refresh(tables, "2025-07-01")
    silver_view.refresh(tables, "2025-07-01")
    want = ["v0", "v1"] if with_first else ["v1"]
    assert events_of(tables) == [(v, 1) for v in want] and visits(tables) == [("u1", 10 * len(want))]


def test_view_never_sees_uncommitted_videos(spark, tables, monkeypatch):
    tables.append("bronze_channels", channel_rows(spark, 1), "c1")
    tables.append("bronze_videos", video_rows(spark, ("v0", 1)), "v0")
    with monkeypatch.context() as patch:
        patch.setattr(Tables, "_commit", lost)
        with pytest.raises(RuntimeError):
            tables.append("bronze_videos", video_rows(spark, ("v1", 1)), "v1")
    silver_view.refresh(tables, "2025-07-01")
    assert events_of(tables) == [("v0", 1)]
    tables.append("bronze_videos", video_rows(spark, ("v1", 1)), "v1")
    silver_view.refresh(tables, "2025-07-01")
    assert events_of(tables) == [("v0", 1), ("v1", 1)] and visits(tables) == [("u1", 20)]


def test_videos_without_channel_are_taken_in_once(spark, tables):
    tables.append("bronze_videos", video_rows(spark, ("v1", 1)), "v1")
    assert silver_view.refresh(tables, "2025-07-01") == 0
    tables.append("bronze_channels", channel_rows(spark, 1), "c1")
    assert silver_view.refresh(tables, "2025-07-01") == 0
    assert events_of(tables) == []


def test_once_only_intake(spark, tmp_path):
    root, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for number in range(3):
        folder = tmp_path / "in" / str(number)
        folder.mkdir(parents=True)
        (folder / "x.json").write_text(f'{{"n": {number}}}\n')
        intake.copy_lines(spark, root, out, check)
    intake.copy_lines(spark, root, out, check)
    got = sorted(r["value"] for r in spark.read.schema("value string").parquet(out).collect())
    assert got == [f'{{"n": {n}}}' for n in range(3)]


def line(ident, **body):
    return json.dumps({"_id": ident, "object": {"id": 1, "owner_username": "u1", **body}})


def test_documents_first_seen_wins(spark, tables, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([line("1", title="first"), line("2"), "{", line("1", title="second")]))
    (tmp_path / "b.json").write_text(line("1", title="third") + "\n" + line("3"))
    lines = json_lines.read_lines(spark, str(tmp_path))
    counts = daily_run.append_documents(tables, lines, "one", "daily")
    assert (counts.rows_in, counts.rows_out, counts.rows_rejected) == (6, 3, 1)
    got = {r["_id"]: r["object"]["title"] for r in tables.read("documents").collect()}
    assert got == {"1": "first", "2": "", "3": ""}
    assert daily_run.append_documents(tables, lines, "two", "daily").rows_out == 0
    assert tables.read("documents").count() == 3
    tables.append("bronze_videos", video_rows(spark, ("old", 1)), "old")
    daily_run.reload_videos(tables)
    assert sorted(r["id"] for r in tables.read("bronze_videos").collect()) == ["1", "2", "3"]


def test_lines_are_read_by_modification_time(spark, tmp_path):
    import os

    for name, when in (("old.json", 1_600_000_000), ("edge.json", 1_700_000_000),
                       ("new.json", 1_700_000_100), ("late.json", 1_800_000_000), ("x.jsn", 1_700_000_050)):
        (tmp_path / name).write_text(name)
        os.utime(tmp_path / name, (when, when))
    since = dt.datetime.fromtimestamp(1_700_000_000, dt.timezone.utc)
    until = dt.datetime.fromtimestamp(1_800_000_000, dt.timezone.utc)
    got = json_lines.read_lines(spark, str(tmp_path), since, until).collect()
    assert sorted(r["value"] for r in got) == ["edge.json", "new.json"]
    early = json_lines.read_lines(spark, str(tmp_path), until=since).collect()
    assert sorted(r["value"] for r in early) == ["old.json"]
    for bounds, n in (((since, until), 2), ((since, None), 3), ((None, until), 3), ((None, None), 4)):
        assert files.modified_since(spark, str(tmp_path), *bounds).count() == n


def test_whole_run_twice(spark, tmp_path):
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "a.json").write_text(line("1", visit_count=7) + "\nbroken\n")
    (tmp_path / "csv" / "2025-01-01").mkdir(parents=True)
    (tmp_path / "csv" / "2025-01-01" / "c.csv").write_text("_id,created_at\nu1,2025-01-01\n")
    run = daily_run.Run(dt.datetime(2025, 1, 2), str(tmp_path / "json"), str(tmp_path / "csv"))
    for again in (False, True):
        rows = daily_run.run(spark, str(tmp_path / "out"), run)
        got = {r["stage"]: (r["status"], r["rows_out"], r["rows_rejected"]) for r in rows.collect()}
        assert got["documents"] == (("skipped", None, None) if again else ("success", 1, 1))
        assert {status for status, *_ in got.values()} <= {"success", "skipped"}
    assert not (tmp_path / "out" / "staging" / "documents" / f"batch={run.batch}").exists()
    tables = Tables(spark, str(tmp_path / "out"))
    daily_run.reload_videos(tables)
    daily_run.run(spark, tables.root, run)
    assert tables.read("bronze_videos").count() == 1
    assert visits(tables) == [("u1", 7)]
    assert tables.read("rejects").count() == 1
    assert tables.read("run_audit").count() == 15


def test_audit_notes_retry_and_failure(spark):
    audit, calls = Audit(spark, "r"), []

    def flaky():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("once")
        return Counts(rows_out=3)

    audit.stage("flaky", flaky)
    with pytest.raises(ValueError):
        audit.stage("bad", lambda: int("x"), attempts=1)
    got = [(r["stage"], r["status"], r["rows_out"]) for r in audit.rows().collect()]
    assert got == [("flaky", "retry", None), ("flaky", "success", 3), ("bad", "failure", None)]


def test_audit_keeps_the_whole_error(spark):
    def fail(text):
        raise ValueError(text)

    audit = Audit(spark, "r")
    with pytest.raises(ValueError):
        audit.stage("bad", lambda: fail("x" * 900), attempts=1)
    assert "x" * 900 in audit.rows().first()["message"]


def test_keyset_options_cover_the_range():
    options = relational.keyset_options("jdbc:x", "channels", 10, 3_000_010)
    assert (options["lowerBound"], options["upperBound"]) == ("11", "3000011")
    assert options["numPartitions"] == "3"
    assert relational.keyset_options("jdbc:x", "channels", 5, 5)["numPartitions"] == "1"
