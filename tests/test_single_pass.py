"""Rows that come from expensive plans are computed once, however many tables are made from them."""

import json

import pytest
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.operators.silver import silver_events
from vidstrata.plans import catalog, daily_run, gold
from vidstrata.plans.tables import write_sorted
from vidstrata.sources import json_lines


@pytest.fixture
def counted(spark):
    """A column that counts how often it is computed, and the count."""
    seen = spark.sparkContext.accumulator(0)

    def note(value):
        seen.add(1)
        return value

    return F.udf(note, "string").asNondeterministic(), seen


def events_of(spark, n):
    videos = spark.range(n).selectExpr("cast(id AS string) AS id", "'u1' AS owner_username", "'a,b' AS tags", "timestamp '2024-01-05' AS created_at")
    channels = spark.range(1).selectExpr("id", "'u1' AS username", "timestamp '2024-01-01' AS created_at")

    def filled(df, columns):
        return df.selectExpr(*[c if c in df.columns else f"cast(NULL AS {kind}) AS {c}" for c, kind in columns.items()])

    return silver_events(filled(videos, schemas.BRONZE_VIDEOS), filled(channels, schemas.CHANNELS))


def test_months_of_documents_are_computed_once(spark, tmp_path, counted):
    note, seen = counted
    rows = spark.range(40).select(
        note(F.col("id").cast("string")).alias("_id"), F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, id * 5)").alias("created_at")
    )
    write_sorted(rows, str(tmp_path / "months"), "documents", by_month=True)
    assert seen.value == 40
    back = spark.read.parquet(str(tmp_path / "months"))
    assert back.count() == 40 and back.where("day <> date_format(created_at, 'yyyy-MM')").isEmpty()


def test_states_of_six_tables_compute_the_events_once(spark, tables, counted):
    note, seen = counted
    events = events_of(spark, 30)
    gold.refresh_append(tables, events.withColumn("channel_username", note("channel_username")), "one", "2025-07-01")
    assert seen.value == 30
    for name, states in gold.states(events, "2025-07-01").items():
        assert sorted(map(str, tables.read(name).collect())) == sorted(map(str, states.collect()))
    assert not (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(tables.root).where("path LIKE '%/staging/%'").count())
    gold.refresh_append(tables, events.withColumn("channel_username", note("channel_username")), "one", "2025-07-01")
    assert seen.value == 30  # not even for a batch that is there


def test_cut_off_rebuild_joins_once(spark, counted, monkeypatch):
    note, seen = counted
    joined = catalog.joined_events
    total = []

    def join(*sides):
        events = joined(*sides)
        total.append(events.count())
        return events.withColumn("channel_username", note("channel_username"))

    monkeypatch.setattr(catalog, "joined_events", join)
    catalog.QUERIES["rebuild_after_crash"](spark, "/root/testdata/sf0.001").collect()
    assert seen.value == total[0] > 0


def test_text_of_accepted_lines_is_not_staged(spark, tables, tmp_path, monkeypatch):
    good = [json.dumps({"_id": str(i), "object": {"id": i}}) for i in range(5)]
    (tmp_path / "a.json").write_text("\n".join([*good, "{", good[0]]))
    monkeypatch.setattr(daily_run, "remove_folder", lambda *_: None)
    counts = daily_run.append_documents(tables, json_lines.read_lines(spark, str(tmp_path)), "one", "daily")
    assert (counts.rows_in, counts.rows_out, counts.rows_rejected) == (7, 5, 1)
    staged = spark.read.parquet(f"{tables.root}/staging/documents/batch=one")
    assert staged.where("reason IS NULL AND value IS NOT NULL").isEmpty()
    assert [r["raw"] for r in tables.read("rejects").collect()] == ["{"]


def test_first_lines_do_not_carry_where_they_stood(spark, tables, tmp_path, monkeypatch):
    lines = ['{"_id":"a","object":{"id":1,"title":"x \\\\ \\"y\\""}}', '{"_id":"a","object":{"id":2}}', '{"_id":"b","object":{"id":3}}']
    (tmp_path / "one.json").write_text("\n".join(lines) + "\n")
    unseen, given = daily_run.unseen, []
    monkeypatch.setattr(daily_run, "unseen", lambda source, *rest: given.append(source.columns) or unseen(source, *rest))
    daily_run.append_documents(tables, json_lines.read_lines(spark, str(tmp_path)), "one", "daily")
    assert given == [["_id", "object", "created_at", "expire_at", "update_count"]]
    assert sorted(tables.read("documents").select("_id", "object.id", "object.title").collect()) == [("a", "1", 'x \\ "y"'), ("b", "3", "")]
