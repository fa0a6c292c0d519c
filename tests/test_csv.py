import pytest

from vidstrata.operators.quality import QualityError
from vidstrata.plans import daily_run
from vidstrata.sources import channel_csv

HEADER = "username,total_video_visit,video_count,start_date_timestamp,followers_count,country,update_count"


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_daily_files_with_different_columns(spark, tmp_path):
    paths = [
        write(tmp_path, "a b+c/1.csv", "_id,created_at,x\nu1,2024-01-01,9\n"),
        write(tmp_path, "2.csv", 'x,created_at,_id\n"a\nb, ""q""",2024-01-02,u2\n7,2024-01-03,u3\n'),
        write(tmp_path, "3.csv", "created_at,_id\n2024-01-04,\n"),
    ]
    groups = channel_csv.layouts(spark, paths)
    assert sorted((len(header), spans) for header, spans, _ in groups) == [
        (2, False), (3, False), (3, True)]
    rows = {(r["username"], r["created_at"]) for r in channel_csv.read_daily(spark, paths).collect()}
    assert rows == {("u1", "2024-01-01"), ("u2", "2024-01-02"), ("u3", "2024-01-03"),
                    (None, "2024-01-04")}


def test_missing_column_names_the_file(spark, tmp_path):
    path = write(tmp_path, "bad.csv", "_id,other\nu,1\n")
    with pytest.raises(channel_csv.MissingColumns, match="bad.csv"):
        channel_csv.read_daily(spark, [path])


def test_rows_without_name_or_time_are_refused(spark, tmp_path):
    path = write(tmp_path, "a.csv", "_id,created_at\nu,2024-01-01 10:00:00\n,2024-01-01\nv,soon\n")
    good, bad = channel_csv.daily_rows(channel_csv.read_daily(spark, [path]))
    assert [r["username"] for r in good.collect()] == ["u"]
    assert sorted(r["reason"] for r in bad.collect()) == ["created_at", "username"]


def test_bulk_keeps_empty_text_apart_from_null(spark, tables, tmp_path):
    write(tmp_path, "in/c.csv", HEADER + ",extra\n"
          'u1,1,2,3,,"",5,x\nu2,1,2,3,4,,,x\n"q ""1"", z",0,0,0,0,"a,b",0,x\n')
    counts = daily_run.bulk_load_channels(tables, str(tmp_path / "in"))
    got = {r["username"]: (r["followers_count"], r["country"], r["update_count"],
                           str(r["created_at"])) for r in tables.read("channels").collect()}
    start = "2025-01-01 00:00:00"
    assert got == {"u1": (None, "", 5, start), "u2": (4, None, None, start),
                   'q "1", z': (0, "a,b", 0, start)}
    assert counts.rows_out == 3


def test_strict_bulk_load_fails_and_leaves_nothing(spark, tables, tmp_path):
    write(tmp_path, "in/c.csv", HEADER + "\nu1,-1,2,3,4,X,0\nu2,1,2,3,4,X,0\nu2,7,2,3,4,X,0\n")
    with pytest.raises(QualityError):
        daily_run.bulk_load_channels(tables, str(tmp_path / "in"))
    assert tables.read("channels").count() == 0
    counts = daily_run.bulk_load_channels(tables, str(tmp_path / "in"), strict=False)
    got = [(r["username"], r["total_video_visit"]) for r in tables.read("channels").collect()]
    assert got == [("u2", 1)] and counts.rows_rejected == 1


def test_cut_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `c.d` int")
    assert channel_csv.cut_columns(df, 3, 1).columns == ["c.d", "a"]


def test_daily_drops_are_loaded_once(spark, tables, tmp_path):
    root = tmp_path / "drops"
    write(root, "2024-01-01/a.csv", "_id,created_at\nu1,2024-01-01\nu1,2024-01-02\n")
    write(root, "2024-02-01/b.csv", "_id,created_at\nu1,2024-02-01\nu2,2024-02-01\n")
    write(root, "undated/c.csv", "_id,created_at\nu9,2024-02-01\n")

    def state():
        return sorted((r["username"], r["id"], str(r["created_at"])[:10], r["update_count"])
                      for r in tables.read("channels").collect())

    daily_run.load_channel_drops(tables, str(root), "2024-01-15", "run1")
    assert state() == [("u1", 1, "2024-01-02", 1)]
    daily_run.load_channel_drops(tables, str(root), "2024-01-15", "run1")
    assert state() == [("u1", 1, "2024-01-02", 1)]
    daily_run.load_channel_drops(tables, str(root), "2024-03-01", "run2")
    assert state() == [("u1", 1, "2024-02-01", 2), ("u2", 2, "2024-02-01", 0)]
    assert {r["reason"] for r in tables.read("rejects").collect()} == {"no date in key"}
    ledger = {r["file_name"] for r in tables.read("csv_files").collect()}
    assert ledger == {"2024-01-01/a.csv", "2024-02-01/b.csv"}
