import datetime as dt
import itertools
import json

from pyspark.sql import functions as F

from vidstrata.functions import coerce as c
from vidstrata.functions import datetimes as d
from vidstrata.session import work_dir
from vidstrata.sources import files


def values(spark, rows, expression, schema="v string"):
    df = spark.createDataFrame([(row,) for row in rows], schema)
    return [row[0] for row in df.select(expression).collect()]


def test_lenient_timestamp(spark):
    epoch = dt.datetime(1970, 1, 1)
    noon = dt.datetime(2023, 10, 1, 12, 34, 56)
    cases = {
        "2023-10-01T12:34:56": noon,
        "2023-10-01T12:34:56Z": noon,
        "2023-10-01T12:34:56.789Z": noon.replace(microsecond=789000),
        "2023-10-01T12:34:56+03:30": dt.datetime(2023, 10, 1, 9, 4, 56),
        "2023-10-01T12:34": noon.replace(second=0),
        "2023-10-01 12:34:56": noon,
        "2023-1-2 3:4:5": dt.datetime(2023, 1, 2, 3, 4, 5),
        "2023-10-01": epoch,
        "2023-10-01 12:34": epoch,
        "2023-10-01 12:34:56.5": epoch,
        "T12:34:56": epoch,
        "2023-13-01 00:00:00": epoch,
        "2023-13-01T00:00:00": epoch,
        "junk": epoch,
        "": epoch,
        None: epoch,
    }
    assert values(spark, list(cases), d.lenient_timestamp(F.col("v"))) == list(cases.values())


def test_date_of_number(spark):
    got = values(spark, [0, 19000, 65535, 65536, 1672531200], d.date_of_number(F.col("v")), "v long")
    assert [str(x) for x in got] == [
        "1970-01-01", "2022-01-08", "2149-06-06", "1970-01-01", "2023-01-01"]


def test_days_between_is_never_negative(spark):
    got = values(spark, ["2025-01-01", "2025-07-03", None],
                 d.days_between(F.to_date("v"), d.as_date("2025-07-01")))
    assert got[:2] == [181, 0]


def test_leading_date(spark):
    cases = {
        "2025-01-03/a.csv": "2025-01-03",
        "2025-1-3/a.csv": "2025-01-03",
        "2025-01-03 evening drop/a.csv": "2025-01-03",
        " 2025-01-03/a.csv": "2025-01-03",
        "2025-01-03": "2025-01-03",
        "2025-02-30/a.csv": None,
        "2025-01-03x/a.csv": None,
        "25-01-03/a.csv": None,
        "misc/2025-01-03.csv": None,
        "/a.csv": None,
        "": None,
    }
    got = values(spark, list(cases), d.leading_date(F.col("v")))
    assert [x and str(x) for x in got] == list(cases.values())


def test_iso_text(spark):
    got = values(spark, ["2020-01-01 00:00:01", "2020-01-01 00:00:01.5"],
                 d.iso_text(F.col("v").cast("timestamp")))
    assert got == ["2020-01-01T00:00:01", "2020-01-01T00:00:01.500000"]


def test_modified_bounds(spark):
    since, until = "2024-01-01T00:00:00", dt.datetime(2024, 1, 2)
    rows = ["2023-12-31 23:59:59.999", "2024-01-01 00:00:00", "2024-01-01 23:59:59.999999",
            "2024-01-02 00:00:00"]
    inside = files.modified_between(F.col("v").cast("timestamp"), since, until)
    assert values(spark, rows, inside) == [False, True, True, False]


def test_since_with_zone():
    zoned = dt.datetime(2024, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert files.utc(zoned) == files.utc("2024-01-01T00:00:00")


def test_drop_state(spark):
    rows = ["2024-01-10", "2024-01-11", None]
    df = spark.createDataFrame([(r,) for r in rows], "d string").select(
        F.to_date("d").alias("drop_date"))
    got = [r[0] for r in df.select(files.drop_state("2024-01-10T00:00:00")).collect()]
    assert got == ["due", "future", "invalid"]


def test_listing_and_ledger(spark, tmp_path):
    for key in ("2024-01-01 x/a+b c.csv", "2024-01-02/b.csv", "2024-01-02/b.json", "2999-01-01/c.csv",
                "none/d.csv"):
        path = tmp_path / key
        path.parent.mkdir(exist_ok=True)
        path.write_text("_id,created_at\n")
    ledger = spark.createDataFrame(
        [("2024-01-02/b.csv", True), ("none/d.csv", False)], "file_name string, inserted boolean")
    pending = files.pending_drops(spark, str(tmp_path), ledger, "2024-06-01")
    got = {(r["key"], r["state"]) for r in pending.collect()}
    assert got == {("2024-01-01 x/a+b c.csv", "due"), ("2999-01-01/c.csv", "future"),
                   ("none/d.csv", "invalid")}


def test_work_dir_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_dir(spark, "x")
    assert shared is None or folder.startswith(shared)
    assert folder != work_dir(spark, "x")


def test_plain_text_undoes_every_escape(spark):
    pieces = ["\\", '"', "n", "\n", "\x01", "u0041", " - ", "é"]
    texts = ["", *map("".join, itertools.product(pieces, repeat=3))]
    written = [json.dumps(text, ensure_ascii=False) for text in texts]
    assert values(spark, written, c.plain_text(F.col("v"))) == texts
    others = ["1.50", "true", "null", '{"a":"\\"b"}', "[]", None]
    assert values(spark, others, c.plain_text(F.col("v"))) == others


def test_parts_of_a_comment_are_counted_without_a_pattern(spark):
    texts = ["one", " - ", "a - b", "a - - b", "a -  - b", "a - b - c - ", '"q" - \\', "\t-\t"]
    written = [json.dumps(text) for text in texts]
    parts = c.Loose(F.col("v")).parts()
    assert values(spark, written, parts) == [len(text.split(" - ")) for text in texts]
    assert values(spark, ['""', "null", None, "5", "[]"], parts) == [0, 0, 0, None, None]
    plan = spark.createDataFrame([("x",)], "v string").select(parts)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan


def test_paths_are_decoded_where_they_hold_percent_signs(spark):
    paths = {"file:/a/b+c/d.json": "file:/a/b+c/d.json", "file:/a%20b+c/%25.json": "file:/a b+c/%.json", None: None}
    assert values(spark, list(paths), files.decoded(F.col("v"))) == list(paths.values())
    plan = spark.createDataFrame([("x",)], "v string").select(files.decoded(F.col("v")))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN Contains" in plan
