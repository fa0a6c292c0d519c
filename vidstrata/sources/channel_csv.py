"""Channel CSV files: the daily drops and the one-off bulk load.

Files may differ in their columns, so each is read with its own header. The daily drops are read once, as lines:
the first line of a file is its header, and joined to the file's other lines it tells which of their fields are
which. Only files with a quoted field that spans lines are read a second time, whole per file.

The bulk load finds the header lines by a first pass over the text and reads files of one header together.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.sources import files

DAILY_REQUIRED = ("_id", "created_at")
BULK_COLUMNS = (
    "username",
    "total_video_visit",
    "video_count",
    "start_date_timestamp",
    "followers_count",
    "country",
    "update_count",
)
ROW_ORDER = ("source_path", "block_start", "row_seq")

# What the store puts into columns that a daily drop does not carry.
NEW_CHANNEL = {
    "total_video_visit": 0,
    "video_count": 0,
    "start_date_timestamp": 1672531200,
    "followers_count": 0,
    "country": "-",
    "update_count": 0,
}
BULK_CREATED_AT = "2025-01-01 00:00:00"

# Unquoted empty fields match no sentinel and stay apart from "" this way.
NO_VALUE = "\u0001"


class MissingColumns(ValueError):
    """A CSV file lacks a required column."""


def layouts(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], bool, list[str]]]:
    """Groups of files that can be read together: (header, spans lines, paths).

    Only file names and header lines reach the driver, the same kind and amount of metadata Spark
    keeps there to plan any file scan.
    """
    lines = spark.read.text(paths).select(
        files.origin_path().alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    odd_quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    per_split = lines.groupBy("path", "block").agg(
        F.min_by("value", "seq").alias("first"), F.max(odd_quotes % 2 == 1).alias("spans")
    )
    per_file = per_split.groupBy("path").agg(
        F.min_by("first", "block").alias("header"), F.max("spans").alias("spans")
    )
    groups: dict[tuple[str, bool], list[str]] = {}
    for row in per_file.toLocalIterator():
        groups.setdefault((row["header"].lstrip("\ufeff"), row["spans"]), []).append(row["path"])
    return [
        (next(csv.reader([header]), []), spans, sorted(members))
        for (header, spans), members in sorted(groups.items())
    ]


def read_text_columns(
    spark: SparkSession, header: list[str], spans: bool, paths: list[str]
) -> DataFrame:
    """All columns as text plus the row's origin. Empty unquoted is NULL, ``""`` is empty text."""
    schema = ", ".join(f"c{i} string" for i in range(len(header)))
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", NO_VALUE)
        .option("multiLine", spans)
        .csv(paths)
    )
    return rows.select(
        *[F.col(f"c{i}") for i in range(len(header))],
        files.origin_path().alias("source_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_seq"),
    )


def read_lines(spark: SparkSession, paths: list[str], names: DataFrame | None = None) -> DataFrame:
    """The lines that are not blank, with their origin; of folders, only the files whose path is in ``names``."""
    lines = spark.read.text(paths).select(
        "value",
        files.origin_path().alias("source_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_seq"),
    )
    if names is not None:
        lines = lines.join(names.select(F.col("path").alias("source_path")), "source_path", "left_semi")
    return lines.where(F.trim("value") != "")


def fields(line: Column, width: int) -> Column:
    """The first ``width`` fields of a line as text. Empty unquoted is NULL, ``""`` is empty text."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv(line, schema, {"quote": '"', "escape": '"', "nullValue": NO_VALUE})
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def headers(lines: DataFrame) -> DataFrame:
    """(source_path, header, block_start, row_seq, columns, spans) of each file; ``lines`` are read once here.

    ``columns`` is the number of fields of the header line, ``spans`` whether some field goes on in the next line.
    """
    odd_quotes = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1
    first = F.min_by(F.struct("value", "block_start", "row_seq"), F.struct("block_start", "row_seq"))
    per_file = lines.groupBy("source_path").agg(first.alias("first"), F.max(odd_quotes).alias("spans"))
    header = F.ltrim(F.col("first.value"), F.lit("\ufeff"))
    unquoted = F.regexp_replace(header, '"[^"]*"', "")
    return per_file.select(
        "source_path",
        header.alias("header"),
        "first.block_start",
        "first.row_seq",
        (F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) + 1).alias("columns"),
        "spans",
    )


def placed(headers: DataFrame) -> DataFrame:
    """Headers with the position of each required column (from 1) and ``missing``, the names that are not there."""
    width = headers.agg(F.coalesce(F.max("columns"), F.lit(1))).first()[0]
    names = fields(F.col("header"), width)
    places = {name: F.array_position(names, name) for name in DAILY_REQUIRED}
    missing = F.concat_ws(", ", *[F.when(F.coalesce(at, F.lit(0)) == 0, name) for name, at in places.items()])
    return headers.withColumns({f"at_{name}": at for name, at in places.items()}).withColumn("missing", missing)


def daily_fields(lines: DataFrame, placed: DataFrame) -> DataFrame:
    """``username``, ``created_at`` (both text) and origin of each row of the files in ``placed``, read by lines."""
    width = placed.agg(F.coalesce(F.max("columns"), F.lit(1))).first()[0]
    first = placed.select(
        "source_path",
        *[f"at_{name}" for name in DAILY_REQUIRED],
        F.col("block_start").alias("_block"),
        F.col("row_seq").alias("_seq"),
    )
    rows = lines.join(first, "source_path").where("NOT (block_start = _block AND row_seq = _seq)")
    rows = rows.withColumn("_fields", fields(F.col("value"), width))
    cell = {name: F.get("_fields", (F.col(f"at_{name}") - 1).cast("int")) for name in DAILY_REQUIRED}
    return rows.select(cell["_id"].alias("username"), cell["created_at"].alias("created_at"), *ROW_ORDER)


def spanning_fields(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same of files with fields that span lines, each read as a whole."""
    parts = []
    for header, _, members in layouts(spark, paths):
        rows = read_text_columns(spark, header, True, members)
        cells = [F.col(f"c{header.index(name)}") for name in DAILY_REQUIRED]
        parts.append(rows.select(cells[0].alias("username"), cells[1].alias("created_at"), *ROW_ORDER))
    return reduce(DataFrame.unionByName, parts)


def rows_of(lines: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows of all files in ``placed``, none of which misses a column."""
    rows = daily_fields(lines, placed.where("NOT spans"))
    spanning = [row["source_path"] for row in placed.where("spans").select("source_path").toLocalIterator()]
    return rows.unionByName(spanning_fields(lines.sparkSession, spanning)) if spanning else rows


def read_daily(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``username``, ``created_at`` (both text) and origin of each row; other columns ignored."""
    lines = read_lines(spark, paths)
    found = placed(headers(lines))
    bad = [row["source_path"] for row in found.where("missing <> ''").select("source_path").collect()]
    if bad:
        raise MissingColumns(f"missing required columns in {', '.join(sorted(bad))}")
    return rows_of(lines, found)


def daily_rows(
    rows: DataFrame, stage: Callable[[DataFrame], DataFrame] = lambda df: df
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the rows no channel can be made from; ``stage`` writes down what both share."""
    moment = F.coalesce(
        F.col("created_at").try_cast("timestamp"),
        F.try_to_timestamp("created_at", F.lit("y-M-d H:m:s")),
    )
    typed = stage(rows.withColumn("_moment", moment))
    reason = F.when(F.col("username").isNull(), "username").when(
        F.col("_moment").isNull(), "created_at"
    )
    good = typed.where(reason.isNull()).select(
        "username", F.col("_moment").alias("created_at"), *ROW_ORDER
    )
    bad = typed.where(reason.isNotNull()).select(
        F.col("source_path").alias("source"),
        F.to_json(F.struct("username", "created_at")).alias("raw"),
        reason.alias("reason"),
    )
    return good, bad


def read_bulk(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """Bulk channel rows by column position, as text; surplus columns on the right are dropped."""
    listed = files.list_files(spark, path, suffix).select("path")
    paths = [row["path"] for row in listed.toLocalIterator()]
    parts = []
    for header, spans, members in layouts(spark, paths):
        if len(header) < len(BULK_COLUMNS):
            raise MissingColumns(f"missing columns in {', '.join(members)}")
        rows = read_text_columns(spark, header, spans, members)
        named = [F.col(f"c{i}").alias(name) for i, name in enumerate(BULK_COLUMNS)]
        parts.append(rows.select(*named, *ROW_ORDER))
    return reduce(DataFrame.unionByName, parts)


def bulk_channels(rows: DataFrame) -> DataFrame:
    """Bulk rows with the store's types and its default creation time.

    A number that cannot be read fails the load, as a bulk copy into the store does.
    """
    kinds = {name: schemas.CHANNELS[name] for name in BULK_COLUMNS}
    typed = rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])
    return typed.withColumn("created_at", F.lit(BULK_CREATED_AT).cast("timestamp"))


def cut_columns(df: DataFrame, *ordinals: int) -> DataFrame:
    """Columns by position, counted from 1."""
    return df.select(*[F.col(f"`{df.columns[i - 1]}`") for i in ordinals])
