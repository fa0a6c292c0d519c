"""JSON-lines files in and out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata.operators import normalize as n
from vidstrata.session import remove_folder, work_dir
from vidstrata.sources import files

# Columns that put lines in the order they have in their files. Files are ordered by path; within a
# file the block start orders the splits and the running number the lines of one split.
LINE_ORDER = ("source_path", "block_start", "line_seq")


def with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        files.origin_path().alias("source_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with their running number; grows with the line number inside one split."""
    return lines.withColumn("line_seq", F.monotonically_increasing_id())


def read_lines(
    spark: SparkSession, root: str, since=None, until=None, suffix: str = ".json"
) -> DataFrame:
    """Lines of all files under ``root``, each with its origin.

    Files outside ``[since, until)`` are dropped while the files are listed, so a growing archive
    is not read again. Either bound may be left out.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    if since is not None:
        # The reader's own bound is exclusive and in whole seconds: start one second early.
        early = files.utc(since) - dt.timedelta(seconds=1)
        reader = reader.option("modifiedAfter", early.strftime("%Y-%m-%dT%H:%M:%S"))
        reader = reader.option("timeZone", "UTC")
    if until is not None:
        # exclusive and in whole seconds as well: end with the second that until lies in
        late = files.utc(until) + dt.timedelta(seconds=1)
        reader = reader.option("modifiedBefore", late.strftime("%Y-%m-%dT%H:%M:%S"))
        reader = reader.option("timeZone", "UTC")
    lines = reader.text(root)
    if since is not None or until is not None:
        modified = F.col("_metadata.file_modification_time")
        lines = lines.where(files.modified_between(modified, since, until))
    return numbered(with_origin(lines))


def write_lines(documents: DataFrame, path: str) -> None:
    """One JSON object per line, null fields kept, text not escaped to ASCII."""
    documents.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def convert(spark: SparkSession, source: str, target: str, rejects: str | None = None) -> None:
    """Extended-JSON export to normalised JSON lines; refused lines go to ``rejects`` only."""
    staging = work_dir(spark, "convert")
    n.normalize(read_lines(spark, source, suffix=""), "extended").write.parquet(staging)
    normalized = spark.read.parquet(staging)  # parsed once for both
    write_lines(n.export_json(n.accepted(normalized)), target)
    if rejects:
        n.rejected(normalized).write.mode("overwrite").json(rejects)
    remove_folder(spark, staging)
