"""File discovery: modified-since listing, path dates, and the processed-file ledger.

Any Hadoop path works (``s3a://``, ``hdfs://``, ``file:``); credentials come from the Spark
configuration only.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata.functions import datetimes as d

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def key_under(root: str, path: Column) -> Column:
    """Path relative to ``root``, with scheme and authority ignored on both sides."""
    plain_root = re.sub(SCHEME, "", root).strip("/")
    plain = F.ltrim(F.regexp_replace(path, SCHEME, ""), F.lit("/"))
    return F.when(
        plain.startswith(plain_root + "/"), F.substring(plain, len(plain_root) + 2, 1 << 30)
    ).otherwise(plain)


def origin_path() -> Column:
    """Decoded path of the file a row was read from."""
    return decoded(F.col("_metadata.file_path"))


def decoded(path: Column) -> Column:
    """A path as files have it, from one with percent signs; a plus sign is not encoded in those.

    It is asked for once a line, so a path without percent signs is taken as it is.
    """
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """One row per file: path, key, modified, length. File contents are never read.

    Spark lists the folders in parallel. Its readers pass over files of 0 bytes, though its listing has them: where
    the numbers differ, these are the names that the reader does not give. Only they are asked for their times one by one.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    found = reader.load(root)
    rows = found.select("path", F.col("modificationTime").alias("modified"), "length")
    names = found._jdf.inputFiles()  # stays in the JVM, where the listing is, unless some files are empty
    if len(names) > rows.count():
        listed = spark.createDataFrame([(name,) for name in names], "name string").select(decoded(F.col("name")).alias("path"))
        # by key, since the two write the scheme of a path differently
        listed = listed.withColumn("key", key_under(root, F.col("path")))
        empty = listed.join(rows.select(key_under(root, F.col("path")).alias("key")), "key", "left_anti")
        times = [(row["path"], _modified(spark, row["path"])) for row in empty.toLocalIterator()]
        more = spark.createDataFrame(times, "path string, millis bigint")
        rows = rows.unionByName(more.select("path", F.timestamp_millis("millis").alias("modified"), F.lit(0).cast("bigint").alias("length")))
    return rows.select("path", key_under(root, F.col("path")).alias("key"), "modified", "length")


def _modified(spark: SparkSession, path: str) -> int:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getFileStatus(where).getModificationTime()


def utc(moment: dt.datetime | str) -> dt.datetime:
    """A datetime without zone is taken as UTC."""
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return moment.astimezone(dt.timezone.utc)


def instant(moment: dt.datetime | str) -> Column:
    return F.lit(utc(moment).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def modified_between(modified: Column, since=None, until=None) -> Column:
    """``since`` belongs to the interval, ``until`` does not; a bound that is None does not bind."""
    inside = F.lit(True)
    if since is not None:
        inside = inside & (modified >= instant(since))
    if until is not None:
        inside = inside & (modified < instant(until))
    return inside


def modified_since(spark: SparkSession, root: str, since=None, until=None, suffix=".json") -> DataFrame:
    files = list_files(spark, root, suffix)
    return files.where(modified_between(F.col("modified"), since, until))


def with_drop_date(files: DataFrame, key: str = "key") -> DataFrame:
    return files.withColumn("drop_date", d.leading_date(F.col(key)))


def drop_state(as_of, drop_date: str = "drop_date") -> Column:
    """What to do with a file by the date in its key: ``invalid``, ``future`` or ``due``."""
    date = F.col(drop_date)
    return (
        F.when(date.isNull(), "invalid")
        .when(date.cast("timestamp") > instant(as_of), "future")
        .otherwise("due")
    )


def not_in_ledger(files: DataFrame, ledger: DataFrame, key: str = "key") -> DataFrame:
    done = ledger.where("inserted").select(F.col("file_name").alias(key))
    return files.join(done, key, "left_anti")


def pending_drops(
    spark: SparkSession, root: str, ledger: DataFrame, as_of, suffix: str = ".csv", refused: DataFrame | None = None
) -> DataFrame:
    """Dated files not yet in the ledger, each with its ``state``; load those that are ``due``.

    Files ``refused`` before (file_name, modified) are left out until they are changed.
    """
    files = with_drop_date(not_in_ledger(list_files(spark, root, suffix), ledger))
    if refused is not None:
        seen = refused.select(F.col("file_name").alias("key"), "modified")
        files = files.join(seen, ["key", "modified"], "left_anti")
    return files.withColumn("state", drop_state(as_of))
