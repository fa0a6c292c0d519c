"""Session settings every job relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # All timestamps in the tables are UTC wall-clock values.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The reports group by the join key. Without this, AQE leaves a skewed join alone whenever
    # splitting it would cost the following aggregate one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The default form of timestamps in parquet has no statistics, so time filters skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The JVM does not compile larger methods; it would interpret them, some ten times slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Repeated keys in a JSON document: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Can only be set when the session is made. Noting the call site of every Column costs the driver
# more than planning the query.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# Input is compressed columns or text, so this is some 200 MB of rows in a task's memory.
BYTES_PER_SHUFFLE_PARTITION = 64 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, None where the session cannot tell."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        return int(str(plan.stats().sizeInBytes()))
    except AttributeError:
        return None


def size_shuffles(spark: SparkSession, *inputs: DataFrame) -> None:
    """Start the next shuffles with as many partitions as the given inputs need.

    Shuffle partitions then fit an executor's memory at any scale; AQE merges those that turn out
    small. Never fewer than the session's own setting. Give stored tables or file scans: the
    estimate of a join is far too high.
    """
    size = sum(estimated_bytes(df) or 0 for df in inputs)
    wanted = -(-size // BYTES_PER_SHUFFLE_PARTITION)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL_PARTITIONS, str(max(wanted, own)))


def build_session(app: str = "vidstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared one the session names in ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files, wherever it lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; none if there is no such folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))
