"""Once-only file intake: every file is processed in exactly one batch, kept by the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vidstrata.sources import json_lines


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str):
    """Process everything that is there now and stop.

    A batch that was cut off is handed to ``each`` again with the same number, so ``each`` must
    write to a place named by that number.
    """
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.recentProgress


def new_lines(
    spark: SparkSession, root: str, suffix: str = ".json", files_per_batch: int = 10_000
) -> DataFrame:
    """Lines of files not processed before, with their origin; number them per batch."""
    lines = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
    )
    return json_lines.with_origin(lines)


def copy_lines(spark: SparkSession, root: str, target: str, checkpoint: str, suffix=".json"):
    """Write each new file's lines once, one folder per batch."""

    def store(batch: DataFrame, number: int) -> None:
        json_lines.numbered(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return run_available(new_lines(spark, root, suffix), store, checkpoint)
