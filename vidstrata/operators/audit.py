"""Row counts and status of each stage of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata import schemas


@dataclass
class Counts:
    rows_in: int | None = None
    rows_out: int | None = None
    rows_rejected: int | None = None
    skipped: bool = False  # the stage's batch was there already


class Audit:
    """Collects one row per stage and attempt; ``rows()`` gives them as a DataFrame."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark = spark
        self.run_id = run_id
        self._rows: list[tuple] = []

    def note(self, stage: str, status: str, counts: Counts, started, message: str | None = None):
        now = dt.datetime.now(dt.timezone.utc)
        self._rows.append(
            (
                self.run_id, stage, status, counts.rows_in, counts.rows_out, counts.rows_rejected,
                started, now, message,
            )
        )

    def stage(self, name: str, work: Callable[[], Counts], attempts: int = 2) -> Counts:
        """Run one stage; a failed attempt is noted as ``retry`` and repeated, the last raises."""
        for attempt in range(1, attempts + 1):
            started = dt.datetime.now(dt.timezone.utc)
            try:
                counts = work() or Counts()
            except Exception as error:
                final = attempt == attempts
                status = "failure" if final else "retry"
                self.note(name, status, Counts(), started, str(error))
                if final:
                    raise
            else:
                self.note(name, "skipped" if counts.skipped else "success", counts, started)
                return counts
        raise AssertionError("unreachable")

    def rows(self) -> DataFrame:
        return self.spark.createDataFrame(self._rows, schemas.ddl(schemas.RUN_AUDIT))


def stage_counts(**stages: DataFrame) -> DataFrame:
    """``stage``, ``n``: one row per given DataFrame, counted in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        for name, df in stages.items()
    ]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted
