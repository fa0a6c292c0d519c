"""Gold tables: refreshed from silver, read as reports, compacted by month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vidstrata.operators.reports import REPORTS, growth_raw_counts
from vidstrata.plans.tables import Tables
from vidstrata.session import remove_folder, size_shuffles


NAMES = tuple(f"gold_{name}" for name in REPORTS)

# What the six reports read of silver.
EVENT_COLUMNS = (
    "video_id",
    "video_tags",
    "video_visit_count",
    "video_like_count",
    "video_created_at",
    "channel_username",
    "channel_total_video_visit",
    "channel_video_count",
    "channel_start_date_timestamp",
    "channel_followers_count",
    "channel_country",
    "channel_created_at",
    "channel_update_count",
)


def states(events: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """The rows of all six tables for the given silver rows."""
    return {f"gold_{name}": report.partial(events, as_of) for name, report in REPORTS.items()}


def refresh_full(tables: Tables, as_of=None, batch: str = "base") -> None:
    """All six tables anew from all of silver, switched over together."""
    events = tables.read("silver_events")
    size_shuffles(tables.spark, events)
    tables.replace(states(events, as_of), batch)


def refresh_append(tables: Tables, new_events: DataFrame, batch: str, as_of=None) -> None:
    """Add the states of silver rows that gold has not seen yet.

    Feeding the same rows again under another batch name would count them twice; under the same
    name it changes nothing, before or after the tables were compacted. The rows may come from a join, so they are
    written once and read for each of the six tables; what was written goes when the batch is committed.
    """
    if all(tables.holds(name, batch) for name in NAMES):
        return
    staging = f"{tables.root}/staging/gold/batch={batch}"
    new_events.select(*EVENT_COLUMNS).write.mode("overwrite").parquet(staging)
    tables.append_all(states(tables.spark.read.parquet(staging), as_of), batch)
    remove_folder(tables.spark, staging)


def compact(tables: Tables, names: tuple[str, ...] = tuple(REPORTS)) -> None:
    """Fold the states of each key into one row, in the months that more than one load has added to.

    The files of all other months stay as they are. A root whose log does not tell the months is folded as a whole.
    """
    grown = {f"gold_{n}": tables.grown_parts(f"gold_{n}") for n in names}
    whole = {n: REPORTS[n.removeprefix("gold_")].merge(tables.read(n)) for n, months in grown.items() if months is None}
    parts = {n: (REPORTS[n.removeprefix("gold_")].merge(tables.read_parts(n, months)), months) for n, months in grown.items() if months}
    if whole:
        tables.replace(whole, "compacted")
    if parts:
        tables.change({}, parts, "compacted")


def report(
    tables: Tables,
    name: str,
    first_month: str | None = None,
    last_month: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    states = tables.read_months(f"gold_{name}", first_month, last_month)
    return REPORTS[name].result(states, limit)


def growth_as_stored(tables: Tables) -> DataFrame:
    return growth_raw_counts(tables.read("gold_channel_growth"))
