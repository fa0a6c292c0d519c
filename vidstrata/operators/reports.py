"""The six gold reports: keys, measures with their state kind, and the finished form of each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidstrata import schemas
from vidstrata.functions import datetimes as d
from vidstrata.operators import states as s


@dataclass(frozen=True)
class Measure:
    state_name: str
    report_name: str
    kind: type[s.Max]
    value: Callable[[object], Column]


@dataclass(frozen=True)
class Report:
    """How to get from silver rows to states, and from states to the finished report."""

    name: str
    keys: dict[str, Callable[[], Column]]
    measures: tuple[Measure, ...]
    date: str = "date"
    report_keys: tuple[str, ...] = ()
    order: tuple[tuple[str, bool], ...] = ()
    limit: int | None = None
    prepare: Callable[[DataFrame], DataFrame] = field(default=lambda events: events)

    @property
    def final_keys(self) -> tuple[str, ...]:
        return self.report_keys or tuple(self.keys)

    def _grouped(self, events: DataFrame, names):
        keys = [self.keys[name]().alias(name) for name in names]
        return self.prepare(events).groupBy(*keys)

    def partial(self, events: DataFrame, as_of=None) -> DataFrame:
        """Aggregate state per key, in the columns of the gold table."""
        columns = [m.kind.partial(m.value(as_of)).alias(m.state_name) for m in self.measures]
        return schemas.conform(
            self._grouped(events, self.keys).agg(*columns), schemas.GOLD[self.name]
        )

    def merge(self, states: DataFrame) -> DataFrame:
        """States of the same key folded into one; the result is a state table again."""
        columns = [m.kind.merge(F.col(m.state_name)).alias(m.state_name) for m in self.measures]
        merged = states.groupBy(*self.keys).agg(*columns)
        return schemas.conform(merged, schemas.GOLD[self.name])

    def finish(self, states: DataFrame) -> DataFrame:
        """Merged and finished values per report key, unordered."""
        columns = [
            m.kind.final(m.kind.merge(F.col(m.state_name))).alias(m.report_name)
            for m in self.measures
        ]
        return states.groupBy(*self.final_keys).agg(*columns)

    def one_pass(self, events: DataFrame, as_of=None) -> DataFrame:
        """Finished values straight from silver, distinct counts exact, unordered."""
        columns = [m.kind.exact(m.value(as_of)).alias(m.report_name) for m in self.measures]
        return self._grouped(events, self.final_keys).agg(*columns)

    def ordered(self, finished: DataFrame, limit: int | None = None) -> DataFrame:
        """The report's own order and row limit (a limit given here replaces it)."""
        if self.order:
            finished = finished.orderBy(
                *[F.col(c).desc() if down else F.col(c).asc() for c, down in self.order]
            )
        limit = self.limit if limit is None else limit
        return finished if limit is None else finished.limit(limit)

    def result(self, states: DataFrame, limit: int | None = None) -> DataFrame:
        return self.ordered(self.finish(states), limit)


def _zero_if_null(name: str, kind: str = "bigint") -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(kind)


def _per_follower(_as_of) -> Column:
    followers = F.col("channel_followers_count")
    rate = F.when(followers > 0, F.col("video_visit_count") / followers)
    return F.coalesce(rate, F.lit(0.0))


def _likes_per_visit(_as_of) -> Column:
    visits = _zero_if_null("video_visit_count", "double")
    likes = _zero_if_null("video_like_count", "double")
    return F.when(visits > 0, likes / visits).otherwise(F.lit(0.0))


def _start_date() -> Column:
    return d.date_of_number(F.col("channel_start_date_timestamp"))


def _active_days(as_of) -> Column:
    return d.days_between(_start_date(), d.as_date(as_of))


def _updates_per_day(as_of) -> Column:
    days = F.greatest(_active_days(as_of), F.lit(1))
    return _zero_if_null("channel_update_count") / days


def _by_tag(events: DataFrame) -> DataFrame:
    """One row per tag occurrence: nothing trimmed, empty and repeated tags kept."""
    return events.where(F.col("video_tags").isNotNull()).select(
        F.explode(F.split("video_tags", ",")).alias("tag"),
        "video_created_at",
        "video_visit_count",
        "video_like_count",
    )


def _column(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _day(name: str) -> Callable[[], Column]:
    return lambda: F.to_date(F.col(name))


def _number(name: str, kind: str = "bigint") -> Callable[[object], Column]:
    return lambda _as_of: _zero_if_null(name, kind)


CHANNEL_GROWTH = Report(
    "channel_growth",
    {"channel_username": _column("channel_username"), "date": _day("channel_created_at")},
    (
        Measure("followers_count", "followers_count", s.Max, _number("channel_followers_count")),
        Measure(
            "total_video_visits", "total_video_visits", s.Max, _number("channel_total_video_visit")
        ),
        Measure("video_count", "video_count", s.Max, _number("channel_video_count")),
    ),
    order=(("date", False), ("channel_username", False)),
)

TOP_CHANNELS = Report(
    "top_channels",
    {"channel_username": _column("channel_username"), "date": _day("video_created_at")},
    (
        Measure("followers_count", "followers_count", s.Max, _number("channel_followers_count")),
        Measure("total_video_visits", "total_video_visits", s.Sum, _number("video_visit_count")),
        Measure("video_count", "video_count", s.Max, _number("channel_video_count")),
        Measure("avg_engagement_rate", "avg_engagement_rate", s.Mean, _per_follower),
    ),
    order=(("total_video_visits", True), ("channel_username", False), ("date", False)),
    limit=10,
)

VIDEO_ENGAGEMENT = Report(
    "video_engagement",
    {"video_id": _column("video_id"), "date": _day("video_created_at")},
    (
        Measure("visit_count", "total_visit_count", s.Sum, _number("video_visit_count")),
        Measure("like_count", "total_like_count", s.Sum, _number("video_like_count")),
        Measure("engagement_rate", "average_engagement_rate", s.Mean, _likes_per_visit),
    ),
    order=(("date", False), ("video_id", False)),
    limit=10,
)

CONTENT_POPULARITY = Report(
    "content_popularity",
    {"tag": _column("tag"), "date": _day("video_created_at")},
    (
        Measure("video_count", "total_video_count", s.Count, lambda _as_of: F.lit(1)),
        Measure("total_visits", "total_visits", s.Sum, _number("video_visit_count")),
        Measure("avg_likes", "average_likes", s.Mean, _number("video_like_count", "double")),
    ),
    order=(("date", False), ("tag", False)),
    prepare=_by_tag,
)

GEOGRAPHIC_DISTRIBUTION = Report(
    "geographic_distribution",
    {"country": _column("channel_country"), "date": _day("channel_created_at")},
    (
        Measure(
            "channel_count", "channel_count", s.Distinct, lambda _as_of: F.col("channel_username")
        ),
        Measure("total_followers", "total_followers", s.Sum, _number("channel_followers_count")),
        Measure(
            "total_video_visits", "total_video_visits", s.Sum, _number("channel_total_video_visit")
        ),
    ),
    order=(("channel_count", True), ("country", False), ("date", False)),
)

CHANNEL_ACTIVITY = Report(
    "channel_activity_trends",
    {
        "channel_username": _column("channel_username"),
        "created_date": _day("channel_created_at"),
        "start_date": _start_date,
    },
    (
        Measure("update_count", "total_updates", s.Sum, _number("channel_update_count")),
        Measure("activity_duration", "max_activity_duration", s.Max, _active_days),
        Measure("average_updates_per_day", "avg_updates_per_day", s.Mean, _updates_per_day),
    ),
    date="created_date",
    report_keys=("channel_username", "created_date"),
)

REPORTS = {
    report.name: report
    for report in (
        CHANNEL_GROWTH,
        TOP_CHANNELS,
        VIDEO_ENGAGEMENT,
        CONTENT_POPULARITY,
        GEOGRAPHIC_DISTRIBUTION,
        CHANNEL_ACTIVITY,
    )
}


def growth_raw_counts(states: DataFrame) -> DataFrame:
    """Channel growth counted as stored: the number of states per key, not their merged values."""
    return (
        states.groupBy("channel_username", "date")
        .agg(
            F.count("followers_count").alias("followers_states"),
            F.count("video_count").alias("video_states"),
        )
        .orderBy("date", "channel_username")
    )


def at_channel_grain(events: DataFrame) -> DataFrame:
    """Silver cut to one row per channel and creation date.

    Silver repeats a channel for each of its videos, so the geographic sums count it that often.
    Feeding the report with these rows counts each channel once.
    """
    return events.groupBy(
        "channel_id", "channel_username", "channel_country", "channel_created_at"
    ).agg(
        F.max("channel_followers_count").alias("channel_followers_count"),
        F.max("channel_total_video_visit").alias("channel_total_video_visit"),
    )
