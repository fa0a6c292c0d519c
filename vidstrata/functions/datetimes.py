"""Date and time expressions. Session time zone is UTC throughout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms and the limits of a four-digit year in epoch seconds.
ISO_FORM = r"^\d{4}-\d{2}-\d{2}T\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"
PLAIN_FORM = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"
STARTS_WITH_YEAR = r"^\d{4}-"
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799
# Integers below this are day numbers, from there on epoch seconds.
DAY_NUMBER_LIMIT = 65536


def epoch() -> Column:
    return F.timestamp_seconds(F.lit(0))


def lenient_timestamp(text: Column) -> Column:
    """ISO text with a ``T``, or ``Y-M-D h:m:s``; anything else, NULL included, is the epoch."""
    # Cast alone would also accept "T10:11", which it completes with today's date.
    iso = F.when(text.rlike(ISO_FORM), F.regexp_replace(text, ",", ".").try_cast("timestamp"))
    plain = F.when(
        text.rlike(PLAIN_FORM),
        F.try_to_timestamp(F.regexp_replace(text, r"\s+", " "), F.lit("y-M-d H:m:s")),
    )
    return F.coalesce(F.when(text.contains("T"), iso).otherwise(plain), epoch())


def stored_timestamp(text: Column) -> Column:
    """Date text to timestamp, NULL when it is not a date."""
    return F.when(text.rlike(STARTS_WITH_YEAR), text.try_cast("timestamp"))


def iso_seconds(seconds: Column) -> Column:
    """Epoch seconds as ISO text, NULL outside the years 1 to 9999."""
    inside = F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)
    return F.date_format(F.timestamp_seconds(inside), "yyyy-MM-dd'T'HH:mm:ss")


def iso_text(moment: Column) -> Column:
    """Timestamp as ISO text, with microseconds only when there are any."""
    return F.when(
        F.date_trunc("second", moment) == moment, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def millis_timestamp(millis: Column) -> Column:
    """Epoch milliseconds as timestamp, NULL outside the years 1 to 9999."""
    inside = F.when(millis.between(FIRST_SECOND * 1000, LAST_SECOND * 1000 + 999), millis)
    return F.timestamp_millis(inside)


def date_of_number(number: Column) -> Column:
    """Small integers are day numbers since 1970, larger ones epoch seconds."""
    return F.when(
        number < DAY_NUMBER_LIMIT, F.date_from_unix_date(number.cast("int"))
    ).otherwise(F.to_date(F.timestamp_seconds(number)))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, never below 0."""
    return F.greatest(F.datediff(end, start), F.lit(0)).cast("bigint")


def as_date(as_of: dt.date | str | None) -> Column:
    """The report date: a fixed day, or the day the query runs."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMM")


def leading_date(key: Column) -> Column:
    """Date that starts the first part of an object key; NULL when there is none.

    The first blank-separated word of the part before the first slash, month and day with or
    without a leading zero.
    """
    # split drops nothing, so a leading blank must be trimmed to reach the first word
    word = F.split(F.ltrim(F.split(key, "/")[0]), r"\s+")[0]
    return F.when(
        word.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"),
        F.to_date(F.try_to_timestamp(word, F.lit("y-M-d"))),
    )
