"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(c: Column) -> Column:
    """An ISO text as a timestamp, NULL when it is not one; typed times pass through."""
    return F.try_to_timestamp(c.cast("string"))


def time_or_default(c: Column, run_time: str) -> Column:
    """A missing time becomes the given run time, so that a run can be repeated."""
    filled = F.nullif(c.cast("string"), F.lit(""))
    return F.coalesce(filled, F.lit(run_time))


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def seconds_between(start: Column, end: Column) -> Column:
    """Length of an interval in seconds, NULL when either end is missing."""
    return (
        F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    ) / F.lit(1e6)
