"""Calendar arithmetic; every function takes its reference time as an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Minutes east of UTC of the reporting zone.
ZONE_MINUTES = 330


def next_business_day(start: Column, days: int, hour: int = 5) -> Column:
    """The days-th weekday after start, at an hour."""
    ahead = F.sequence(F.date_add(start.cast("date"), 1), F.date_add(start.cast("date"), 7 + 2 * days))
    day = F.get(F.filter(ahead, lambda d: F.weekday(d) < 5), F.lit(days - 1))
    return F.timestamp_add("HOUR", F.lit(hour), day.cast("timestamp_ntz"))


def working_days(start: Column, end: Column) -> Column:
    days = F.when(end >= start, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return F.greatest(F.lit(1), F.size(F.filter(days, lambda d: F.weekday(d) < 5)))


def local_day(ts: Column) -> Column:
    return F.date_format(F.timestamp_add("MINUTE", F.lit(ZONE_MINUTES), ts), "yyyy-MM-dd")


def week_start(ts: Column) -> Column:
    return F.date_trunc("week", ts).cast("date")


def window_key(ts: Column, reset: str) -> Column:
    """Key of the quota window a time falls in."""
    if reset not in ("daily", "monthly", "none"):
        raise ValueError(f"unknown reset {reset!r}")
    return F.lit("all") if reset == "none" else F.date_format(ts, "yyyy-MM-dd" if reset == "daily" else "yyyy-MM")
