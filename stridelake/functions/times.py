"""Calendar and timestamp expressions. They assume a UTC session (see ``session.configure``)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

LOCAL_OFFSET_HOURS = -5  # fixed value, no daylight saving
INDEX_TIMESTAMP = "MMM d, yyyy, h:mm:ss a"


def local_hour(ts: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return F.pmod(F.hour(ts) + F.lit(offset_hours), F.lit(24))


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def week_start(ts: Column) -> Column:
    """The Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", ts))


def week_label(day: Column) -> Column:
    """``Jun 1``."""
    return F.date_format(day, "MMM d")


def week_day_key(day: Column) -> Column:
    """``06-01``; a display form only, it repeats every few years and must not be a join key."""
    return F.date_format(day, "MM-dd")


def parse_index_ts(text: Column) -> Column:
    """``Jul 5, 2026, 6:15:00 AM``; text of another shape gives null."""
    return F.try_to_timestamp(text, F.lit(INDEX_TIMESTAMP))


def parse_iso_utc(text: Column) -> Column:
    """ISO text with or without a ``Z`` suffix; both mean UTC."""
    return F.try_to_timestamp(text)


def nanos_to_ts(nanos: Column) -> Column:
    """Text that is no whole number of nanoseconds gives null."""
    return F.timestamp_micros(F.call_function("div", nanos.try_cast("long"), F.lit(1000)))


def end_time(start: Column, seconds: Column) -> Column:
    """``start`` plus a number of seconds, at microsecond precision."""
    return F.timestamp_micros(
        F.unix_micros(start) + F.rint(F.coalesce(seconds, F.lit(0.0)) * F.lit(1e6)).cast("long"))


def seconds_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def since(ts: Column, first_day: date | str) -> Column:
    return ts >= F.lit(str(first_day)).cast("timestamp")
