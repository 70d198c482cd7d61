"""Timestamps, calendar parts and day slices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks import fixed_values as fv

_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}


def plausible_ms(ms: Column) -> Column:
    """Whether epoch milliseconds lie in the years 1 to 9999 that a timestamp covers."""
    return ms.between(-62_135_596_800_000, 253_402_300_799_999)


def from_epoch_ms(ms: Column) -> Column:
    """Exact; dividing by 1000 would pass through a double. NULL outside the range of a
    timestamp, so that one absurd message cannot fail a run."""
    return F.when(plausible_ms(ms), F.timestamp_millis(ms))


def from_epoch_seconds(seconds: Column) -> Column:
    return from_epoch_ms(F.when(F.abs(seconds) < 10**12, seconds * 1000))


def from_iso(text: Column) -> Column:
    """ISO text to timestamp, NULL when unreadable."""
    return text.try_cast("timestamp")


def calendar_parts(moment: Column, parts: tuple[str, ...]) -> dict[str, Column]:
    """Partition columns named ``parts`` for a timestamp."""
    return {part: _PARTS[part](moment) for part in parts}


def start_of(unit: str, moment: Column) -> Column:
    return F.date_trunc(unit, moment)


def minutes_between(earlier: Column, later: Column) -> Column:
    """Elapsed minutes with microsecond resolution, as double."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60_000_000.0)


def horizon_start(as_of: Column, horizon: str = fv.HORIZON) -> Column:
    return as_of - F.expr(f"interval {horizon}")


def as_moment(value: Column | dt.datetime | str | None) -> Column:
    """A point in time: a column, a datetime, ISO text in UTC, or now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def within_days(first: dt.date, last: dt.date, hour: int | None = None) -> Column:
    """Predicate on the partition columns for the days ``first..last``, inclusive.

    It reads partition columns only, so the scan lists just the matching folders.
    """
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    bounds = [d.year * 10000 + d.month * 100 + d.day for d in (first, last)]
    wanted = number.between(*bounds)
    return wanted if hour is None else wanted & (F.col("hour") == hour)
