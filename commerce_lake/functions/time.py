"""Calendar arithmetic and time predicates. The session zone is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(value: Column | dt.datetime | str) -> Column:
    """A point in time given as column, datetime or 'YYYY-MM-DD hh:mm:ss' in UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.UTC).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def as_date(value: Column | dt.date | str) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def on_day(ts: Column, day: Column | dt.date | str) -> Column:
    """`ts` falls on `day`, written as a half-open range so that it is pushed to the scan."""
    start = as_date(day).cast("timestamp")
    return (ts >= start) & (ts < F.date_add(as_date(day), 1).cast("timestamp"))


def local_date(as_of: Column | dt.datetime | str, tz: str) -> Column:
    """Calendar date at `as_of` on a wall clock in `tz`."""
    return F.to_date(F.from_utc_timestamp(as_timestamp(as_of), tz))


def is_today(ts: Column, as_of: Column | dt.datetime | str, tz: str) -> Column:
    """Stored date equals the current date of `tz` (the two zones may differ)."""
    return on_day(ts, local_date(as_of, tz))


def within_lookback(ts: Column, as_of: Column | dt.datetime | str, lookback: str) -> Column:
    """`as_of - lookback <= ts <= as_of`; `lookback` is an interval such as '15 minutes'."""
    now = as_timestamp(as_of)
    return (ts >= now - F.expr(f"INTERVAL {lookback}")) & (ts <= now)


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of full-hour marks between two times: 1 for 01:59 to 02:01."""
    hours = F.unix_seconds(F.date_trunc("hour", end)) - F.unix_seconds(F.date_trunc("hour", start))
    return F.call_function("div", hours, F.lit(3600).cast("bigint"))


def slot_start(ts: Column, minutes: int) -> Column:
    """Start of the slot of `minutes`, counted from 1970-01-01, that contains `ts`."""
    slot = F.unix_seconds(ts) - F.pmod(F.unix_seconds(ts), F.lit(60 * minutes).cast("bigint"))
    return F.timestamp_seconds(slot)


def five_minute_start(ts: Column) -> Column:
    """Start of the five-minute slot that contains `ts`."""
    return slot_start(ts, 5)


def iso_weekday(d: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(d) + 1


def calendar_columns(d: Column) -> list[Column]:
    """Attributes of the calendar dimension for the date `d`."""
    return [
        d.alias("date_key"),
        F.trunc(d, "week").alias("start_day_of_week"),
        F.trunc(d, "month").alias("start_day_of_month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.when(iso_weekday(d).isin(6, 7), 1).otherwise(0).alias("is_weekend"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
    ]
