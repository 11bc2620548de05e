"""Time buckets and time texts, all in the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_SECONDS = 300

# Month names of the year-less time stamp.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def whole(value: Column, by: int) -> Column:
    """Integer division, exact for any size."""
    return F.call_function("div", value, F.lit(by).cast("long"))


def moment(value: datetime | str | Column) -> Column:
    """A timestamp column of a driver-side batch time."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp")


def minus_seconds(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(ts) - seconds)


def slot(ts: Column, seconds: int = SLOT_SECONDS) -> Column:
    """Start of the five-minute slot that holds ``ts``."""
    at = F.unix_timestamp(ts)
    return F.timestamp_seconds(at - F.pmod(at, F.lit(seconds)))


def full_time(day: Column, clock: Column) -> Column:
    """Timestamp of ``yyyy-MM-dd`` and ``HH:mm:ss``; NULL where a field is out of range."""
    return F.concat_ws(" ", day, clock).try_cast("timestamp")


def near_year(month: Column, near: Column) -> Column:
    """The year that puts a month nearest to a time: December is last year's in January."""
    ahead = month - F.month(near)
    return F.year(near) + F.when(ahead > 6, -1).when(ahead < -6, 1).otherwise(0)


def short_time(month: Column, day: Column, clock: Column, year: int | Column) -> Column:
    """Timestamp of a year-less ``Jun 7 09:07:06``, else NULL.

    ``year`` is a number, or the time that the line belongs to, which gives the year
    of each line.
    """
    number = F.array_position(F.array(*map(F.lit, MONTHS)), month)
    year = near_year(number, year) if isinstance(year, Column) else F.lit(year)
    date = F.concat_ws("-", year.cast("string"), F.lpad(number.cast("string"), 2, "0"), day)
    return F.when(number > 0, full_time(date, clock))


def iso_slot(text: Column, offset: str = "+08:00") -> Column:
    """Five-minute slot of an ISO time text; its offset is dropped, not applied."""
    plain = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit(offset), F.lit(" "))
    minute = F.substring(plain, 1, 16)
    return slot(F.when(F.length(minute) == 16, minute.try_cast("timestamp")))


def format_millis(millis: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_millis(millis), pattern)


def task_buckets(now: Column) -> dict[str, Column]:
    """Last complete hour, six hours, day and five minutes before ``now``.

    Each has an ``_end`` and a ``_start`` column; lengths are fixed seconds.
    """
    day = F.date_trunc("day", now)
    six = F.make_timestamp(
        F.year(now), F.month(now), F.dayofmonth(now),
        F.hour(now) - F.hour(now) % 6, F.lit(0), F.lit(0),
    )
    ends = {
        "hour": (F.date_trunc("hour", now), 3600),
        "six_hours": (six, 21600),
        "day": (day, 86400),
        "five_minutes": (slot(now), SLOT_SECONDS),
    }
    out = {}
    for name, (end, length) in ends.items():
        out[f"{name}_end"] = end
        out[f"{name}_start"] = minus_seconds(end, length)
    return out
