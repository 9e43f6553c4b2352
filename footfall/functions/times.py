"""Time functions over epoch-millisecond columns and ``yyyyMMdd`` day strings.

Days and hours are cut in ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyyMMdd"
CLOCK_TOLERANCE_MS = 3000


def to_millis(epoch: Column) -> Column:
    """10-digit epoch seconds become milliseconds; other values stay."""
    value = epoch.cast("long")
    return F.when(F.length(value.cast("string")) == 10, value * 1000).otherwise(value)


def format_millis(ms: Column, pattern: str = DAY) -> Column:
    return F.date_format(F.timestamp_millis(ms), pattern)


def day_of(ms: Column) -> Column:
    return format_millis(ms, DAY)


def hour_of(ms: Column) -> Column:
    return format_millis(ms, "HH")


def hour_minute_of(ms: Column) -> Column:
    return format_millis(ms, "HH:mm")


def to_date(day: Column, pattern: str = DAY) -> Column:
    return F.to_date(day, pattern)


def shift_day(day: Column, days: int | Column, pattern: str = DAY) -> Column:
    return F.date_format(F.date_add(to_date(day), days), pattern)


def shift_months(day: Column, months: int, pattern: str = DAY) -> Column:
    return F.date_format(F.add_months(to_date(day), months), pattern)


def yesterday(day: Column) -> Column:
    return shift_day(day, -1)


def day_start(day: Column) -> Column:
    """First millisecond of a ``yyyyMMdd`` day."""
    return F.unix_millis(F.to_timestamp(day, DAY))


def next_day_start(day: Column) -> Column:
    return F.unix_millis(F.date_add(to_date(day), 1).cast("timestamp"))


def parse_millis(text: Column, pattern: str) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern)))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(to_date(later), to_date(earlier))


def in_day(ms: Column, day: Column) -> Column:
    return (ms >= day_start(day)) & (ms < next_day_start(day))


def clock_difference(server: Column, client: Column) -> Column:
    """Server minus client clock in ms, 0 when it is within three seconds."""
    diff = to_millis(server) - to_millis(client)
    return F.when(F.abs(diff) < CLOCK_TOLERANCE_MS, F.lit(0).cast("long")).otherwise(diff)


def counter_expiry(day: Column) -> Column:
    """02:00 of the following day, when a day's running counters may be dropped."""
    return next_day_start(day) + 2 * 3600 * 1000
