"""Wall-clock arithmetic on TIMESTAMP_NTZ, DATE and second-of-day integers.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hms(text: str) -> int:
    """'HH:MM:SS' as a second of the day."""
    hours, minutes, seconds = (int(part) for part in text.split(":"))
    return hours * 3600 + minutes * 60 + seconds


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def elapsed_seconds(start: Column, end: Column) -> Column:
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * 86400 + second_of_day(end) - second_of_day(start)


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, so 10:00:59 to 10:01:00 is one minute."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    minutes = lambda ts: F.hour(ts) * 60 + F.minute(ts)
    return days * 1440 + minutes(end) - minutes(start)


def clock_text(ts: Column) -> Column:
    """'HH:MM:SS' of a timestamp."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 12, 8)


def hour_minute_text(second: Column) -> Column:
    """24-hour 'HH:MM' of a second of the day."""
    parts = F.format_string("%02d:%02d", F.floor(second / 3600), F.floor(second / 60) % 60)
    return F.when(second.isNotNull(), parts)


def is_weekday(day: Column, *numbers: int) -> Column:
    """Sunday is 1, Saturday is 7."""
    return F.dayofweek(day).isin(*numbers)


def hours_of_seconds(seconds: Column) -> Column:
    return (seconds.cast("decimal(10,0)") / F.lit(3600).cast("decimal(10,6)")).cast("decimal(27,11)")


def hours_of_minutes(minutes: Column) -> Column:
    return (minutes.cast("decimal(10,0)") / F.lit(60).cast("decimal(4,2)")).cast("decimal(18,6)")
