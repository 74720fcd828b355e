"""Timestamps, dates and times of day."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_timestamp(text: Column) -> Column:
    """`yyyy/MM/dd HH:mm:ss.SSS` to TIMESTAMP_NTZ; null when impossible.

    The text must already have that shape, digit for digit. A day that the month lacks (31 April,
    30 February) becomes the last day of the month, and 24:00:00.000 the next midnight. Day 0 or
    32, year 0, month 13 and second 60 are impossible.
    """
    midnight = F.endswith(text, F.lit("24:00:00.000"))
    plain = F.replace(text, F.lit("/"), F.lit("-"))
    start = F.when(midnight, F.overlay(plain, F.lit("00"), 12, 2)).otherwise(plain)
    day = F.substring(text, 9, 2)

    def stamp(day_of_month: str | None = None) -> Column:
        dated = start if day_of_month is None else F.overlay(start, F.lit(day_of_month), 9, 2)
        return dated.try_cast("timestamp_ntz")

    # Only a late day that did not parse is tried again, with the days before it.
    found = F.coalesce(
        stamp(),
        F.when(day == "31", stamp("30")),
        F.when(day.isin("30", "31"), stamp("29")),
        F.when(day.isin("29", "30", "31"), stamp("28")),
    )
    return F.when(
        ~F.startswith(text, F.lit("0000")),
        F.when(midnight, found + F.expr("INTERVAL 1 DAY")).otherwise(found),
    )


def day_text(stamp: Column) -> Column:
    """Date as yyyyMMdd text."""
    return F.date_format(stamp, "yyyyMMdd")


def seconds_of_day(hhmmss: Column) -> Column:
    """Six digits HHmmss to seconds after midnight."""
    return (
        F.substring(hhmmss, 1, 2).try_cast("int") * 3600
        + F.substring(hhmmss, 3, 2).try_cast("int") * 60
        + F.substring(hhmmss, 5, 2).try_cast("int")
    )


def weekday_digit(day: Column) -> Column:
    """Sunday 0 to Saturday 6."""
    return F.dayofweek(day) - 1
