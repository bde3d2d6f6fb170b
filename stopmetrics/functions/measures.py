"""Delay measures and calendar parts. Two delay units exist on purpose: fractional and whole minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopmetrics.functions.typing_rules import parse_timestamp

SIGNIFICANT_DELAY_MIN = 3


def _seconds_between(start: Column, end: Column) -> Column:
    """Wall-clock seconds; a difference of zone-less times, so clock changes do not shift it."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes as a double, rounded to 3 decimals."""
    return F.round(_seconds_between(start, end).cast("double") / F.lit(60.0), 3)


def whole_minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes, truncated toward zero: 59 seconds late is 0, 59 seconds early is 0."""
    return (_seconds_between(start, end).cast("double") / F.lit(60.0)).cast("bigint")


def delay_minutes() -> Column:
    """Arrival delay of a raw stop event; no filter on status or cancellation."""
    return minutes_between(parse_timestamp(F.col("ANKUNFTSZEIT")), parse_timestamp(F.col("AN_PROGNOSE")))


def delay_minutes_by_parts() -> Column:
    """The same delay from days and clock parts; a second formula to check the first one."""
    scheduled = parse_timestamp(F.col("ANKUNFTSZEIT"))
    actual = parse_timestamp(F.col("AN_PROGNOSE"))

    def second_of_day(at: Column) -> Column:
        return F.hour(at) * 3600 + F.minute(at) * 60 + F.date_part(F.lit("SECOND"), at).cast("double")

    days = F.datediff(actual.cast("date"), scheduled.cast("date"))
    return F.round((days * 86400 + second_of_day(actual) - second_of_day(scheduled)) / F.lit(60.0), 3)


def is_delayed(delay: Column) -> Column:
    return delay > 0


def is_significantly_delayed(delay: Column) -> Column:
    return delay >= SIGNIFICANT_DELAY_MIN


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 3 decimals; NULL when there is nothing to share."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 3)


def hour_of_day(at: Column) -> Column:
    return F.hour(at)


def day_of_week(day: Column) -> Column:
    """0 is Monday."""
    return F.weekday(day)


def season(day: Column) -> Column:
    month = F.month(day)
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .when(month.isin(9, 10, 11), "autumn")
    )
