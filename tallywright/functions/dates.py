"""Calendar expressions. Timestamps are zone-free (`timestamp_ntz`) throughout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

ONE_MONTH = "interval 1 month"


def moment(value: dt.datetime) -> Column:
    """A zone-free time literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def truncated(unit: str, value: Column) -> Column:
    """Start of the month, quarter or year, without a time zone."""
    return F.date_trunc(unit, value).cast("timestamp_ntz")


def month_before(value: Column) -> Column:
    """Same instant a month earlier, clamped to the end of a shorter month."""
    return value - F.expr(ONE_MONTH)


def padded_month(value: Column) -> Column:
    """Month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(value, "MMMM"), 9, " ")


def padded_weekday(value: Column) -> Column:
    return F.rpad(F.date_format(value, "EEEE"), 9, " ")


def month_sort_label(value: Column) -> Column:
    """`MM - Month`, with the padded month name."""
    return F.concat(F.date_format(value, "MM"), F.lit(" - "), padded_month(value))


def weekday_label(value: Column) -> Column:
    """`MM-DD-YYYY - Day`, with the padded day name."""
    return F.concat(F.date_format(value, "MM-dd-yyyy"), F.lit(" - "), padded_weekday(value))


def us_week(value: Column) -> Column:
    """Week of the year where weeks start on Sunday and 1 January is in week 1."""
    first_weekday = F.dayofweek(F.trunc(value, "year"))
    return (F.floor((F.dayofyear(value) + first_weekday - 2) / 7) + 1).cast("int")


def shifted_hours(value: Column, hours: Column) -> Column:
    return value + F.make_interval(hours=hours)


def calendar(start: dt.date, end: dt.date) -> Column:
    """Array of every day from start to end, both included."""
    return F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))


PERIOD_WEEK, PERIOD_MONTH, PERIOD_QUARTER, PERIOD_YEAR = 1, 2, 3, 4


def period_label(mode: int, local_time: Column) -> Column:
    """Label of the period a store-local time falls in.

    The week label joins the year of the local date to the week of the day before it; a January day whose day before
    falls in the last weeks of the old year is put in week 1.
    """
    year = F.year(local_time).cast("string")
    if mode == PERIOD_WEEK:
        week = us_week(F.date_sub(F.to_date(local_time), 1))
        week = F.when((F.month(local_time) == 1) & (week > 50), F.lit(1)).otherwise(week)
        return F.concat(year, F.lit(" - Week "), week.cast("string"))
    if mode == PERIOD_MONTH:
        return F.concat(year, F.lit(" - "), F.date_format(local_time, "MMMM"))
    if mode == PERIOD_QUARTER:
        return F.concat(year, F.lit(" - Q"), F.quarter(local_time).cast("string"))
    if mode == PERIOD_YEAR:
        return year
    return F.lit(None).cast("string")


def previous_month_tag(today: Column) -> Column:
    """`MON YYYY` of the month before."""
    return F.upper(F.date_format(F.add_months(today, -1), "MMM yyyy"))


def first_of_next_month(value: Column) -> Column:
    return F.date_add(F.last_day(value), 1)


def within_days(value: Column, start: dt.date, end: dt.date) -> Column:
    """Whole days from start to end, both included, as a half-open range."""
    return (value >= F.lit(start)) & (value < F.lit(end + dt.timedelta(days=1)))
