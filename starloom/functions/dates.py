"""Calendar attributes, holiday rules and date coercion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.bands import first_match

#: The open end of a validity interval and the latest timestamp stored.
FAR_FUTURE = dt.date(2100, 12, 31)
MAX_TIMESTAMP = dt.datetime(2100, 12, 31)

# The holiday calendar.
# Name, month, and either a day of the month or (ISO weekday, first day, last day).
HOLIDAYS = (
    ("New Year's Day", 1, 1),
    ("Martin Luther King Jr. Day", 1, (1, 15, 21)),
    ("Presidents' Day", 2, (1, 15, 21)),
    ("Memorial Day", 5, (1, 25, 31)),
    ("Independence Day", 7, 4),
    ("Labor Day", 9, (1, 1, 7)),
    ("Columbus Day", 10, (1, 8, 14)),
    ("Veterans Day", 11, 11),
    ("Thanksgiving", 11, (4, 22, 28)),
    ("Christmas Day", 12, 25),
)

# Season by month; the remaining months are Fall.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + F.lit(1)


def holiday_name(day: Column) -> Column:
    """Holiday falling on ``day``, '' for an ordinary day."""
    rungs = []
    for name, month, rule in HOLIDAYS:
        test = F.month(day) == month
        if isinstance(rule, tuple):
            weekday, first, last = rule
            test &= (iso_weekday(day) == weekday) & F.dayofmonth(day).between(first, last)
        else:
            test &= F.dayofmonth(day) == rule
        rungs.append((test, name))
    return first_match(rungs, "")


def season(day: Column) -> Column:
    return first_match([(F.month(day).isin(*months), name) for name, months in SEASONS.items()], "Fall")


def fiscal_month(day: Column) -> Column:
    """The fiscal year starts in July: July is month 1."""
    return F.pmod(F.month(day) + F.lit(5), F.lit(12)) + F.lit(1)


def fiscal_quarter(day: Column) -> Column:
    return F.ceil(fiscal_month(day) / F.lit(3)).cast("int")


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, 6))


def truncate(unit: str, day: Column | str) -> Column:
    """Start of the week (Monday), month, quarter or year, as DATE."""
    return F.trunc(F.col(day) if isinstance(day, str) else day, unit).cast("date")


def whole_years(start: Column, end: Column) -> Column:
    """Completed years between two dates."""
    return F.floor(F.months_between(end, start) / F.lit(12)).cast("int")


def coerce_date(column: Column | str, as_of: dt.date) -> Column:
    """DATE of a string, date or timestamp; anything unusable becomes ``as_of``."""
    value = F.col(column) if isinstance(column, str) else column
    text = F.substring(value.cast("string"), 1, 10)
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.lit(as_of))
