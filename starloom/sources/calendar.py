"""The generated calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import dates as D

CALENDAR_START = dt.date(2011, 1, 1)


def calendar_range(as_of: dt.date, start: dt.date = CALENDAR_START, years_ahead: int = 10):
    """First and last day: from ``start`` to ``years_ahead`` years past ``as_of``."""
    try:
        return start, as_of.replace(year=as_of.year + years_ahead)
    except ValueError:  # 29 February
        return start, as_of.replace(year=as_of.year + years_ahead, day=28)


def day_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    days = (end - start).days + 1
    return spark.range(0, days, 1, 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("DateKey"))


def calendar_columns(days: DataFrame, day: str = "DateKey") -> DataFrame:
    """Calendar attributes for every row of ``days``."""
    d = F.col(day)
    holiday = D.holiday_name(d)
    return days.select(
        d.alias("DateKey"),
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.weekofyear(d).alias("Week"),
        D.iso_weekday(d).alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.dayofmonth(d).alias("DayOfMonth"),
        F.dayofyear(d).alias("DayOfYear"),
        F.weekofyear(d).alias("WeekOfYear"),
        (D.iso_weekday(d) >= 6).cast("int").alias("IsWeekend"),
        (holiday != "").cast("int").alias("IsHoliday"),
        holiday.alias("HolidayName"),
        D.fiscal_year(d).alias("FiscalYear"),
        D.fiscal_quarter(d).alias("FiscalQuarter"),
        D.fiscal_month(d).alias("FiscalMonth"),
        D.season(d).alias("Season"),
    )


def build_calendar(spark: SparkSession, as_of: dt.date, start: dt.date = CALENDAR_START, years_ahead: int = 10):
    return calendar_columns(day_range(spark, *calendar_range(as_of, start, years_ahead)))
