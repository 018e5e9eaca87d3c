"""The conformed calendar: one row per day with calendar and fiscal attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions import as_date, date_key

# The default range and fiscal start.
DEFAULT_START, DEFAULT_END, DEFAULT_FISCAL_START = "2015-01-01", "2035-12-31", 1
YEAR_TASKS = 8


def calendar_dim(spark: SparkSession, start: dt.date | str = DEFAULT_START,
                 end: dt.date | str = DEFAULT_END,
                 fiscal_start_month: int = DEFAULT_FISCAL_START) -> DataFrame:
    """Every day from ``start`` to ``end`` with the attributes of :func:`calendar_attributes`."""
    first, last = (dt.date.fromisoformat(str(d)) for d in (start, end))
    if last < first:
        raise ValueError(f"calendar from {first} to {last}")
    days = spark.range((last - first).days + 1).select(  # split over tasks, whatever its length
        F.date_add(as_date(first), F.col("id").cast("int")).alias("calendar_date"))
    return days.select(*calendar_attributes(F.col("calendar_date"), fiscal_start_month))


def calendar_spanning(df: DataFrame, moment: Column | str,
                      fiscal_start_month: int = DEFAULT_FISCAL_START) -> DataFrame:
    """The calendar of all whole years that the dates in ``df`` touch, found by Spark itself."""
    column = F.col(moment) if isinstance(moment, str) else moment
    bounds = df.agg(F.year(F.min(column)).alias("first"), F.year(F.max(column)).alias("last"))
    # years are dealt out before their days are made: one wrong date in the far future is no long task
    years = (bounds.filter("first IS NOT NULL").select(F.explode(F.sequence("first", "last")).alias("year"))
             .repartition(YEAR_TASKS, "year"))
    first, last = (F.make_date(F.col("year"), F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
    days = years.select(F.explode(F.sequence(first, last)).alias("calendar_date"))
    return days.select(*calendar_attributes(F.col("calendar_date"), fiscal_start_month))


def calendar_attributes(day: Column, fiscal_start_month: int = DEFAULT_FISCAL_START) -> list[Column]:
    """The 38 attributes of a date column.

    A fiscal year that starts after January carries the number of the calendar year it ends in. The
    fiscal month name is the name of the month that many months into a calendar year.
    """
    if not 1 <= fiscal_start_month <= 12:
        raise ValueError(f"fiscal year starting in month {fiscal_start_month}")
    shift = fiscal_start_month - 1
    year, month, quarter = F.year(day), F.month(day), F.quarter(day)
    week_start = F.date_sub(day, F.weekday(day))
    month_start, month_end = F.trunc(day, "month"), F.last_day(day)
    quarter_start, year_start = F.trunc(day, "quarter"), F.trunc(day, "year")
    quarter_end = F.last_day(F.add_months(quarter_start, 2))
    year_end = F.last_day(F.add_months(year_start, 11))
    # The same day counted from the start of its fiscal year falls into this calendar month.
    shifted = F.add_months(month_start, -shift)
    fiscal_start = F.add_months(F.trunc(shifted, "year"), shift)
    fiscal_month = F.month(shifted)
    fiscal_quarter = F.quarter(shifted).cast("bigint")
    fiscal_year = F.year(shifted) + F.lit(1 if shift else 0)

    # Column names and order.
    columns = {
        "date_key": date_key(day),
        "calendar_date": day,
        "day_name": F.date_format(day, "EEEE"),
        "day_name_short": F.date_format(day, "E"),
        "day_of_week_num": F.dayofweek(day),
        "day_of_month_num": F.dayofmonth(day),
        "day_of_year_num": F.dayofyear(day),
        "week_of_year_num": F.weekofyear(day),
        "week_start_date": week_start,
        "week_end_date": F.date_add(week_start, 6),
        "month_num": month,
        "month_name": F.date_format(day, "MMMM"),
        "month_name_short": F.date_format(day, "MMM"),
        "month_label": F.date_format(day, "yyyy-MM"),
        "quarter_num": quarter,
        "quarter_name": F.concat(F.lit("Q"), quarter),
        "year_num": year,
        "month_start_date": month_start,
        "month_end_date": month_end,
        "quarter_start_date": quarter_start,
        "quarter_end_date": quarter_end,
        "year_start_date": year_start,
        "year_end_date": year_end,
        "is_weekend": F.weekday(day) >= 5,
        "is_month_start": day == month_start,
        "is_month_end": day == month_end,
        "is_quarter_start": day == quarter_start,
        "is_quarter_end": day == quarter_end,
        "is_year_start": day == year_start,
        "is_year_end": day == year_end,
        "fiscal_month_num": fiscal_month,
        "fiscal_month_name": F.date_format(shifted, "MMMM"),
        "fiscal_quarter_num": fiscal_quarter,
        "fiscal_quarter_name": F.concat(F.lit("FQ"), fiscal_quarter),
        "fiscal_year": fiscal_year,
        "fiscal_year_label": F.concat(F.lit("FY"), fiscal_year),
        "fiscal_year_start_date": fiscal_start,
        "fiscal_year_end_date": F.last_day(F.add_months(fiscal_start, 11)),
    }
    return [column.alias(name) for name, column in columns.items()]
