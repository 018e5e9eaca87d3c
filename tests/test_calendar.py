"""The calendar against Python's own date arithmetic."""

import calendar as pycal
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.calendar_dim import calendar_dim, calendar_spanning


def test_default_range(spark):
    days = calendar_dim(spark)
    assert days.count() == 7670 and len(days.columns) == 38


@pytest.mark.parametrize("start", [1, 4, 7, 12])
def test_fiscal_attributes(spark, start):
    for r in calendar_dim(spark, "2019-12-25", "2021-01-10", start).collect():
        d = r.calendar_date
        month = (d.month - start) % 12 + 1
        begins = d.year if d.month >= start else d.year - 1
        assert r.fiscal_month_num == month and r.fiscal_month_name == pycal.month_name[month]
        assert r.fiscal_quarter_num == (month - 1) // 3 + 1
        assert r.fiscal_quarter_name == f"FQ{(month - 1) // 3 + 1}"
        assert r.fiscal_year == begins + (1 if start > 1 else 0)
        assert r.fiscal_year_label == f"FY{r.fiscal_year}"
        assert r.fiscal_year_start_date == dt.date(begins, start, 1)
        assert r.fiscal_year_end_date == dt.date(begins + 1, start, 1) - dt.timedelta(1)


def test_calendar_attributes(spark):
    for r in calendar_dim(spark, "2020-01-01", "2020-12-31").collect():
        d = r.calendar_date
        quarter = (d.month - 1) // 3 + 1
        month_end = dt.date(d.year, d.month, pycal.monthrange(d.year, d.month)[1])
        quarter_end = dt.date(d.year, quarter * 3, pycal.monthrange(d.year, quarter * 3)[1])
        monday = d - dt.timedelta(d.weekday())
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert (r.day_name, r.day_name_short) == (d.strftime("%A"), d.strftime("%a"))
        assert r.day_of_week_num == d.isoweekday() % 7 + 1
        assert (r.day_of_year_num, r.week_of_year_num) == (d.timetuple().tm_yday, d.isocalendar()[1])
        assert (r.week_start_date, r.week_end_date) == (monday, monday + dt.timedelta(6))
        assert (r.month_label, r.quarter_name) == (d.strftime("%Y-%m"), f"Q{quarter}")
        assert (r.month_end_date, r.quarter_end_date) == (month_end, quarter_end)
        assert r.quarter_start_date == dt.date(d.year, quarter * 3 - 2, 1)
        assert r.is_weekend == (d.weekday() >= 5)
        assert (r.is_month_end, r.is_quarter_end, r.is_year_end) == (
            d == month_end, d == quarter_end, d == dt.date(2020, 12, 31))
        assert (r.is_month_start, r.is_quarter_start, r.is_year_start) == (
            d.day == 1, d == r.quarter_start_date, d == dt.date(2020, 1, 1))


def test_range_from_data(spark):
    dates = spark.createDataFrame([(dt.date(2020, 5, 1),), (dt.date(2021, 2, 3),), (None,)], "d DATE")
    days = calendar_spanning(dates, "d")
    assert (days.count(), days.agg({"date_key": "min"}).first()[0]) == (731, 20200101)
    assert calendar_spanning(dates.limit(0), "d").count() == 0


def test_long_ranges_are_split_over_tasks(spark):
    wide = calendar_spanning(spark.createDataFrame([(dt.date(2001, 5, 1),), (dt.date(9999, 2, 3),)], "d DATE"), "d")
    sizes = [r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2921574 and max(sizes) < 2 * sum(sizes) / len(sizes)
    days = calendar_dim(spark, "1601-01-01", "2400-12-31")
    assert days.count() == 292194 and days.rdd.getNumPartitions() > 1
    with pytest.raises(ValueError):
        calendar_dim(spark, "2020-01-02", "2020-01-01")
