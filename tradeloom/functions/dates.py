"""Date helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(moment: Column | str) -> Column:
    """The day of a date or timestamp as the integer ``yyyyMMdd`` (arithmetic, no text formatting)."""
    c = _column(moment)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def parse_timestamp(text: Column | str) -> Column:
    """Text to timestamp; malformed text becomes NULL instead of failing the job."""
    return F.try_to_timestamp(_column(text))


def as_date(value: dt.date | str) -> Column:
    """A date literal from a date or ISO text."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)
