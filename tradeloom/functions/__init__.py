"""Column helpers, all built from Spark's own functions."""

from tradeloom.functions.dates import as_date, date_key, parse_timestamp
from tradeloom.functions.numbers import money_add, money_parts, money_sum, money_value, rate

__all__ = ["as_date", "date_key", "parse_timestamp", "money_add", "money_parts", "money_sum", "money_value",
           "rate"]
