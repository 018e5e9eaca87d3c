"""Money and ratios.

Money arrives as DOUBLE. A sum of doubles depends on the order of the rows, so a re-run after a lost
executor may differ in the last digit, and a rounded average may then fall on the other side of a
half cent. An amount with up to four decimals below 10^14 is therefore summed as DECIMAL(18,4). Any other
(more decimals, larger, NaN, infinite) is summed as the DOUBLE it is, beside those: no amount is cut, left
out or fails the job, and a NaN or infinite amount shows in its total. A sum is a struct of the two parts
until it is shown, so that it can be summed again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(18,4)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money_parts(amount: Column | str) -> Column:
    """A DOUBLE amount as a struct: ``exact`` as a decimal, or ``rest`` if a decimal would change it."""
    amount = _column(amount)
    decimal = amount.try_cast(_EXACT)
    fits = decimal.cast("double").eqNullSafe(amount)
    return F.struct(F.when(fits, decimal).alias("exact"), F.when(~fits, amount).alias("rest"))


def money_add(parts: Column | str, over=None) -> Column:
    """Sum of amounts or of sums, again as parts; a running one with a window."""
    sums = [F.sum(_column(parts)[name]) for name in ("exact", "rest")]
    exact, rest = (s.over(over) for s in sums) if over is not None else sums
    return F.struct(exact.alias("exact"), rest.alias("rest"))


def money_value(parts: Column | str, digits: int | None = 2, count: Column | None = None) -> Column:
    """A sum of parts as DOUBLE, divided by a count if one is given; NULL if there is no amount or the count
    is zero. It is rounded unless ``digits`` is None."""
    exact, rest = _column(parts)["exact"], _column(parts)["rest"]
    both = F.coalesce(exact.cast("double"), F.lit(0.0)) + rest
    if count is not None:
        exact, both = F.try_divide(exact, count), F.try_divide(both, count)
    if digits is not None:
        exact, both = F.round(exact, digits), F.round(both, digits)
    return F.when(rest.isNull(), exact.cast("double")).otherwise(both)


def money_sum(amount: Column | str, digits: int | None = 2) -> Column:
    """Sum of DOUBLE amounts as DOUBLE, rounded unless ``digits`` is None."""
    return money_value(money_add(money_parts(amount)), digits)


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded ratio of two whole numbers; NULL when the second is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)
