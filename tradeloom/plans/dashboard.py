"""Dashboard marts: facts by calendar period.

Facts are first reduced to a narrow integer key (the day, or the month through a two-column calendar)
and only the small result is decorated with the calendar's names. Days missing in the calendar drop
out, as an inner join demands.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import as_date, money_add, money_parts, money_value, rate
from tradeloom.plans.gold import order_totals

_MONTH = ["year_num", "month_num", "month_label", "month_name"]


def daily_order_facts(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue, orders, lines and packs per day of the order date (orders without lines left out).

    An order has one date, so all of these add up to any longer period.
    """
    return (order_totals(lines).join(orders.select("order_id", "date_key"), "order_id")
            .groupBy("date_key")
            .agg(F.count("order_id").alias("orders"), money_add("amount").alias("amount"),
                 *(F.sum(c).alias(c) for c in ("line_count", "priced_lines",
                                               "packs_ordered", "packs_confirmed"))))


def daily_revenue(orders: DataFrame, lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue, orders, lines and average line amount per day."""
    names = ["calendar_date", "day_name", "month_num", "month_name", "year_num", "fiscal_year",
             "is_weekend"]
    return (daily_order_facts(orders, lines).join(calendar.select("date_key", *names), "date_key")
            .select(*names, money_value("amount").alias("total_revenue"),
                    F.col("orders").alias("order_count"),
                    F.col("line_count").alias("line_item_count"),
                    money_value("amount", count=F.col("priced_lines")).alias("avg_line_amount")))


def monthly_revenue_fiscal(orders: DataFrame, lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue, orders, average order value, packs and fulfilment per month with fiscal names."""
    names = [*_MONTH, "fiscal_year", "fiscal_year_label", "fiscal_month_num", "fiscal_quarter_num"]
    months = (daily_order_facts(orders, lines)
              .join(calendar.select("date_key", *names), "date_key").groupBy(*names))
    ordered, confirmed = F.sum("packs_ordered"), F.sum("packs_confirmed")
    return months.agg(
        money_value(money_add("amount")).alias("total_revenue"), F.sum("orders").alias("order_count"),
        money_value(money_add("amount"), count=F.sum("orders")).alias("avg_order_value"),
        ordered.alias("units_ordered"), confirmed.alias("units_confirmed"),
        rate(confirmed, ordered).alias("fulfillment_rate"))


def _fiscal_months(orders: DataFrame, lines: DataFrame, calendar: DataFrame,
                   as_of: dt.date | str) -> DataFrame:
    keys = ["fiscal_year", "fiscal_year_label", "fiscal_month_num", "fiscal_quarter_num"]
    past = calendar.filter(F.col("calendar_date").between(F.col("fiscal_year_start_date"),
                                                          as_date(as_of)))
    return (daily_order_facts(orders, lines).join(past.select("date_key", *keys), "date_key")
            .groupBy(*keys).agg(money_add("amount").alias("amount"), F.sum("orders").alias("orders")))


def _ytd(amount: Column, orders: Column) -> list[Column]:
    return [money_value(amount).alias("ytd_revenue"), orders.alias("ytd_order_count"),
            money_value(amount, count=orders).alias("ytd_avg_order_value")]


def _quarter_label() -> Column:
    return F.concat(F.lit("FQ"), F.col("fiscal_quarter_num")).alias("fiscal_quarter_label")


def fiscal_ytd(orders: DataFrame, lines: DataFrame, calendar: DataFrame,
               as_of: dt.date | str) -> DataFrame:
    """Revenue per fiscal month of all years up to ``as_of``; not accumulated within the year."""
    months = _fiscal_months(orders, lines, calendar, as_of)
    return months.select("fiscal_year", "fiscal_year_label", "fiscal_month_num",
                         "fiscal_quarter_num", *_ytd(F.col("amount"), F.col("orders")),
                         _quarter_label())


def fiscal_ytd_running(orders: DataFrame, lines: DataFrame, calendar: DataFrame,
                       as_of: dt.date | str) -> DataFrame:
    """As :func:`fiscal_ytd`, accumulated from the start of each fiscal year."""
    year = (Window.partitionBy("fiscal_year").orderBy("fiscal_month_num")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    months = _fiscal_months(orders, lines, calendar, as_of)
    totals = months.withColumns({"amount": money_add("amount", over=year), "orders": F.sum("orders").over(year)})
    return totals.select("fiscal_year", "fiscal_year_label", "fiscal_month_num",
                         "fiscal_quarter_num", *_ytd(F.col("amount"), F.col("orders")),
                         _quarter_label())


def _by_month(fact: DataFrame, day: str, calendar: DataFrame, measures: list[Column],
              *more_keys: str) -> DataFrame:
    """Group a fact by month; adds the month's calendar names and its fiscal year.

    Rows are grouped by the month start alone. All other month names follow from any of its days, so
    they are looked up once per result row.
    """
    names = [*_MONTH, "fiscal_year"]
    months = fact.join(calendar.select(F.col("date_key").alias(day), "month_start_date"), day)
    grouped = months.groupBy("month_start_date", *more_keys).agg(*measures,
                                                                 F.min(day).alias("date_key"))
    result = grouped.join(calendar.select("date_key", *names), "date_key")
    return result.select(*names, *(c for c in grouped.columns
                                   if c not in ("month_start_date", "date_key")))


def inventory_monthly(inventory: DataFrame, calendar: DataFrame) -> DataFrame:
    """Average packs per snapshot and number of products per month."""
    on_hand, reserved = F.col("on_hand_packs"), F.col("reserved_packs")
    return _by_month(inventory, "date_key", calendar, [
        F.round(F.avg(on_hand), 0).alias("avg_on_hand"),
        F.round(F.avg(reserved), 0).alias("avg_reserved"),
        F.round(F.avg("in_transit_packs"), 0).alias("avg_in_transit"),
        F.round(F.avg(on_hand - reserved), 0).alias("avg_available"),
        F.count_distinct("product_id").alias("unique_products")])


def returns_monthly(returns: DataFrame, calendar: DataFrame) -> DataFrame:
    """Returns, credits and average credit per month and reason."""
    credits = money_add(money_parts("credit_amount"))
    return _by_month(returns, "date_key", calendar, [
        F.count(F.lit(1)).alias("return_count"),
        money_value(credits, None).alias("total_credits"),
        money_value(credits, count=F.count("credit_amount")).alias("avg_credit")], "reason_code")


def shipment_trends(shipments: DataFrame, calendar: DataFrame) -> DataFrame:
    """Shipments, orders and customers per month of the ship date."""
    return _by_month(shipments, "ship_date_key", calendar, [
        F.count(F.lit(1)).alias("shipment_count"),
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("customer_id").alias("unique_customers")])


def current_month_kpis(orders: DataFrame, lines: DataFrame, shipments: DataFrame,
                       returns: DataFrame, calendar: DataFrame,
                       as_of: dt.date | str) -> DataFrame:
    """Five rows (name, value, unit) for the month of ``as_of``.

    The month is applied to each fact twice: as a range on its stored date key, which reaches the
    scan, and through the calendar, which decides. A line has the date key of its order, so lines
    are cut by the same range before they are summed.
    """
    today = dt.date.fromisoformat(str(as_of))
    first = today.year * 10000 + today.month * 100
    days = (calendar.filter((F.col("year_num") == today.year) & (F.col("month_num") == today.month))
            .select(F.col("date_key").alias("_day")))

    def this_month(fact: DataFrame, day: str = "date_key") -> DataFrame:
        return (fact.filter(F.col(day).between(first + 1, first + 31))
                .join(days, F.col(day) == F.col("_day"), "left_semi"))

    def entry(name: str, value: Column, unit: str) -> Column:
        return F.struct(F.lit(f"{name} (Current Month)").alias("kpi_name"),
                        value.cast("double").alias("kpi_value"), F.lit(unit).alias("kpi_unit"))

    # The names and units of the five figures.
    current = this_month(orders.select("order_id", "date_key"))
    billed = order_totals(lines.filter(F.col("date_key").between(first + 1, first + 31)))
    sales = (current.join(billed.select("order_id", "amount", "line_count"), "order_id", "left")
             .agg(money_add("amount").alias("amount"), F.count("order_id").alias("orders"),
                  F.count("line_count").alias("billed")))
    sales = sales.select(F.inline(F.array(
        entry("Revenue", money_value("amount"), "USD"),
        entry("Orders", F.col("orders"), "Count"),
        entry("Avg Order Value", money_value("amount", count=F.col("billed")), "USD"))))
    shipped = this_month(shipments.select("ship_date_key"), "ship_date_key").agg(
        F.count(F.lit(1)).alias("n"))
    returned = this_month(returns.select("date_key")).agg(F.count(F.lit(1)).alias("n"))
    return (sales
            .unionByName(shipped.select(F.inline(F.array(entry("Shipments", F.col("n"), "Count")))))
            .unionByName(returned.select(F.inline(F.array(entry("Returns", F.col("n"), "Count"))))))
