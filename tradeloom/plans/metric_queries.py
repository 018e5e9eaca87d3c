"""The reports asked of the metric views; years and dates are parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.plans.metrics import MetricView

Views = Mapping[str, MetricView]


def _years(years: Sequence[int]) -> str:
    return "`Fiscal Year` IN ({})".format(", ".join(str(int(y)) for y in years))


def daily_trend(views: Views, year: int, days: int = 30) -> DataFrame:
    """The newest days of one year."""
    return views["metric_daily_revenue"].query(
        ["Calendar Date", "Month", "Day Name"],
        {"daily_revenue": "Revenue", "orders": "Order Count", "line_items": "Line Item Count",
         "avg_line_amount": "Average Line Amount"},
        period=F.col("Calendar Date").between(dt.date(year, 1, 1), dt.date(year, 12, 31)),
        order_by=["-Calendar Date"], limit=days)


def monthly_fiscal(views: Views, years: Sequence[int]) -> DataFrame:
    """Months of some fiscal years side by side."""
    return views["metric_monthly_revenue"].query(
        ["Month Label", "Fiscal Year Label", "Fiscal Quarter"],
        {"monthly_revenue": "Revenue", "order_count": "Order Count", "aov": "Average Order Value",
         "fulfillment_pct": "Fulfillment Rate"},
        period=_years(years), order_by=["-Fiscal Year Label", "Calendar Month"])


def fiscal_ytd_quarter(views: Views, years: Sequence[int]) -> DataFrame:
    """Year-to-date figures per fiscal quarter."""
    return views["metric_fiscal_ytd"].query(
        ["Fiscal Year Label", "Fiscal Quarter"],
        {"ytd_revenue": "YTD Revenue", "ytd_orders": "YTD Order Count",
         "ytd_aov": "YTD Average Order Value"},
        period=_years(years), order_by=["Fiscal Year", "-Fiscal Quarter"])


def inventory_month(views: Views, year: int) -> DataFrame:
    """Inventory per month of one fiscal year."""
    return views["metric_inventory"].query(
        ["Year Month"],
        {"total_on_hand": "Total On Hand", "total_reserved": "Total Reserved",
         "available": "Available for Sale", "product_count": "Product Count"},
        period=_years([year]), order_by=["-Year Month"])


def shipments_status(views: Views, quarter: str = "FQ1") -> DataFrame:
    """Shipments per month and status in one fiscal quarter of every year."""
    return views["metric_shipments"].query(
        ["Year Month", "Shipment Status"],
        {"shipment_count": "Shipment Count", "order_count": "Order Count",
         "customer_count": "Unique Customers"},
        period=F.col("Fiscal Quarter") == quarter, order_by=["Year Month", "Shipment Status"])


def returns_reason(views: Views, year: int) -> DataFrame:
    """Returns per month and reason, most frequent first."""
    return views["metric_returns"].query(
        ["Year Month", "Return Reason"],
        {"return_count": "Return Count", "total_credits": "Return Amount",
         "avg_credit": "Average Return Amount"},
        period=_years([year]), order_by=["-return_count", "-Year Month"])


def revenue_vs_returns(views: Views, year: int) -> DataFrame:
    """Revenue and returned credit per month of one fiscal year."""
    sales = views["metric_monthly_revenue"].query(
        {"period": "Month Label"}, {"revenue": "Revenue", "orders": "Order Count"},
        period=_years([year]))
    credits = views["metric_returns"].query(
        {"period": "Year Month"}, {"return_credits": "Return Amount", "returns": "Return Count"},
        period=_years([year]))
    share = F.try_divide(F.col("return_credits") * 100.0, F.col("revenue"))
    return (sales.join(credits, "period", "left")
            .select("period", "revenue", "orders", "returns", "return_credits",
                    F.round(share, 2).alias("return_pct_of_revenue"))
            .orderBy(F.desc("period")))


def latest_ytd_kpi(views: Views) -> DataFrame:
    """The newest fiscal month."""
    return views["metric_fiscal_ytd"].query(
        {"fiscal_year_label": "Fiscal Year Label", "fiscal_month": "Fiscal Month"},
        {"ytd_revenue": "YTD Revenue", "ytd_orders": "YTD Order Count",
         "ytd_aov": "YTD Average Order Value"},
        order_by=["-Fiscal Year Label", "-Fiscal Month"], limit=1)


def daily_recent(views: Views, as_of: dt.date, days: int = 90) -> DataFrame:
    """Revenue and orders per day from ``days`` before ``as_of``."""
    return views["metric_daily_revenue"].query(
        {"calendar_date": "Calendar Date"}, {"revenue": "Revenue", "order_count": "Order Count"},
        period=F.col("Calendar Date") >= as_of - dt.timedelta(days), order_by=["Calendar Date"])


def monthly_recent(views: Views, as_of: dt.date) -> DataFrame:
    """Months since the start of last year's fiscal year."""
    return views["metric_monthly_revenue"].query(
        {"month_label": "Month Label", "fiscal_quarter": "Fiscal Quarter"},
        {"revenue": "Revenue", "order_count": "Order Count",
         "avg_order_value": "Average Order Value", "fulfillment_rate": "Fulfillment Rate"},
        period=F.col("Fiscal Year") >= as_of.year - 1, order_by=["Month Label"])


def returns_recent(views: Views, as_of: dt.date) -> DataFrame:
    """Returns per month and reason since last year's fiscal year, most frequent first."""
    return views["metric_returns"].query(
        {"year_month": "Year Month", "return_reason": "Return Reason"},
        {"return_count": "Return Count", "return_amount": "Return Amount"},
        period=F.col("Fiscal Year") >= as_of.year - 1, order_by=["-return_count", "-Year Month"])
