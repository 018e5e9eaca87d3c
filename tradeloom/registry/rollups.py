"""Reports answered from stored rollups, which are built when first asked, once per session and folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.plans import metric_queries as q
from tradeloom.plans.metrics import metric_views
from tradeloom.plans.rollups import build_rollups
from tradeloom.registry.batch import AS_OF, YEAR, YEARS
from tradeloom.session import work_dir
from tradeloom.sources.star import Star

Query = Callable[[SparkSession, str], DataFrame]

class _Rollups(dict):
    """View name to its stored rollups; only views that a report asks for are built."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.views = spark, metric_views(Star(spark, folder), AS_OF)

    def __missing__(self, name: str):
        self[name] = build_rollups(self.spark, {name: self.views[name]}, work_dir(self.spark, "rollups"))[name]
        return self[name]


_BUILT: dict[tuple[str, str], _Rollups] = {}


def _rollups(spark: SparkSession, folder: str) -> _Rollups:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUILT:
        _BUILT[key] = _Rollups(spark, folder)
    return _BUILT[key]


def _report(build: Callable[[dict], DataFrame], **digits: int) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(_rollups(spark, folder)).withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})
    return run


def _shipment_trends(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments, orders and customers per month: distinct counts of a month from those of its days."""
    months = Star(spark, folder).dim_time.select("year_num", "month_num", "month_label", "month_name", "fiscal_year").distinct()
    counts = _rollups(spark, folder)["metric_shipments"].query(
        {"month_label": "Year Month"}, {"shipment_count": "Shipment Count", "order_count": "Order Count",
                                        "unique_customers": "Unique Customers"}, period="`Year Month` IS NOT NULL")
    return months.join(counts, "month_label")


def _shipment_quarters(spark: SparkSession, folder: str) -> DataFrame:
    return _rollups(spark, folder)["metric_shipments"].query(
        {"quarter": "Fiscal Quarter"}, {"shipments": "Shipment Count", "orders": "Order Count", "customers": "Unique Customers"})


def rollup_queries() -> dict[str, Query]:
    return {
        "rollup_daily_trend": _report(lambda v: q.daily_trend(v, YEAR), daily_revenue=2, avg_line_amount=8),
        "rollup_monthly_fiscal": _report(lambda v: q.monthly_fiscal(v, YEARS), monthly_revenue=2, aov=6, fulfillment_pct=6),
        "rollup_inventory_month": _report(lambda v: q.inventory_month(v, YEAR)),
        "rollup_shipments_status": _report(lambda v: q.shipments_status(v, "FQ1")),
        "rollup_returns_reason": _report(lambda v: q.returns_reason(v, YEAR), total_credits=2, avg_credit=8),
        "rollup_revenue_vs_returns": _report(lambda v: q.revenue_vs_returns(v, YEAR), revenue=2, return_credits=2),
        "rollup_shipment_trends": _shipment_trends,
        "rollup_shipment_quarters": _shipment_quarters,
    }
