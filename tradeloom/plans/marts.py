"""All marts by name, over a mapping of silver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tradeloom.plans import dashboard, gold

Tables = Mapping[str, DataFrame]
_O, _L, _I, _S, _R = ("fct_sales_orders", "fct_sales_order_lines", "fct_inventory_snapshots",
                      "fct_shipments", "fct_returns")
_CUSTOMERS, _PRODUCTS, _CENTERS, _TIME = ("dim_customers_current", "dim_products_current",
                                          "dim_distribution_centers_current", "dim_time")

# The tables each mart reads, in the order its function takes them.
_INPUTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "kpi_summary": (gold.kpi_summary, (_O, _L, _CUSTOMERS)),
    "monthly_revenue": (gold.monthly_revenue, (_O, _L)),
    "revenue_by_category": (gold.revenue_by_category, (_L, _PRODUCTS)),
    "revenue_by_customer_type": (gold.revenue_by_customer_type, (_O, _L, _CUSTOMERS)),
    "orders_by_status": (gold.orders_by_status, (_O,)),
    "inventory_availability": (gold.inventory_availability, (_I, _CENTERS, _PRODUCTS)),
    "returns_by_reason": (gold.returns_by_reason, (_R, _L)),
    "product_revenue": (gold.product_revenue, (_L, _PRODUCTS)),
    "daily_revenue": (dashboard.daily_revenue, (_O, _L, _TIME)),
    "monthly_revenue_fiscal": (dashboard.monthly_revenue_fiscal, (_O, _L, _TIME)),
    "fiscal_ytd": (dashboard.fiscal_ytd, (_O, _L, _TIME)),
    "fiscal_ytd_running": (dashboard.fiscal_ytd_running, (_O, _L, _TIME)),
    "inventory_monthly": (dashboard.inventory_monthly, (_I, _TIME)),
    "returns_monthly": (dashboard.returns_monthly, (_R, _TIME)),
    "shipment_trends": (dashboard.shipment_trends, (_S, _TIME)),
    "current_month_kpis": (dashboard.current_month_kpis, (_O, _L, _S, _R, _TIME)),
}
_DATED = {"fiscal_ytd", "fiscal_ytd_running", "current_month_kpis"}

MARTS = tuple(_INPUTS)


def mart(name: str, tables: Tables, as_of: dt.date | str) -> DataFrame:
    """One mart. ``as_of`` stands for today in the marts that depend on it."""
    function, inputs = _INPUTS[name]
    dates = (as_of,) if name in _DATED else ()
    return function(*(tables[t] for t in inputs), *dates)


def publish_marts(tables: Tables, as_of: dt.date | str, path: Callable[[str], str]) -> None:
    """Recompute and replace every stored mart."""
    from tradeloom.streaming.sinks import publish
    for name in MARTS:
        publish(mart(name, tables, as_of), path(name))
