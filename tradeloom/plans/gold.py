"""Gold marts.

Silver facts and current dimensions are unique on their keys. The marts rely on it: lines are summed
per order (or per product, customer, ...) before a join, which combines on the map side, keeps one
hot key from filling one task, and turns most distinct counts into plain counts. Totals that divide a
column are scalar subqueries, so no mart runs an action or a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import money_add, money_parts, money_sum, money_value, rate
from tradeloom.operators.skew import skew_join


def order_totals(lines: DataFrame) -> DataFrame:
    """One row per order: amount, number of lines, lines with an amount, packs."""
    return lines.groupBy("order_id").agg(
        money_add(money_parts("line_amount")).alias("amount"),
        F.count(F.lit(1)).alias("line_count"),
        F.count("line_amount").alias("priced_lines"),
        F.sum("ordered_qty_packs").alias("packs_ordered"),
        F.sum("confirmed_qty_packs").alias("packs_confirmed"))


def kpi_summary(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: revenue, orders, customers and the plain average of order totals."""
    revenue = lines.agg(money_sum("line_amount", None))
    buyers = customers.agg(F.count_distinct("customer_id"))
    overall = orders.agg(F.count_distinct("order_id").alias("total_orders"),
                         F.try_divide(money_sum("order_total_amount", None),
                                      F.count("order_total_amount")).alias("avg_order_value"))
    return overall.select(revenue.scalar().alias("total_revenue"), "total_orders",
                          buyers.scalar().alias("total_customers"), "avg_order_value")


def monthly_revenue(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue and orders per month of the order date."""
    month = F.date_trunc("month", "order_date").alias("order_month")
    return (order_totals(lines).join(orders.select("order_id", month), "order_id")
            .groupBy("order_month")
            .agg(money_value(money_add("amount")).alias("revenue"), F.count("order_id").alias("order_count")))


def revenue_by_category(lines: DataFrame, products: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Revenue and orders per therapeutic area; an order counts in every area it touches.

    ``rows_per_task`` spreads products with more lines than that over several tasks, at the cost of one more
    look at the lines' products; for products that are too many to be broadcast.
    """
    sold = lines.select("product_id", "order_id", money_parts("line_amount").alias("amount"))
    areas = products.select("product_id", "therapeutic_area")
    joined = (sold.join(areas, "product_id") if rows_per_task is None
              else skew_join(sold, areas, ["product_id"], ["order_id"], rows_per_task))
    return (joined.groupBy("therapeutic_area")
            .agg(money_value(money_add("amount")).alias("revenue"),
                 F.count_distinct("order_id").alias("order_count")))


def revenue_by_customer_type(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and orders per customer type and region, by the customer's current attributes."""
    per_customer = (order_totals(lines).join(orders.select("order_id", "customer_id"), "order_id")
                    .groupBy("customer_id")
                    .agg(money_add("amount").alias("amount"), F.count(F.lit(1)).alias("orders")))
    return (per_customer.join(customers.select("customer_id", "customer_type", "region"),
                              "customer_id")
            .groupBy("customer_type", "region")
            .agg(money_value(money_add("amount")).alias("revenue"), F.sum("orders").alias("order_count")))


def orders_by_status(orders: DataFrame) -> DataFrame:
    """Orders, revenue and share of all orders per status; the share is a fraction."""
    groups = orders.groupBy("order_status").agg(
        F.count("order_id").alias("order_count"), F.count(F.lit(1)).alias("_rows"),
        money_sum("order_total_amount").alias("revenue"))
    # the total runs over the few group rows, not over the orders again
    everything = F.sum("_rows").over(Window.partitionBy())
    return (groups.withColumn("pct_of_total", rate(F.col("order_count"), everything)).drop("_rows"))


def inventory_availability(inventory: DataFrame, centers: DataFrame,
                           products: DataFrame) -> DataFrame:
    """Packs per distribution center and product group, over all snapshots in history."""
    per_item = inventory.groupBy("dc_id", "product_id").agg(
        F.sum("on_hand_packs").alias("on_hand"), F.sum("reserved_packs").alias("reserved"),
        F.sum("in_transit_packs").alias("in_transit"),
        F.sum(F.col("on_hand_packs") - F.col("reserved_packs")).alias("available"))
    return (per_item
            .join(centers.select("dc_id", "dc_name", "region"), "dc_id", "left")
            .join(products.select("product_id", "therapeutic_area", "cold_chain_required"),
                  "product_id", "left")
            .groupBy("dc_name", "region", "therapeutic_area", "cold_chain_required")
            .agg(*(F.sum(c).alias(f"total_{c}")
                   for c in ("on_hand", "reserved", "in_transit", "available"))))


def returns_by_reason(returns: DataFrame, lines: DataFrame) -> DataFrame:
    """Returns per reason; the rate is returned packs over all packs ever ordered."""
    sold = lines.agg(F.sum("ordered_qty_packs"))
    return (returns.groupBy("reason_code")
            .agg(F.count("return_id").alias("return_count"),
                 F.sum("returned_qty_packs").alias("returned_packs"),
                 money_sum("credit_amount").alias("total_credit"))
            .withColumn("return_rate", rate(F.col("returned_packs"), sold.scalar())))


def product_revenue(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, units and orders of every product sold."""
    per_product = lines.groupBy("product_id").agg(
        money_sum("line_amount").alias("revenue"),
        F.sum("ordered_qty_packs").alias("units_sold"),
        F.count_distinct("order_id").alias("order_count"))
    attributes = ["product_name", "therapeutic_area", "dosage_form", "manufacturer_id"]
    return (per_product.join(products.select("product_id", *attributes), "product_id")
            .select("product_id", *attributes, "revenue", "units_sold", "order_count"))


# The order in which each mart is presented. Stored tables have none, so readers apply it.
PRESENTATION = {
    "monthly_revenue": ["order_month"],
    "revenue_by_category": ["-revenue"],
    "revenue_by_customer_type": ["-revenue"],
    "orders_by_status": ["-order_count"],
    "inventory_availability": ["dc_name", "therapeutic_area"],
    "returns_by_reason": ["-return_count"],
    "product_revenue": ["-revenue"],
}


def present(name: str, mart: DataFrame) -> DataFrame:
    """A mart sorted the way it is shown."""
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c)
             for c in PRESENTATION.get(name, [])]
    return mart.orderBy(*order) if order else mart
