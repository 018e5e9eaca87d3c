"""Batch queries: every operator over whole tables.

Unrounded money is rounded here, and only here, to the digits the SQL side rounds to: two engines
add doubles in different orders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions import date_key, money_add, money_parts, money_sum, money_value
from tradeloom.operators import quality
from tradeloom.operators.calendar_dim import calendar_spanning
from tradeloom.operators.dedup import dedup_first
from tradeloom.operators.scd2 import current_dimension, scd2_as_of, scd2_history
from tradeloom.plans import metric_queries
from tradeloom.plans.gold import present, revenue_by_category
from tradeloom.plans.marts import MARTS, mart
from tradeloom.plans.metrics import full_grain, metric_views
from tradeloom.schemas import FACT_RULES
from tradeloom.sources.star import Star

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 7, 15)
YEAR, YEARS = 2000, (2000, 2001)
BREACH_THRESHOLD = 10
ROWS_PER_BUCKET, ROWS_PER_TASK = 8, 100  # small, so that the test tables have keys above them


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def _star_query(build: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: build(Star(spark, folder))


# --- keys ------------------------------------------------------------------------------------

def _dedup_first(s: Star) -> DataFrame:
    return dedup_first(s.raw("lineitem"), ["l_orderkey", "l_linenumber"],
                       ["l_shipdate", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _patchy_orders(s: Star) -> DataFrame:
    """Orders whose id is missing or blank for some priorities, as a careless feed would send."""
    return s.raw("orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("string"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.col("o_orderkey").cast("string")).alias("order_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_totalprice").alias("amount"))


def _patchy_lines(s: Star) -> DataFrame:
    return s.raw("lineitem").select(
        F.when(F.col("l_returnflag") != "A", F.col("l_orderkey").cast("string")).alias("order_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(
            F.when(F.col("l_returnflag") != "N", F.col("l_linenumber").cast("string")))
        .alias("line_id"))


def _unusual_money(s: Star) -> DataFrame:
    """Totals and averages of amounts that no decimal of four digits holds, by line number: plain ones, very
    large ones, ones with many decimals, and plain ones among which some are NaN or infinite."""
    number, price = F.col("l_linenumber"), F.col("l_extendedprice")
    some = F.col("l_orderkey") % 100 == 0
    amount = (F.when(number == 2, 1e15).when(number == 3, 2.0 ** -17)
              .when((number == 4) & some, float("nan")).when((number == 5) & some, float("inf"))
              .otherwise(price))
    sums = s.raw("lineitem").select(number, amount.alias("amount")).groupBy("l_linenumber").agg(
        F.count("amount").alias("amounts"), money_sum("amount", None).alias("total"),
        money_value(money_add(money_parts("amount")), None, F.count("amount")).alias("mean"))
    finite = ~F.isnan("total") & (F.abs("total") != float("inf"))
    small = ~number.isin(2, 3)
    shown = [F.when(finite, F.when(small, F.round(c, 2)).otherwise(F.col(c))).alias(c) for c in ("total", "mean")]
    return sums.select("l_linenumber", "amounts", F.isnan("total").alias("is_nan"),
                       (F.col("total") == float("inf")).alias("is_infinite"), *shown)


def _date_key(s: Star) -> DataFrame:
    return s.raw("lineitem").groupBy(date_key("l_shipdate").alias("date_key")).agg(
        F.count(F.lit(1)).alias("line_count"))


# --- calendar --------------------------------------------------------------------------------

def _calendar(s: Star, fiscal_start: int) -> DataFrame:
    dates = s.raw("orders").select(F.col("o_orderdate").alias("d")).unionAll(
        s.raw("lineitem").select("l_shipdate"))
    return calendar_spanning(dates, "d", fiscal_start)


# --- quality ---------------------------------------------------------------------------------

def _expectation_report(s: Star) -> DataFrame:
    orders = quality.expectation_report(_patchy_orders(s), FACT_RULES["fct_sales_orders"])
    lines = quality.expectation_report(_patchy_lines(s), FACT_RULES["fct_sales_order_lines"])
    return (orders.withColumn("table_name", F.lit("fct_sales_orders"))
            .unionByName(lines.withColumn("table_name", F.lit("fct_sales_order_lines"))))


def _ri_report(s: Star) -> DataFrame:
    """All nine checks against dimensions that lack part of their members."""
    tables = {name: s[name] for name in ("fct_sales_orders", "fct_inventory_snapshots",
                                         "fct_shipments", "fct_returns")}
    tables["fct_sales_order_lines"] = s.order_lines_without_date
    customer = s.raw("customer").filter("c_acctbal >= 0")
    supplier = s.raw("supplier").filter("s_acctbal >= 0")
    part = s.raw("part").filter("p_size <> 7")
    tables["dim_customers_current"] = customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"))
    tables["dim_distribution_centers_current"] = supplier.select(
        F.col("s_suppkey").cast("string").alias("dc_id"))
    tables["dim_products_current"] = part.select(
        F.col("p_partkey").cast("string").alias("product_id"))
    return quality.referential_integrity(tables).orderBy(F.desc("unmatched_rows"), "check_name")


# --- history ---------------------------------------------------------------------------------

def _history(s: Star) -> DataFrame:
    return scd2_history(s.change_log, ["user_id"], "_ingested_at", ["event_type"])


def _history_by_count(s: Star) -> DataFrame:
    return scd2_history(s.change_log, ["user_id"], "_ingested_at", ["event_type"], rows_per_bucket=ROWS_PER_BUCKET)


def _shown_history(history: DataFrame) -> DataFrame:
    return history.withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})


def _as_of(s: Star, rows_per_bucket: int | None = None) -> DataFrame:
    events = s.raw("events").select("event_id", "user_id", "ts", F.col("event_type").alias("sent"))
    found = scd2_as_of(events, _history(s), ["user_id"], "ts", ["event_type", "__START_AT"], rows_per_bucket=rows_per_bucket)
    return found.select("event_id", "user_id", "sent", F.col("event_type").alias("found"),
                        F.col("__START_AT").alias("valid_from"))


# --- marts -----------------------------------------------------------------------------------

class DateFromOrders(dict):
    """The star for marts, which take the date from the order: lines need no date of their own."""

    def __init__(self, star: Star):
        super().__init__()
        self.star = star

    def __missing__(self, table: str) -> DataFrame:
        lines = table == "fct_sales_order_lines"
        return self.star["order_lines_without_date" if lines else table]


def _mart_query(name: str) -> Callable[[Star], DataFrame]:
    def build(star: Star) -> DataFrame:
        # the current month cuts lines by their own date key; the others take the date from the order
        tables = star if name == "current_month_kpis" else DateFromOrders(star)
        result = present(name, mart(name, tables, AS_OF))
        if name == "kpi_summary":
            return _rounded(result, total_revenue=2, avg_order_value=4)
        return result
    return build


# --- metrics ---------------------------------------------------------------------------------

_METRIC_DIGITS = {"Revenue": 2, "YTD Revenue": 2, "Return Amount": 2, "Average Line Amount": 8,
                  "Average Order Value": 6, "YTD Average Order Value": 6,
                  "Average Return Amount": 8, "Fulfillment Rate": 6}


def _metric_view(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        view = metric_views(Star(spark, folder), AS_OF)[name]
        digits = {m: d for m, d in _METRIC_DIGITS.items() if m in view.measures}
        return _rounded(full_grain(view), **digits)
    return run


def _metric_query(build: Callable[[dict], DataFrame], **digits: int) -> Query:
    return lambda spark, folder: _rounded(build(metric_views(Star(spark, folder), AS_OF)), **digits)


def batch_queries() -> dict[str, Query]:
    q = metric_queries
    star: dict[str, Callable[[Star], DataFrame]] = {
        "dedup_first": _dedup_first,
        "require_keys": lambda s: quality.require_keys(_patchy_orders(s), ["order_id"]),
        "date_key": _date_key,
        "unusual_money": _unusual_money,
        "calendar_dim": lambda s: _calendar(s, 1),
        "calendar_dim_fiscal_july": lambda s: _calendar(s, 7),
        # quality
        "expect_or_drop": lambda s: quality.expect_or_drop(
            _patchy_lines(s), FACT_RULES["fct_sales_order_lines"]),
        "expectation_report": _expectation_report,
        "ri_report": _ri_report,
        "inventory_breaches": lambda s: quality.inventory_breaches(
            s.fct_inventory_snapshots, BREACH_THRESHOLD).drop("snapshot_ts"),
        # history
        "scd2_history": lambda s: _shown_history(_history(s)),
        "dim_current": lambda s: current_dimension(_history(s)),
        "scd2_as_of": _as_of,
        "scd2_history_by_count": lambda s: _shown_history(_history_by_count(s)),
        "scd2_as_of_by_count": lambda s: _as_of(s, ROWS_PER_BUCKET),
        # marts beyond their defaults
        "revenue_by_category_skewed": lambda s: revenue_by_category(
            s.order_lines_without_date, s.dim_products_current, ROWS_PER_TASK),
    }
    queries = {name: _star_query(build) for name, build in star.items()}
    queries |= {name: _star_query(_mart_query(name)) for name in MARTS}
    for view in ("metric_daily_revenue", "metric_monthly_revenue", "metric_fiscal_ytd",
                 "metric_inventory", "metric_shipments", "metric_returns"):
        queries[view] = _metric_view(view)
    queries |= {
        "mq_daily_trend": _metric_query(lambda v: q.daily_trend(v, YEAR),
                                        daily_revenue=2, avg_line_amount=8),
        "mq_monthly_fiscal": _metric_query(lambda v: q.monthly_fiscal(v, YEARS),
                                           monthly_revenue=2, aov=6, fulfillment_pct=6),
        "mq_fiscal_ytd_quarter": _metric_query(lambda v: q.fiscal_ytd_quarter(v, YEARS),
                                               ytd_revenue=2, ytd_aov=6),
        "mq_inventory_month": _metric_query(lambda v: q.inventory_month(v, YEAR)),
        "mq_shipments_status": _metric_query(lambda v: q.shipments_status(v, "FQ1")),
        "mq_returns_reason": _metric_query(lambda v: q.returns_reason(v, YEAR),
                                           total_credits=2, avg_credit=8),
        "mq_revenue_vs_returns": _metric_query(lambda v: q.revenue_vs_returns(v, YEAR),
                                               revenue=2, return_credits=2),
        "mq_latest_ytd_kpi": _metric_query(q.latest_ytd_kpi, ytd_revenue=2, ytd_aov=6),
        "mq_daily_90d": _metric_query(lambda v: q.daily_recent(v, AS_OF), revenue=2),
        "mq_monthly_recent": _metric_query(lambda v: q.monthly_recent(v, AS_OF),
                                           revenue=2, avg_order_value=6, fulfillment_rate=6),
        "mq_returns_recent": _metric_query(lambda v: q.returns_recent(v, AS_OF), return_amount=2),
    }
    return queries
