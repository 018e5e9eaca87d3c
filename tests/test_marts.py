"""Marts and metric views on hand-made rows: missing dates, NULLs, zero totals, hot keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.calendar_dim import calendar_dim
from tradeloom.plans import dashboard, gold, metric_queries
from tradeloom.plans.metrics import Lookup, MetricView, metric_views
from tradeloom.schemas import DIMENSIONS, FACTS

D = dt.datetime


def table(spark, name, rows):
    """A silver fact from dicts; columns not given are NULL."""
    return spark.createDataFrame([tuple(r.get(c) for c in FACTS[name].names) for r in rows],
                                 FACTS[name].ddl)


def order(i, day, total, customer="c1", status="OPEN"):
    return {"order_id": i, "order_date": day, "date_key": int(day.strftime("%Y%m%d")),
            "customer_id": customer, "order_status": status, "order_total_amount": total}


def line(i, n, amount, qty=10, confirmed=10, product="p1", key=None):
    return {"order_id": i, "line_id": n, "line_amount": amount, "ordered_qty_packs": qty,
            "confirmed_qty_packs": confirmed, "product_id": product, "date_key": key}


@pytest.fixture(scope="module")
def sales(spark):
    days = {"o1": D(2020, 1, 5, 10), "o2": D(2020, 1, 31, 23, 59), "o3": D(2020, 2, 1),
            "o4": D(2031, 1, 1), "o5": D(2020, 2, 2)}
    orders = [order(i, d, 100.0, "c1" if i != "o3" else "c2", "OPEN" if i != "o5" else None)
              for i, d in days.items()]
    keys = {i: int(d.strftime("%Y%m%d")) for i, d in days.items()}
    lines = [line("o1", str(n), 0.1, key=keys["o1"]) for n in range(3)]
    lines += [line("o2", "1", 10.005, 4, 3, "p2", keys["o2"]), line("o3", "1", None, None, None, "p1", keys["o3"]),
              line("o4", "1", 7.0, key=keys["o4"]), line("gone", "1", 99.0, 0, 0, "p9", 20200105)]
    return (table(spark, "fct_sales_orders", orders), table(spark, "fct_sales_order_lines", lines))


@pytest.fixture(scope="module")
def year(spark):
    return calendar_dim(spark, "2020-01-01", "2020-12-31")


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_monthly_revenue(sales):
    assert rows(gold.monthly_revenue(*sales), "order_month", "revenue", "order_count") == [
        (D(2020, 1, 1), 10.31, 2), (D(2020, 2, 1), None, 1), (D(2031, 1, 1), 7.0, 1)]


def test_kpi_summary_keeps_lines_without_order(spark, sales):
    customers = spark.createDataFrame([("c1",), ("c2",)], "customer_id STRING")
    row = gold.kpi_summary(sales[0], sales[1], customers).first()
    assert row.total_revenue == pytest.approx(0.3 + 10.005 + 7 + 99)
    assert (row.total_orders, row.total_customers, row.avg_order_value) == (5, 2, 100.0)
    empty = gold.kpi_summary(sales[0].limit(0), sales[1].limit(0), customers.limit(0)).collect()
    assert [tuple(r) for r in empty] == [(None, 0, 0, None)]


def test_share_counts_orders_without_status(sales):
    assert rows(gold.orders_by_status(sales[0]), "order_status", "order_count", "pct_of_total") == [
        ("OPEN", 4, 0.8), (None, 1, 0.2)]


def test_return_rate_without_sales(spark, sales):
    returns = table(spark, "fct_returns", [{"return_id": "r", "reason_code": "LATE",
                                            "returned_qty_packs": 5, "credit_amount": 1.5}])
    assert gold.returns_by_reason(returns, sales[1]).first().return_rate == round(5 / 44, 4)
    unsold = sales[1].filter("product_id = 'p9'")  # all quantities zero
    assert gold.returns_by_reason(returns, unsold).first().return_rate is None
    assert gold.returns_by_reason(returns, sales[1].limit(0)).first().return_rate is None


def test_inventory_keeps_unknown_centers_and_products(spark):
    stock = table(spark, "fct_inventory_snapshots", [
        {"snapshot_id": str(i), "dc_id": d, "product_id": p, "on_hand_packs": 5, "reserved_packs": 2,
         "in_transit_packs": 1} for i, (d, p) in enumerate([("d1", "p1")] * 3 + [("dx", "px")])])
    centers = spark.createDataFrame([("d1", "One", "N")], "dc_id STRING, dc_name STRING, region STRING")
    products = spark.createDataFrame(
        [("p1", "ONCO", True)], "product_id STRING, therapeutic_area STRING, cold_chain_required BOOLEAN")
    assert rows(gold.inventory_availability(stock, centers, products), "dc_name",
                "therapeutic_area", "total_on_hand", "total_available") == [
        ("One", "ONCO", 15, 9), (None, None, 5, 3)]


def test_daily_revenue_drops_days_outside_the_calendar(sales, year):
    assert rows(dashboard.daily_revenue(*sales, year), "calendar_date", "total_revenue",
                "order_count", "line_item_count", "avg_line_amount") == [
        (dt.date(2020, 1, 31), 10.01, 1, 1, 10.01), (dt.date(2020, 1, 5), 0.3, 1, 3, 0.1),
        (dt.date(2020, 2, 1), None, 1, 1, None)]


def test_fulfilment_and_order_value(sales, year):
    assert rows(dashboard.monthly_revenue_fiscal(*sales, year), "month_label", "avg_order_value",
                "units_ordered", "units_confirmed", "fulfillment_rate") == [
        ("2020-01", 5.15, 34, 33, 0.9706), ("2020-02", None, None, None, None)]


def test_year_to_date_and_running(sales, year):
    plain = rows(dashboard.fiscal_ytd(*sales, year, "2020-01-15"), "fiscal_month_num",
                 "ytd_revenue", "ytd_order_count", "fiscal_quarter_label")
    assert plain == [(1, 0.3, 1, "FQ1")]
    running = rows(dashboard.fiscal_ytd_running(*sales, year, "2020-12-31"), "fiscal_month_num",
                   "ytd_revenue", "ytd_order_count", "ytd_avg_order_value")
    assert running == [(1, 10.31, 2, 5.15), (2, 10.31, 3, 3.44)]


def test_current_month(spark, sales, year):
    ship = table(spark, "fct_shipments", [{"shipment_id": "s", "ship_date_key": 20200131},
                                          {"shipment_id": "t", "ship_date_key": 20200201}])
    back = table(spark, "fct_returns", [])
    kpis = {r.kpi_name.split(" (")[0]: r.kpi_value for r in dashboard.current_month_kpis(
        *sales, ship, back, year, dt.date(2020, 1, 20)).collect()}
    assert kpis == {"Revenue": 10.31, "Orders": 2.0, "Avg Order Value": 5.15, "Shipments": 1.0,
                    "Returns": 0.0}
    none = {r.kpi_name.split(" (")[0]: r.kpi_value for r in dashboard.current_month_kpis(
        *sales, ship, back, year, "2020-07-01").collect()}
    assert none == {"Revenue": None, "Orders": 0.0, "Avg Order Value": None, "Shipments": 0.0,
                    "Returns": 0.0}
    assert rows(dashboard.current_month_kpis(*sales, ship, back, year, "2020-02-02"), "kpi_name",
                "kpi_value")[1] == ("Orders (Current Month)", 2.0)


def tables(spark, sales, year):
    return {"fct_sales_orders": sales[0], "fct_sales_order_lines": sales[1], "dim_time": year,
            **{t: table(spark, t, []) for t in ("fct_inventory_snapshots", "fct_shipments",
                                                "fct_returns")}}


def test_metric_views_keep_facts_outside_the_calendar(spark, sales, year):
    view = metric_views(tables(spark, sales, year), "2020-12-31")["metric_monthly_revenue"]
    got = rows(view.query(["Month Label"], {"n": "Order Count", "aov": "Average Order Value"}),
               "Month Label", "n")
    assert got == [("2020-01", 3), ("2020-02", 1), (None, 1)]
    within = rows(view.query(["Month Label"], {"n": "Order Count"}, period="`Fiscal Year` = 2020"),
                  "Month Label", "n")
    assert within == [("2020-01", 3), ("2020-02", 1)]
    assert view.query([], {"n": "Order Count"}).first().n == 5


def test_ratio_of_zero_is_null(spark, year):
    lines = table(spark, "fct_sales_order_lines", [line(None, "1", 5.0, 0, 0, key=20200101)])
    view = metric_views({**tables(spark, (lines, lines), year)}, "2020-12-31")["metric_monthly_revenue"]
    row = view.query(["Month Label"], {"aov": "Average Order Value", "f": "Fulfillment Rate"}).first()
    assert (row.aov, row.f) == (None, None)


def test_measures_are_computed_at_the_grain_of_the_query(spark):
    facts = spark.createDataFrame([("a", "x", "o1", 1.0), ("a", "y", "o1", 2.0), ("b", "x", "o2", 3.0)],
                                  "g STRING, h STRING, o STRING, v DOUBLE")
    view = MetricView(facts, {"G": "g", "H": "h"},
                      {"Orders": "COUNT(DISTINCT o)", "Value": "SUM(v)", "Mean": "SUM(v) / COUNT(DISTINCT o)"})
    assert rows(view.query(["G"], {"o": "Orders", "m": "Mean"}), "G", "o", "m") == [
        ("a", 1, 3.0), ("b", 1, 3.0)]
    assert view.query([], {"o": "Orders"}).first().o == 2


def test_sort_by_hidden_dimension_and_by_measure(spark):
    facts = spark.createDataFrame([("jan", 1, 5.0), ("feb", 2, 9.0), ("mar", 3, 7.0)],
                                  "label STRING, n INT, v DOUBLE")
    view = MetricView(facts, {"Label": "label", "Month": "n"}, {"Value": "SUM(v)"})
    by_month = view.query(["Label"], {"v": "Value"}, order_by=["-Month"])
    assert by_month.columns == ["Label", "v"]
    assert [r.Label for r in by_month.collect()] == ["mar", "feb", "jan"]
    by_value = view.query({"l": "Label"}, {"v": "Value"}, where="Month > 0", order_by=["-v"], limit=2)
    assert [tuple(r) for r in by_value.collect()] == [("feb", 9.0), ("mar", 7.0)]


def test_dimension_may_not_hide_another_column(spark):
    facts = spark.createDataFrame([("jan", 1, 5.0)], "label STRING, n INT, v DOUBLE")
    view = MetricView(facts, {"Label": "upper(label)"}, {"Value": "SUM(v)"})
    assert view.query(["Label"], {"v": "Value"}).first().Label == "JAN"
    with pytest.raises(ValueError, match="Label"):
        view.query(["Label"], {"v": "Value"}, where="Label = 'JAN'")


def test_unused_lookup_is_left_out(spark, year):
    facts = spark.createDataFrame([(20200101, 1.0)], "date_key INT, v DOUBLE")
    view = MetricView(facts, {"Day": "time_dim.calendar_date"}, {"Value": "SUM(v)"},
                      [Lookup("time_dim", year, "date_key", "date_key")])
    assert "Join" not in view.query([], {"v": "Value"})._jdf.queryExecution().optimizedPlan().toString()
    assert view.query(["Day"], {"v": "Value"}).first().Day == dt.date(2020, 1, 1)


def test_revenue_against_returns(spark, sales, year):
    back = table(spark, "fct_returns", [{"return_id": "r", "date_key": 20200110, "credit_amount": 5.0}])
    views = metric_views({**tables(spark, sales, year), "fct_returns": back}, "2020-12-31")
    got = rows(metric_queries.revenue_vs_returns(views, 2020), "period", "returns",
               "return_pct_of_revenue")
    assert got == [("2020-01", 1, round(500 / 109.305, 2)), ("2020-02", None, None)]


def test_hot_order_is_summed_before_the_join(spark, sales):
    lines = sales[1].unionAll(spark.range(5000).select(
        *(F.lit("o1").alias(c) if c == "order_id" else F.col("id").cast("string").alias(c)
          if c == "line_id" else F.lit(0.01).alias(c) if c == "line_amount"
          else F.lit(None).cast(t).alias(c) for c, t in FACTS["fct_sales_order_lines"].columns.items())))
    january = gold.monthly_revenue(sales[0], lines).filter("order_month = '2020-01-01'").first()
    assert (january.revenue, january.order_count) == (60.31, 2)
    plan = gold.monthly_revenue(sales[0], lines)._jdf.queryExecution().optimizedPlan().toString()
    join, aggregates = plan.index("Join Inner"), [i for i in range(len(plan))
                                                  if plan.startswith("Aggregate [order_id", i)]
    assert aggregates and min(aggregates) > join


def test_dimension_columns_are_declared():
    assert DIMENSIONS["customers"].current == "dim_customers_current"
    assert DIMENSIONS["products"].current == "dim_products_current"


def test_no_amount_is_cut_or_left_out(spark):
    from tradeloom.functions import money_add, money_parts, money_sum, money_value

    def totals(*amounts):
        df = spark.createDataFrame([(a,) for a in amounts], "a DOUBLE")
        twice = df.groupBy("a").agg(money_add(money_parts("a")).alias("s"))  # sums of sums
        row = df.agg(money_sum("a", None)).first()[0], twice.agg(money_value(money_add("s"), None)).first()[0]
        assert str(row[0]) == str(row[1])
        return row[0]

    assert totals(0.1, 0.2) == 0.3
    assert totals(1.0, float("nan")) != totals(1.0, float("nan"))
    assert totals(1.0, float("inf")) == float("inf")
    assert totals(1e15, 1.5) == 1e15 + 1.5
    assert abs(totals(0.00001, 0.00002, 1.0) - 1.00003) < 1e-12
    assert totals(None, 2.5) == 2.5 and totals(None) is None
