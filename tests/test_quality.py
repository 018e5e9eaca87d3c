"""Expectations, integrity checks, breaches, gates and batch de-duplication."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradeloom.operators import quality
from tradeloom.operators.dedup import dedup_first, dedup_latest
from tradeloom.schemas import FACT_RULES

RULES = FACT_RULES["fct_sales_orders"]


def test_expectations_drop_and_count(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), ("b",)], "order_id STRING")
    seen = Observation()
    kept = quality.expect_or_drop(df, RULES, seen)
    assert sorted(r.order_id for r in kept.collect()) == ["a", "b"]
    assert seen.get == {"rows": 4, "valid_order_id_not_null": 1, "valid_order_id_not_empty": 2}
    report = {r.expectation: (r.total_rows, r.failed_rows, r.passed_rows)
              for r in quality.expectation_report(df, RULES).collect()}
    assert report == {"valid_order_id_not_null": (4, 1, 3), "valid_order_id_not_empty": (4, 2, 2)}


def test_lines_accept_an_empty_line_id(spark):
    df = spark.createDataFrame([("o", ""), ("o", None), (None, "1")],
                               "order_id STRING, line_id STRING")
    kept = quality.expect_or_drop(df, FACT_RULES["fct_sales_order_lines"]).collect()
    assert [tuple(r) for r in kept] == [("o", "")]


def star(spark, orders):
    tables = {name: spark.createDataFrame([], "customer_id STRING, dc_id STRING, product_id STRING")
              for name in ("fct_sales_order_lines", "fct_inventory_snapshots", "fct_shipments",
                           "fct_returns")}
    tables["fct_sales_orders"] = spark.createDataFrame(orders, "customer_id STRING, dc_id STRING")
    tables["dim_customers_current"] = spark.createDataFrame([("c1",), ("c2",)], "customer_id STRING")
    tables["dim_products_current"] = spark.createDataFrame([("p1",)], "product_id STRING")
    tables["dim_distribution_centers_current"] = spark.createDataFrame([("d1",)], "dc_id STRING")
    return tables


def test_integrity_counts_null_keys_and_keeps_empty_facts(spark):
    orders = [("c1", "d1")] * 5 + [("c9", "d1"), (None, "d1")]
    report = quality.referential_integrity(star(spark, orders))
    rows = {r.check_name: r for r in report.collect()}
    assert len(rows) == 9
    broken = rows["fct_sales_orders -> dim_customers_current (customer_id)"]
    assert (broken.fact_rows, broken.unmatched_rows, broken.unmatched_pct) == (7, 2, 28.5714)
    fine = rows["fct_sales_orders -> dim_distribution_centers_current (dc_id)"]
    assert (fine.fact_rows, fine.unmatched_rows, fine.unmatched_pct) == (7, 0, 0.0)
    empty = rows["fct_returns -> dim_products_current (product_id)"]
    assert (empty.fact_rows, empty.unmatched_rows, empty.unmatched_pct) == (0, None, None)


def test_integrity_gate(spark):
    quality.assert_integrity(quality.referential_integrity(star(spark, [("c1", "d1")])))
    with pytest.raises(quality.IntegrityError, match="customer_id"):
        quality.assert_integrity(quality.referential_integrity(star(spark, [("c9", "d1")])))
    with pytest.raises(quality.IntegrityError, match="empty"):
        quality.assert_integrity(quality.referential_integrity(star(spark, [])).limit(0))


def test_breaches_and_gate(spark):
    stock = spark.createDataFrame([("s", 10, 10), ("t", 14, 10), ("u", 15, 10), ("v", 19, 10),
                                   ("w", 20, 10), ("x", 5, 10), ("y", None, 10)],
                                  "snapshot_id STRING, on_hand_packs INT, reserved_packs INT")
    found = quality.inventory_breaches(stock, 10)
    assert {r.snapshot_id: r.severity for r in found.collect()} == {
        "s": "CRITICAL", "x": "CRITICAL", "t": "HIGH", "u": "MEDIUM", "v": "MEDIUM"}
    quality.assert_max_rows(found, 6)
    with pytest.raises(quality.IntegrityError):
        quality.assert_max_rows(found, 5)


def test_first_and_latest_row_per_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(200)] + [("a", 3, "a3"), ("a", 1, "a1"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k STRING, at INT, v STRING").repartition(4)
    first = {r.k: r.v for r in dedup_first(df, ["k"], ["at"]).collect()}
    latest = {r.k: r.v for r in dedup_latest(df, ["k"], ["at"]).collect()}
    assert first == {"hot": "v0", "a": "a1", None: "n"}
    assert latest == {"hot": "v199", "a": "a3", None: "n"}


def test_dedup_reduces_each_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan[exchange:] and "row_number(), 1, Final" in plan[:exchange]
