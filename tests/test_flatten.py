"""Documents to rows: trimming, nesting, missing keys, bad dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.flatten import (explode_entity, flatten_dimension, flatten_fact,
                                         flatten_order_lines, flatten_orders, flatten_orders_raw)
from tradeloom.schemas import BRONZE, DIMENSIONS, FACTS

NOW = dt.datetime(2026, 4, 7, 11, 39, 29)


def documents(spark, *payloads, key="feed"):
    """Bronze rows holding the given payloads (entity name to list of dicts)."""
    rows = [(key, p, NOW, NOW.date(), "file:/landing/a.json", NOW, n, None) for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, BRONZE.ddl)


CUSTOMER = {"customer_id": "  K7  ", "customer_name": "  Harbour Clinic  ",
            "customer_type": "CLINIC", "region": "COAST", "credit_limit": 802.5,
            "is_340b_eligible": True,
            "address": {"street": "9 Quay", "city": "Lowell", "state": "NH",
                        "postal_code": "00417", "country": "US"}}


def test_customer_is_trimmed_and_flat(spark):
    rows = flatten_dimension(documents(spark, {"customers": [CUSTOMER]}), "customers").collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.customer_id, row.customer_name) == ("K7", "Harbour Clinic")
    assert (row.address_street, row.address_city, row.address_country) == ("9 Quay", "Lowell", "US")
    assert row.credit_limit == 802.5
    assert (row.bronze_record_key, row._ingested_at) == ("feed", NOW)


def test_each_element_is_a_row(spark):
    two = [CUSTOMER, {**CUSTOMER, "customer_id": "K8"}]
    rows = flatten_dimension(documents(spark, {"customers": two}), "customers").collect()
    assert sorted(r.customer_id for r in rows) == ["K7", "K8"]


@pytest.mark.parametrize("bad", [None, "", "   "])
def test_rows_without_a_key_are_dropped(spark, bad):
    one = {**CUSTOMER, "customer_id": bad}
    assert flatten_dimension(documents(spark, {"customers": [one]}), "customers").count() == 0


def test_products_need_a_manufacturer(spark):
    products = [{"product_id": " P1 ", "manufacturer_id": " M1 ", "product_name": " Pill "},
                {"product_id": "P2", "manufacturer_id": " "}, {"product_id": "P3"}]
    rows = flatten_dimension(documents(spark, {"products": products}), "products").collect()
    assert [(r.product_id, r.manufacturer_id, r.product_name) for r in rows] == [("P1", "M1", "Pill")]


def test_manufacturer_dates_and_center_zones(spark):
    made = flatten_dimension(documents(spark, {"manufacturers": [
        {"manufacturer_id": "M1", "created_at": "2024-01-02T03:04:05Z"},
        {"manufacturer_id": "M2", "created_at": "not a date"}]}), "manufacturers")
    assert {r.manufacturer_id: r.created_at for r in made.collect()} == {
        "M1": dt.datetime(2024, 1, 2, 3, 4, 5), "M2": None}
    centers = flatten_dimension(documents(spark, {"distribution_centers": [
        {"dc_id": " DC-1 ", "temperature_zones": ["AMBIENT", "COLD"]}]}), "distribution_centers")
    assert centers.first().temperature_zones == ["AMBIENT", "COLD"]
    assert centers.columns[:len(DIMENSIONS["distribution_centers"].columns)] == list(
        DIMENSIONS["distribution_centers"].columns)


@pytest.mark.parametrize("payload", [{"returns": []}, {"returns": None}, None])
def test_document_without_the_entity_gives_one_row_of_nulls(spark, payload):
    rows = explode_entity(documents(spark, payload), "returns").collect()
    assert len(rows) == 1 and rows[0].return_id is None and rows[0].bronze_record_key == "feed"


def test_orders_and_lines(spark):
    order = {"order_id": " SO-1 ", "order_date": "2026-04-07T23:59:59.094284Z", "dc_id": " DC ",
             "order_total_amount": 144449.04, "lines": [
                 {"line_id": " 1 ", "product_id": " P ", "line_amount": 144449.04},
                 {"line_id": None, "line_amount": 1.0}]}
    empty = {"order_id": "SO-2", "order_date": "2026-04-07 10:00:00", "lines": []}
    raw = flatten_orders_raw(documents(spark, {"sales_orders": [order, empty]}))
    orders = {r.order_id: r for r in flatten_orders(raw).collect()}
    assert orders["SO-1"].date_key == 20260407 and orders["SO-1"].order_total_amount == 144449.04
    assert orders["SO-1"].dc_id == " DC "  # foreign keys stay as sent
    assert orders["SO-2"].order_date == dt.datetime(2026, 4, 7, 10)
    assert flatten_orders(raw).columns == FACTS["fct_sales_orders"].names
    lines = flatten_order_lines(raw).collect()
    assert sorted((r.order_id, r.line_id or "", r.date_key) for r in lines) == [
        ("SO-1", "", 20260407), ("SO-1", "1", 20260407), ("SO-2", "", 20260407)]


@pytest.mark.parametrize("table, entity, row, day", [
    ("fct_inventory_snapshots", "inventory_snapshots",
     {"snapshot_id": " K ", "snapshot_ts": "2026-01-31T00:00:00Z"}, "date_key"),
    ("fct_shipments", "shipments", {"shipment_id": " K ", "ship_date": "2026-01-31",
                                    "delivery_date": ""}, "ship_date_key"),
    ("fct_returns", "returns", {"return_id": " K ", "return_date": "2026-01-31 01:02:03"},
     "date_key")])
def test_facts(spark, table, entity, row, day):
    fact = flatten_fact(documents(spark, {entity: [row]}), table)
    assert fact.columns == FACTS[table].names
    assert dict(fact.dtypes) == dict(spark.createDataFrame([], FACTS[table].ddl).dtypes)
    got = fact.first()
    assert got[0] == "K" and got[day] == 20260131


def test_a_malformed_date_does_not_fail_the_job(spark):
    fact = flatten_fact(documents(spark, {"returns": [
        {"return_id": "R", "return_date": "31/31/2026"}]}), "fct_returns").first()
    assert fact.return_date is None and fact.date_key is None


def test_nothing_but_built_in_functions(spark):
    plan = flatten_orders(flatten_orders_raw(documents(spark, {"sales_orders": []})))
    text = plan.select(F.col("order_id"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text
