"""The test tables in the shape of the silver model.

Every table is a lazy DataFrame over the raw parquet files, read with a declared schema so that
planning needs no pass over file footers. Lines repeat their key in the raw data and are reduced to
the first row of each (order, line).
"""

from __future__ import annotations

from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions import date_key
from tradeloom.operators.calendar_dim import calendar_dim
from tradeloom.operators.dedup import dedup_first
from tradeloom.session import STORED

# Columns of the raw tables.
RAW = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
}

CALENDAR_START, CALENDAR_END = "1995-01-01", "2002-12-31"


def _id(column: str) -> Column:
    return F.col(column).cast("string")


class Star:
    """Silver tables over one folder of raw tables; look them up by name."""

    near: tuple[str, ...] = ()  # what lines and orders are grouped and joined by besides their keys, and carry along

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, table)

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(RAW[table]).parquet(f"{self.folder}/{table}.parquet")

    def stage_lines(self, path: str) -> None:
        """Write the de-duplicated lines once and read them from there: four facts start from them."""
        self.line_source.write.mode("overwrite").parquet(path, compression=STORED)
        self.line_source = self.spark.read.schema(RAW["lineitem"]).parquet(path)

    def _near(self, prefix: str) -> list[str]:
        return [f"{prefix}_{c}" for c in self.near]

    def _carried(self, prefix: str) -> list[Column]:
        return [F.col(f"{prefix}_{c}").alias(c) for c in self.near]

    def _same_order(self) -> Column:
        same = zip([*self._near("l"), "l_orderkey"], [*self._near("o"), "o_orderkey"], strict=True)
        return reduce(and_, (F.col(line) == F.col(order) for line, order in same))

    @cached_property
    def dim_time(self) -> DataFrame:
        return calendar_dim(self.spark, CALENDAR_START, CALENDAR_END)

    @cached_property
    def line_source(self) -> DataFrame:
        """Raw lines, one per (order, line number)."""
        return dedup_first(self.raw("lineitem"), [*self._near("l"), "l_orderkey", "l_linenumber"],
                           ["l_shipdate", "l_partkey", "l_suppkey"])

    @cached_property
    def _lines_of_orders(self) -> DataFrame:
        return self.line_source.join(self.raw("orders"), self._same_order())

    @cached_property
    def fct_sales_orders(self) -> DataFrame:
        return self._orders_with()

    @cached_property
    def orders_and_lines(self) -> DataFrame:
        """The orders with their lines, without order and date, as an array."""
        order_id, line_id, date, *others = self._line_columns(F.lit(None).cast("int"))
        return self._orders_with(F.sort_array(F.collect_list(F.struct(line_id, *others))).alias("lines"))

    def _orders_with(self, *of_lines: Column) -> DataFrame:
        """The orders with more aggregates of their lines; NULL where an order has none."""
        lines = self.line_source.groupBy(*self._near("l"), "l_orderkey").agg(F.min("l_suppkey").alias("l_suppkey"), *of_lines)
        rows = self.raw("orders").join(lines, self._same_order(), "left")
        return rows.select(
            *self._carried("o"), _id("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"),
            date_key("o_orderdate").alias("date_key"), _id("l_suppkey").alias("dc_id"),
            _id("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderpriority").alias("payment_terms"), F.lit("FOB").alias("incoterm"),
            F.lit("USD").alias("currency"), F.col("o_totalprice").alias("order_total_amount"),
            *lines.columns[len(self.near) + 2:])

    def _line_columns(self, day: Column) -> list[Column]:
        confirmed = F.floor(F.col("l_quantity") * (1 - F.col("l_discount"))).cast("int")
        ordered = F.col("l_quantity").cast("int")
        return [_id("l_orderkey").alias("order_id"), _id("l_linenumber").alias("line_id"),
                day.alias("date_key"), _id("l_partkey").alias("product_id"),
                ordered.alias("ordered_qty_packs"), confirmed.alias("confirmed_qty_packs"),
                F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
                F.col("l_extendedprice").alias("line_amount"),
                (confirmed < ordered).alias("backorder_flag")]

    @cached_property
    def fct_sales_order_lines(self) -> DataFrame:
        return self._lines_of_orders.select(*self._line_columns(date_key("o_orderdate")))

    @cached_property
    def order_lines_without_date(self) -> DataFrame:
        """The lines for uses that take the date from the order: saves the join that finds it."""
        return self.line_source.select(*self._line_columns(F.lit(None).cast("int")))

    @cached_property
    def fct_shipments(self) -> DataFrame:
        return self._lines_of_orders.select(
            *self._carried("l"), F.concat_ws("-", F.concat(F.lit("S"), _id("l_orderkey")), _id("l_linenumber"))
            .alias("shipment_id"),
            _id("l_orderkey").alias("order_id"), _id("l_suppkey").alias("dc_id"),
            _id("o_custkey").alias("customer_id"), F.col("l_shipdate").alias("ship_date"),
            date_key("l_shipdate").alias("ship_date_key"),
            (F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber"))).alias("delivery_date"),
            F.col("l_linestatus").alias("shipment_status"),
            F.col("l_returnflag").alias("carrier_name"),
            F.lit(None).cast("string").alias("tracking_number"))

    @cached_property
    def fct_returns(self) -> DataFrame:
        return self._lines_of_orders.filter("l_returnflag = 'R'").select(
            *self._carried("l"), F.concat_ws("-", F.concat(F.lit("R"), _id("l_orderkey")), _id("l_linenumber"))
            .alias("return_id"),
            _id("l_orderkey").alias("original_order_id"), _id("o_custkey").alias("customer_id"),
            _id("l_partkey").alias("product_id"), F.col("l_shipdate").alias("return_date"),
            date_key("l_shipdate").alias("date_key"),
            F.col("o_orderpriority").alias("reason_code"),
            F.col("l_quantity").cast("int").alias("returned_qty_packs"),
            F.col("l_extendedprice").alias("credit_amount"))

    @cached_property
    def fct_inventory_snapshots(self) -> DataFrame:
        taken = self.raw("lineitem").groupBy(*self._near("l"), "l_suppkey", "l_partkey", "l_shipdate").agg(
            F.sum("l_quantity").cast("int").alias("on_hand_packs"),
            F.sum(F.floor(F.col("l_quantity") * F.col("l_discount") * 10)).cast("int")
            .alias("reserved_packs"),
            F.sum("l_linenumber").cast("int").alias("in_transit_packs"))
        day = date_key("l_shipdate")
        return taken.select(
            *self._carried("l"), F.concat_ws("-", _id("l_suppkey"), _id("l_partkey"), day).alias("snapshot_id"),
            F.col("l_shipdate").alias("snapshot_ts"), day.alias("date_key"),
            _id("l_suppkey").alias("dc_id"), _id("l_partkey").alias("product_id"),
            "on_hand_packs", "reserved_packs", "in_transit_packs")

    def _regions(self, nation_key: str) -> DataFrame:
        nations = self.raw("nation").join(self.raw("region"),
                                          F.col("n_regionkey") == F.col("r_regionkey"))
        return nations.select(F.col("n_nationkey").alias(nation_key), "n_name",
                              F.col("r_name").alias("region"))

    @staticmethod
    def _no_address() -> list[Column]:
        return [F.lit(None).cast("string").alias(f"address_{c}")
                for c in ("street", "city", "state", "postal_code")]

    @cached_property
    def dim_customers_current(self) -> DataFrame:
        return self.raw("customer").join(self._regions("c_nationkey"), "c_nationkey").select(
            _id("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_type"), "region",
            F.col("c_acctbal").alias("credit_limit"),
            (F.col("c_acctbal") > 5000).alias("is_340b_eligible"), *self._no_address(),
            F.col("n_name").alias("address_country"))

    @cached_property
    def dim_products_current(self) -> DataFrame:
        return self.raw("part").select(
            _id("p_partkey").alias("product_id"), F.col("p_brand").alias("manufacturer_id"),
            F.col("p_name").alias("product_name"), F.lit(None).cast("string").alias("molecule"),
            F.col("p_type").alias("therapeutic_area"),
            F.element_at(F.split("p_name", " "), -1).alias("dosage_form"),
            F.lit(None).cast("string").alias("strength"), F.col("p_size").alias("pack_size"),
            (F.col("p_size") > 25).alias("cold_chain_required"),
            F.col("p_retailprice").alias("list_price"))

    @cached_property
    def dim_manufacturers_current(self) -> DataFrame:
        return self.raw("part").select(F.col("p_brand").alias("manufacturer_id")).distinct().select(
            "manufacturer_id", F.concat(F.lit("Maker of "), "manufacturer_id")
            .alias("manufacturer_name"), F.lit("US").alias("country"),
            F.lit(True).alias("gmp_certified"),
            F.to_timestamp(F.lit("1995-01-01 00:00:00")).alias("created_at"))

    @cached_property
    def dim_distribution_centers_current(self) -> DataFrame:
        return self.raw("supplier").join(self._regions("s_nationkey"), "s_nationkey").select(
            _id("s_suppkey").alias("dc_id"), F.col("s_name").alias("dc_name"), "region",
            *self._no_address(), F.col("n_name").alias("address_country"),
            F.array(F.lit("ambient")).alias("temperature_zones"))

    @cached_property
    def change_log(self) -> DataFrame:
        """Events as a change log: user, moment, tracked event type."""
        return self.raw("events").select("user_id", F.col("ts").alias("_ingested_at"), "event_type")


SILVER = ("fct_sales_orders", "fct_sales_order_lines", "fct_inventory_snapshots", "fct_shipments",
          "fct_returns", "dim_customers_current", "dim_products_current",
          "dim_manufacturers_current", "dim_distribution_centers_current", "dim_time")
