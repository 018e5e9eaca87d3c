"""Landing documents to typed rows, one function per shape; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import date_key, parse_timestamp
from tradeloom.operators.quality import require_keys
from tradeloom.schemas import (ADDRESS_FIELDS, ARRIVAL, DIMENSIONS, FACTS, FLAT_FACTS, LINEAGE, ORDERS_RAW,
                               Dimension)


def explode_entity(documents: DataFrame, entity: str) -> DataFrame:
    """One row per element of ``value.<entity>`` with the four lineage columns.

    A document whose array is empty or missing gives one row of NULLs; the key rules remove it.
    """
    return documents.select(F.col("key").alias("bronze_record_key"), *LINEAGE[1:],
                            F.inline_outer(f"value.{entity}"))


def _dimension_column(name: str, spec: Dimension) -> Column:
    if name.startswith("address_") and name.removeprefix("address_") in ADDRESS_FIELDS:
        return F.col("address." + name.removeprefix("address_")).alias(name)
    column = F.trim(name) if name in spec.trimmed else F.col(name)
    return (parse_timestamp(column) if name in spec.timestamps else column).alias(name)


def flatten_dimension(documents: DataFrame, entity: str) -> DataFrame:
    """Source rows of a type-2 dimension: trimmed, flat, with a key, still carrying lineage and, where the
    documents have it, the order of arrival."""
    spec = DIMENSIONS[entity]
    known = [c for c in ARRIVAL if c in documents.columns and c not in LINEAGE]
    rows = documents.select(F.col("key").alias("bronze_record_key"), *LINEAGE[1:], *known,
                            F.posexplode(f"value.{entity}").alias("_position", "_row"))
    rows = rows.select(*LINEAGE, *known, "_position", "_row.*")
    order = [*known, "_position"] if known else []
    flat = rows.select(*(_dimension_column(c, spec) for c in spec.columns), *LINEAGE, *order)
    return require_keys(flat, spec.required)


def flatten_orders_raw(documents: DataFrame) -> DataFrame:
    """Sales orders with their lines still nested (the staging shape fed by live and backfill)."""
    rows = explode_entity(documents, "sales_orders")
    return (rows.withColumns({"order_id": F.trim("order_id"),
                              "order_date": parse_timestamp("order_date")})
            .select(*ORDERS_RAW.names))


def flatten_orders(orders_raw: DataFrame) -> DataFrame:
    """``fct_sales_orders`` rows, not yet de-duplicated."""
    return (orders_raw.withColumns({"order_id": F.trim("order_id"),
                                    "date_key": date_key("order_date")})
            .select(*FACTS["fct_sales_orders"].names))


def flatten_order_lines(orders_raw: DataFrame) -> DataFrame:
    """``fct_sales_order_lines`` rows: one per element of the order's lines."""
    rows = orders_raw.select(*LINEAGE, F.trim("order_id").alias("order_id"),
                             date_key("order_date").alias("date_key"), F.inline_outer("lines"))
    return rows.withColumn("line_id", F.trim("line_id")).select(*FACTS["fct_sales_order_lines"].names)


def flatten_fact(documents: DataFrame, table: str) -> DataFrame:
    """Inventory, shipment or return rows: own key trimmed, dates parsed, date key derived."""
    spec = FLAT_FACTS[table]
    rows = explode_entity(documents, spec.entity)
    rows = rows.withColumns({c: parse_timestamp(c) for c in spec.timestamps}
                            | {spec.key: F.trim(spec.key)})
    rows = rows.withColumns({name: date_key(source) for name, source in spec.date_keys.items()})
    return rows.select(*FACTS[table].names)
