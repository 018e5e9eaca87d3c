"""Landing documents made from the test tables, to feed the streams, for reading with ``multi_line=False``.

Documents hold consecutive ids: at most 500 orders, customers and so on, whatever the table size, so
no document grows with the data, and a file holds one text per line, so the files are as many as the tasks
that write them. An order has at most seven lines (its distinct line numbers); an
inventory document holds one year of 500 products in 100 centers.

Texts repeat their names in every row, so the files are compressed; one file is one task's, and as many as the tasks.
A large entity's documents are written before the next one's are made, so their shuffles need not lie on disk together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.schemas import ADDRESS_FIELDS, DIMENSIONS, LANDING_ENTITIES
from tradeloom.session import SPREAD, setting
from tradeloom.sources.star import Star

PER_DOCUMENT = 500
WITHOUT_ENVELOPE = ("shipments",)  # sent flat, as some producers do


def _text(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(moment)


def _row(entity: str) -> Column:
    return F.struct(*LANDING_ENTITIES[entity]).alias("row")


def _chunk(id_column: str, per_document: int = PER_DOCUMENT) -> Column:
    return F.floor(F.col(id_column).cast("bigint") / per_document).cast("string").alias("chunk")


def _address() -> Column:
    return F.struct(*(F.col(f"address_{c}").alias(c) for c in ADDRESS_FIELDS)).alias("address")


class _Near(Star):
    """Lines and orders come with the chunk of the document they go to, and those of a chunk come together: nothing that is
    grouped or joined by chunk after that is shuffled again."""

    near = ("chunk",)

    def __init__(self, star: Star, **chunks: Column):
        super().__init__(star.spark, star.folder)
        self.chunks = chunks

    def raw(self, table: str) -> DataFrame:
        rows, name = super().raw(table), f"{table[0]}_chunk"
        return rows.withColumn(name, self.chunks[table]).repartition(name) if table in self.chunks else rows


def _by_order(star: Star) -> Star:
    return _Near(star, lineitem=_chunk("l_orderkey"), orders=_chunk("o_orderkey"))


def _orders(star: Star) -> DataFrame:
    return _by_order(star).orders_and_lines.withColumn("order_date", _text("order_date"))


def _rows(star: Star, entity: str) -> DataFrame:
    """Elements of one entity with the chunk each belongs to."""
    if entity == "sales_orders":
        return _orders(star).select("chunk", _row(entity))
    if entity == "customers":
        return star.dim_customers_current.withColumn("address", _address()).withColumn(
            "customer_name", F.concat(F.lit("  "), "customer_name", F.lit(" "))).select(
            _chunk("customer_id"), _row(entity))
    if entity == "products":
        return star.dim_products_current.select(_chunk("product_id"), _row(entity))
    if entity == "manufacturers":
        makers = star.dim_manufacturers_current.withColumn("created_at", _text("created_at"))
        return makers.select(F.lit("0").alias("chunk"), _row(entity))
    if entity == "distribution_centers":
        return star.dim_distribution_centers_current.withColumn("address", _address()).select(
            _chunk("dc_id"), _row(entity))
    if entity == "inventory_snapshots":
        # products, centers and a year: no product or center can make a document grow without end
        chunk = F.concat_ws("-", _chunk("l_partkey"), _chunk("l_suppkey", 100), F.year("l_shipdate").cast("string"))
        return _Near(star, lineitem=chunk).fct_inventory_snapshots.select(
            "chunk",
            F.struct(*(_text(c) if c == "snapshot_ts" else F.col(c)
                       for c in LANDING_ENTITIES[entity])).alias("row"))
    if entity == "shipments":
        return _by_order(star).fct_shipments.select(
            "chunk",
            F.struct(*(_text(c) if c in ("ship_date", "delivery_date") else F.col(c)
                       for c in LANDING_ENTITIES[entity])).alias("row"))
    return _by_order(star).fct_returns.select(
        "chunk",
        F.struct(*(_text(c) if c == "return_date" else F.col(c)
                   for c in LANDING_ENTITIES[entity])).alias("row"))


def _documents(rows: DataFrame, entity: str) -> DataFrame:
    """One JSON text per chunk. Customer documents carry fields the schema does not know."""
    if entity == "customers":
        rows = rows.withColumn("row", F.struct(
            "row.*", F.length("row.customer_type").alias("segment_length")))
    grouped = rows.groupBy("chunk").agg(F.sort_array(F.collect_list("row")).alias("elements"))
    key = F.concat(F.lit(f"{entity}-"), "chunk").alias("key")
    body = F.col("elements").alias(entity)
    if entity in WITHOUT_ENVELOPE:
        document = F.struct(body)
    elif entity == "customers":
        document = F.struct(key, F.struct(body, F.size("elements").alias("row_count"))
                            .alias("value"), F.lit("crm").alias("feed"))
    else:
        document = F.struct(key, F.struct(body).alias("value"))
    return grouped.select(F.to_json(document).alias("value"))


def write_landing(star: Star, folder: str) -> None:
    """All tables as landing documents."""
    parts = {e: _documents(_rows(star, e), e) for e in LANDING_ENTITIES}
    _write(reduce(DataFrame.unionAll, (parts.pop(e) for e in DIMENSIONS)), folder)
    for documents in parts.values():
        _write(documents, folder)


def write_backfill(star: Star, folder: str) -> None:
    """All orders as backfill documents."""
    _write(_documents(_rows(star, "sales_orders"), "sales_orders"), folder)


def write_spoiled_orders(star: Star, folder: str) -> None:
    """Order documents in which every fifth id is missing, every seventh of the others blank, every third date no date."""
    number = F.col("order_id").cast("bigint")
    rows = _orders(star).withColumns({
        "order_date": F.when(number % 3 == 0, "no date").otherwise(F.col("order_date")),
        "order_id": F.when(number % 5 == 0, None).when(number % 7 == 0, " ").otherwise(F.col("order_id"))})
    _write(_documents(rows.select("chunk", _row("sales_orders")), "sales_orders"), folder)


def write_backfill_shapes(star: Star, folder: str) -> None:
    """All orders as backfill texts of several documents: arrays, rows of them, and texts that break off, with a field nobody knows."""
    documents = _documents(_rows(star, "sales_orders"), "sales_orders")
    key = F.get_json_object("value", "$.key")
    other = F.to_json(F.struct(F.concat(key, F.lit("-other")).alias("key"), F.lit("by hand").alias("sent")))
    shape = F.substring_index(key, "-", -1).cast("bigint") % 3
    whole = F.when(shape == 0, F.concat(F.lit("["), "value", F.lit(","), other, F.lit("]"))).otherwise(
        F.concat("value", F.lit(","), other))
    broken = documents.filter(shape == 2).select(F.expr("substring(value, 1, length(value) - 9)").alias("value"))
    _write(documents.select(whole.alias("value")).unionAll(broken), folder)


def _write(documents: DataFrame, folder: str) -> None:
    with setting(documents.sparkSession, SPREAD, "false"):
        documents.write.mode("append").text(folder, compression="gzip")  # JSON has its line ends escaped
