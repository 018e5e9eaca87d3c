"""From landing files to silver tables and current dimensions, one run at a time.

Every hop is a stream of its own with its own checkpoint, run until its input is used up. Hops that
do not depend on each other run at the same time.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.flatten import (flatten_dimension, flatten_fact, flatten_order_lines,
                                         flatten_orders, flatten_orders_raw)
from tradeloom.operators.quality import expect_or_drop
from tradeloom.schemas import (ARRIVAL, BRONZE, DIMENSIONS, FACT_KEYS, FACT_RULES, FACTS, FLAT_FACTS,
                               ORDERS_RAW, Table)
from tradeloom.sources.admission import EVERYTHING, Admission
from tradeloom.sources.landing import backfill_stream, landing_stream
from tradeloom.streaming import sinks
from tradeloom.streaming.counts import DropCounts, drop_counts, malformed_dates
from tradeloom.streaming.dedup import dedup_stream
from tradeloom.streaming.key_index import append_unique
from tradeloom.streaming.scd2 import PARTS, read_current, read_history, scd2_apply


@dataclass(frozen=True)
class Store:
    """Folders of one warehouse under a root on shared storage."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


FLOWS = ("live", "historical")  # of the order staging table
RAW_RULES = {"order_id_not_null": "order_id IS NOT NULL"}
BACKFILL_REJECTS = Table({"key": "STRING", "_source_file": "STRING", "_document": "INT", "_ingested_at": "TIMESTAMP",
                          "_rescued_data": "STRING"})


def clean_fact(rows: DataFrame, table: str, bounded: bool = False) -> DataFrame:
    """Rows of a fact that pass its rules, first arrival per key.

    Rules come before de-duplication: both look only at the key, so the result is the same, and the
    NULL rows of documents without the entity do not meet in one reducer. The failures of each rule
    are in the query's progress under the table's name.
    """
    checked = expect_or_drop(rows, FACT_RULES[table], observation=table)
    return dedup_stream(checked, FACT_KEYS[table], bounded=bounded)


def _append_fact(rows: DataFrame, store: Store, table: str, bounded: bool):
    clean = clean_fact(rows, table, bounded)
    if bounded:
        return append_unique(clean, store.table(table), FACTS[table], FACT_KEYS[table],
                             store.table(f"{table}_keys"), store.checkpoint(table))
    return sinks.append_stream(clean, store.table(table), FACTS[table], store.checkpoint(table))


def _with(documents: DataFrame, entity: str) -> DataFrame:
    """Documents that have rows of the entity: the others' rows of NULLs would count as broken."""
    return documents.filter(F.size(f"value.{entity}") > 0)


def ingest_landing(spark: SparkSession, landing: str, store: Store, **options):
    """Start: landing documents to the bronze table."""
    return sinks.append_stream(landing_stream(spark, landing, **options), store.table("landing"),
                               BRONZE, store.checkpoint("landing"))


def _order_arrivals(documents: DataFrame, flow: str, bounded: bool) -> DataFrame:
    """First arrival of each order. Orders without an id are counted, then dropped; documents without orders leave no row."""
    name = f"sales_orders_raw_{flow}"
    documents = malformed_dates(_with(documents, "sales_orders"), name, "sales_orders", ["order_date"])
    return dedup_stream(expect_or_drop(flatten_orders_raw(documents), RAW_RULES, observation=name), ["order_id"], bounded=bounded)


def _bronze(spark: SparkSession, store: Store, admission: Admission) -> DataFrame:
    return sinks.stream_table(spark, store.table("landing"), BRONZE, admission)


def ingest_orders(spark: SparkSession, store: Store, admission: Admission = EVERYTHING, bounded: bool = False):
    """Start: sales orders of the bronze table to the order staging table."""
    arrivals = _order_arrivals(_bronze(spark, store, admission), "live", bounded)
    return sinks.append_flow(arrivals, store.table("sales_orders_raw"), ORDERS_RAW, "live",
                             store.checkpoint("sales_orders_raw_live"))


def ingest_order_backfill(spark: SparkSession, backfill: str, store: Store, bounded: bool = False, **options):
    """Start: backfill documents to the order staging table."""
    arrivals = _order_arrivals(backfill_stream(spark, backfill, **options), "historical", bounded)
    return sinks.append_flow(arrivals, store.table("sales_orders_raw"), ORDERS_RAW, "historical",
                             store.checkpoint("sales_orders_raw_historical"))


def ingest_backfill_rejects(spark: SparkSession, backfill: str, store: Store, **options):
    """Start: what the backfill's documents hold that the staging table has no place for, broken texts included."""
    rejects = backfill_stream(spark, backfill, **options).filter("_rescued_data IS NOT NULL")
    return sinks.append_stream(rejects, store.table("backfill_rejects"), BACKFILL_REJECTS, store.checkpoint("backfill_rejects"))


def load_order_fact(spark: SparkSession, store: Store, table: str, admission: Admission = EVERYTHING, bounded: bool = False):
    """Start: order staging table to orders or order lines."""
    raw = sinks.stream_flows(spark, store.table("sales_orders_raw"), ORDERS_RAW, FLOWS, admission)
    flat = flatten_orders(raw) if table == "fct_sales_orders" else flatten_order_lines(raw.filter(F.size("lines") > 0))
    return _append_fact(flat, store, table, bounded)


def load_fact(spark: SparkSession, store: Store, table: str, admission: Admission = EVERYTHING, bounded: bool = False):
    """Start: bronze table to inventory, shipments or returns."""
    spec = FLAT_FACTS[table]
    documents = _with(_bronze(spark, store, admission), spec.entity)
    documents = malformed_dates(documents, table, spec.entity, spec.timestamps)
    return _append_fact(flatten_fact(documents, table), store, table, bounded)


def load_dimension(spark: SparkSession, store: Store, entity: str, parts: int = PARTS, admission: Admission = EVERYTHING):
    """Start: bronze table to a type-2 history."""
    spec = DIMENSIONS[entity]
    tracked = [c for c in spec.columns if c != spec.key]
    return scd2_apply(flatten_dimension(_bronze(spark, store, admission), entity), [spec.key], "_ingested_at", tracked,
                      store.table(spec.history), store.checkpoint(spec.history), parts, ARRIVAL)


def run_pipeline(spark: SparkSession, landing: str, backfill: str | None, store: Store,
                 parts: int = PARTS, admission: Admission = EVERYTHING, bounded: bool = False,
                 multi_line: bool = True) -> dict[str, DataFrame]:
    """Process everything that arrived since the last run; returns the silver tables and ``drop_counts``.

    ``admission`` bounds the micro-batches of every hop when a large backlog waits. ``bounded`` keeps the keys of the last
    days only in the streams' state and all others in an index on storage; the facts are exact either way. A store
    keeps the choice it was begun with. ``multi_line=False`` reads landing and backfill line by line; see `landing_stream`.
    """
    with counting(spark, store) as run:
        run([ingest_landing(spark, landing, store, admission=admission, multi_line=multi_line)])
        orders = [ingest_orders(spark, store, admission, bounded)]
        if backfill:
            orders.append(ingest_order_backfill(spark, backfill, store, bounded, admission=admission, multi_line=multi_line))
        others = [load_fact(spark, store, t, admission, bounded) for t in FLAT_FACTS]
        others += [load_dimension(spark, store, e, parts, admission) for e in DIMENSIONS]
        if backfill:
            others.append(ingest_backfill_rejects(spark, backfill, store, admission=admission, multi_line=multi_line))
        run(orders)
        others += [load_order_fact(spark, store, t, admission, bounded)
                   for t in ("fct_sales_orders", "fct_sales_order_lines")]
        run(others)
    return silver_tables(spark, store) | {"drop_counts": drop_counts(spark, store.table("drop_counts"))}


@contextmanager
def counting(spark: SparkSession, store: Store):
    """Gives a function that waits for streams; what they dropped is added to the store's ``drop_counts`` at the end."""
    counts, ended = DropCounts(), []

    def run(queries: list) -> None:
        ended.extend(queries)
        sinks.finish(queries)

    spark.streams.addListener(counts)
    try:
        yield run
    finally:
        spark.streams.removeListener(counts)
        counts.store(spark, store.table("drop_counts"), ended)


def silver_tables(spark: SparkSession, store: Store) -> dict[str, DataFrame]:
    """Facts, histories and current dimensions of a store."""
    tables = {t: sinks.read_table(spark, store.table(t), columns) for t, columns in FACTS.items()}
    for spec in DIMENSIONS.values():
        root = store.table(spec.history)
        tables[spec.history] = read_history(spark, root, [spec.key])
        tables[spec.current] = read_current(spark, root).select(*spec.columns)
    return tables
