"""Stored rollups of metric views, with distinct counts that add up, and the choice of one for each query.

A rollup holds, per combination of some dimensions, what the measures are made of: sums and counts, which add up to any
coarser grain, and for every distinct count the set of keys. Keys get dense numbers, given once and kept. The finest rollup
holds sets as numbers, a row each: its many sets of few keys would be mostly empty bitmaps. The coarser ones
hold bitmaps, which are exact; the union over months is a bitwise or, and a distinct count is the number of bits. No query
expands rows or looks at the keys themselves again.

Coarser rollups are made from the finest one. A query is answered from the smallest stored rollup that has all dimensions
it names, in its conditions too, and from the fact if none has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.plans.metrics import Asked, MetricView
from tradeloom.session import remove_folder


@dataclass(frozen=True)
class Parts:
    """What a view's measures are made of.

    ``sums``: part to an aggregate of the fact's rows whose values may be summed. ``distinct``: part to the column whose
    values are counted once. ``measures``: measure to an expression over the parts.
    """

    sums: Mapping[str, str]
    distinct: Mapping[str, str]
    measures: Mapping[str, str]

    def used(self, measures: Sequence[str]) -> tuple[list[str], list[str]]:
        """Parts that the measures name: (sums, distinct)."""
        words = {w for m in measures for w in self.measures[m].replace("(", " ").replace(")", " ").replace(",", " ").split()}
        return [p for p in self.sums if p in words], [p for p in self.distinct if p in words]


def _money(amount: str) -> dict[str, str]:
    """Sums of an amount: as decimals where these hold it, the rest as doubles, and how many there are."""
    decimal = f"TRY_CAST({amount} AS DECIMAL(18,4))"
    fits = f"CAST({decimal} AS DOUBLE) <=> {amount}"
    return {"exact": f"SUM(CASE WHEN {fits} THEN {decimal} END)", "rest": f"SUM(CASE WHEN NOT ({fits}) THEN {amount} END)",
            "priced": f"COUNT({amount})"}


_TOTAL = "COALESCE(CAST( exact AS DOUBLE) + rest , CAST( exact AS DOUBLE), rest )"

# The names of views and measures.
PARTS = {
    "metric_daily_revenue": Parts(
        {"n": "COUNT(1)", **_money("line_amount")}, {"orders": "order_id"},
        {"Revenue": _TOTAL, "Order Count": "orders", "Line Item Count": "n",
         "Average Line Amount": f"TRY_DIVIDE({_TOTAL}, priced )"}),
    "metric_monthly_revenue": Parts(
        {**_money("line_amount"), "ordered": "SUM(ordered_qty_packs)", "confirmed": "SUM(confirmed_qty_packs)"},
        {"orders": "order_id"},
        {"Revenue": _TOTAL, "Order Count": "orders", "Average Order Value": f"TRY_DIVIDE({_TOTAL}, orders )",
         "Units Ordered": "ordered", "Units Confirmed": "confirmed",
         "Fulfillment Rate": "TRY_DIVIDE( confirmed , ordered )"}),
    "metric_inventory": Parts(
        {"on_hand": "SUM(on_hand_packs)", "reserved": "SUM(reserved_packs)", "in_transit": "SUM(in_transit_packs)"},
        {"products": "product_id"},
        {"Total On Hand": "on_hand", "Total Reserved": "reserved", "Total In Transit": "in_transit",
         "Available for Sale": "on_hand - reserved", "Product Count": "products"}),
    "metric_shipments": Parts(
        {"n": "COUNT(1)"}, {"orders": "order_id", "customers": "customer_id"},
        {"Shipment Count": "n", "Order Count": "orders", "Unique Customers": "customers"}),
    "metric_returns": Parts(
        {"n": "COUNT(1)", **_money("credit_amount"), "units": "SUM(returned_qty_packs)"}, {},
        {"Return Count": "n", "Return Amount": _TOTAL, "Average Return Amount": f"TRY_DIVIDE({_TOTAL}, priced )",
         "Units Returned": "units"}),
}

# Grains to store besides the finest, all dimensions.
COARSER = {
    "metric_daily_revenue": {"month": ["Year", "Month", "Month Num"]},
    "metric_monthly_revenue": {"quarter": ["Fiscal Year", "Fiscal Year Label", "Fiscal Quarter"]},
    "metric_inventory": {"month": ["Year Month", "Month", "Fiscal Year"], "year": ["Fiscal Year"]},
    "metric_shipments": {"month": ["Year Month", "Fiscal Quarter", "Shipment Status"], "status": ["Shipment Status"]},
    "metric_returns": {"month": ["Year Month", "Fiscal Year", "Return Reason"]},
}


def number_keys(spark: SparkSession, keys: DataFrame, path: str) -> DataFrame:
    """(key, id) of all keys ever seen: those at ``path`` keep their numbers, new ones get the next, without gaps.

    Numbers run along the key's order: each range of keys counts its own, and starts after the ranges before it.
    """
    try:
        known = spark.read.parquet(path)
        start = known.agg(F.max("id")).first()[0]
        keys = keys.join(known, "key", "left_anti")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        start = None
    start = -1 if start is None else start
    work = f"{path}-ranges"
    keys.repartitionByRange("key").withColumn("range", F.spark_partition_id()).write.mode("overwrite").parquet(work)
    ranges = spark.read.parquet(work)
    sizes = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("size"))  # a row per task
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    (ranges.join(starts, "range").select("key", (F.col("start") + own + start).alias("id"))
     .write.mode("append").parquet(path))
    return spark.read.parquet(path)


def _ored(bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    return bits.groupBy(*_quoted(keys), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _bitmaps(numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of a finest rollup as bitmaps of coarser keys. The numbers are shuffled and not the bitmaps, of which
    each task would have one with few bits for almost every number."""
    placed = numbers.select(*_quoted(keys), F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("at"))
    return (placed.repartition(*_quoted(keys), "bucket").groupBy(*_quoted(keys), "bucket")
            .agg(F.bitmap_construct_agg("at").alias("bits")))


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


class Rollups:
    """The stored rollups of one view under ``root``; answers the same queries as the view."""

    def __init__(self, spark: SparkSession, root: str, view: MetricView, parts: Parts):
        self.spark, self.root, self.view, self.parts = spark, root, view, parts

    def _path(self, grain: str, table: str) -> str:
        return f"{self.root}/{grain}/{table}"

    def build(self, coarser: Mapping[str, Sequence[str]]) -> Rollups:
        """Store the rollup of all dimensions from the fact, the coarser ones from it, and how large each is."""
        finest, view, spark = list(self.view.dimensions), self.view, self.spark
        rows = view.rows(finest)
        aggregates = [F.expr(e).alias(p) for p, e in self.parts.sums.items()]
        rows.groupBy(*_quoted(finest)).agg(*aggregates).write.mode("overwrite").parquet(self._path("finest", "sums"))
        for part, column in self.parts.distinct.items():
            pairs, work = rows.select(*_quoted(finest), F.col(column).alias("key")), f"{self.root}/work/{part}"
            pairs.filter("key IS NOT NULL").distinct().write.mode("overwrite").parquet(work)
            pairs = spark.read.parquet(work)
            ids = number_keys(spark, pairs.select("key").distinct(), f"{self.root}/ids/{part}")
            pairs.join(ids, "key").drop("key").write.mode("overwrite").parquet(self._path("finest", part))
            remove_folder(spark, work)
        for grain, names in coarser.items():
            sums = self._read("finest", "sums").groupBy(*_quoted(names)).agg(*(F.sum(p).alias(p) for p in self.parts.sums))
            sums.write.mode("overwrite").parquet(self._path(grain, "sums"))
            for part in self.parts.distinct:
                _bitmaps(self._read("finest", part), names).write.mode("overwrite").parquet(self._path(grain, part))
        sizes = [(g, self._read(g, "sums").count()) for g in ("finest", *coarser)]
        spark.createDataFrame(sizes, "grain string, n long").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/grains")
        return self

    def _read(self, grain: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self._path(grain, table))

    def grains(self) -> list[str]:
        """Stored grains, the smallest first: as many rows as somebody built rollups."""
        return [r.grain for r in self.spark.read.parquet(f"{self.root}/grains").orderBy("n", "grain").collect()]

    def query(self, dimensions: Sequence[str] | Mapping[str, str], measures: Mapping[str, str],
              where: str | Column | None = None, period: str | Column | None = None,
              order_by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
        """As `MetricView.query`; conditions are over dimension names."""
        asked = Asked.of(self.view.dimensions, dimensions, measures, order_by, limit)
        if all(m in self.parts.measures for m in measures.values()):
            for grain in self.grains():
                try:
                    return asked.present(self._answer(grain, asked, measures, [c for c in (where, period) if c is not None]))
                except AnalysisException as error:
                    if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                        raise  # anything but a dimension that this grain does not have
        return self.view.query(dimensions, measures, where, period, order_by, limit)

    def _answer(self, grain: str, asked: Asked, measures: Mapping[str, str], conditions: list) -> DataFrame:
        keys, columns = list(asked.keys), list(asked.keys.values())
        sums, distinct = self.parts.used(list(measures.values()))

        def within(table: str) -> DataFrame:
            return reduce(DataFrame.filter, conditions, self._read(grain, table))

        result = within("sums").groupBy(*_quoted(keys)).agg(F.count(F.lit(1)).alias("_rows"), *(F.sum(p).alias(p) for p in sums))
        for part in distinct:
            sets = _bitmaps(within(part), keys) if grain == "finest" else _ored(within(part), keys)
            counted = sets.groupBy(*_quoted(keys)).agg(F.sum(F.bitmap_count("bits")).alias("_count"))
            other = counted.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], "_count")
            same = reduce(and_, (F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)), F.lit(True))
            result = (result.join(other, same, "left").withColumn(part, F.coalesce("_count", F.lit(0)))
                      .drop("_count", *(f"_k{i}" for i in range(len(keys)))))
        named = result.select(*[F.col(f"`{k}`").alias(c) for k, c in zip(keys, columns)], "_rows", *sums, *distinct)
        out = named.select(*_quoted(columns), "_rows", *(F.expr(self.parts.measures[m]).alias(r) for r, m in measures.items()))
        return out.drop("_rows")


def build_rollups(spark: SparkSession, views: Mapping[str, MetricView], root: str) -> dict[str, Rollups | MetricView]:
    """The views, those with known parts as stored rollups."""
    return {name: Rollups(spark, f"{root}/{name}", view, PARTS[name]).build(COARSER[name]) if name in PARTS else view
            for name, view in views.items()}
