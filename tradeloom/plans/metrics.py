"""Metric views: named dimensions and measures over a fact, evaluated at the grain of each query."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """A table looked up from the fact by one key; its columns are used as ``name.column``.

    The lookup keeps facts without a match. ``unique`` says that at most one row matches; such a
    lookup is left out of queries that use none of its columns.
    """

    name: str
    table: DataFrame
    source_key: str
    key: str
    unique: bool = True

    def on(self) -> Column:
        return F.col(f"source.{self.source_key}") == F.col(f"{self.name}.{self.key}")


@dataclass(frozen=True)
class MetricView:
    """A fact (known as ``source``), its lookups, an optional filter, dimensions and measures.

    Dimensions and measures map a display name to a Spark SQL expression. Measures are always
    computed from the fact's rows at the grain asked for, so ratios and distinct counts are right at
    every grain. The first lookup is the one ``period`` conditions apply to.
    """

    source: DataFrame
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    lookups: Sequence[Lookup] = ()
    where: str | None = None

    def query(self, dimensions: Sequence[str] | Mapping[str, str], measures: Mapping[str, str],
              where: str | Column | None = None, period: str | Column | None = None,
              order_by: Sequence[str] = (), limit: int | None = None) -> DataFrame:
        """One row per combination of the dimensions.

        ``dimensions``: names, or result name to dimension name. ``measures``: result name to
        measure name. ``where``: condition over dimension names. ``period``: condition over the
        first lookup's dimensions; facts matching none of its rows are left out. ``order_by``:
        dimension names or result names, descending with a leading ``-``; a dimension that is not
        selected is grouped by as well and removed after the sort.
        """
        asked = Asked.of(self.dimensions, dimensions, measures, order_by, limit)
        keys = [F.expr(self.dimensions[d]).alias(column) for d, column in asked.keys.items()]
        used = [*(self.dimensions[d] for d in asked.keys),
                *(self.measures[m] for m in measures.values()), self.where or ""]
        rows = self._rows(used, where, period)
        return asked.present(rows.groupBy(*keys).agg(*(F.expr(self.measures[m]).alias(r)
                                                       for r, m in measures.items())))

    def rows(self, dimensions: Sequence[str]) -> DataFrame:
        """The fact's columns, after the view's filter, and the dimensions under their display names.

        A column of the fact with the name of a dimension gives way to it.
        """
        found = self._rows([*(self.dimensions[d] for d in dimensions), self.where or ""], None, None)
        named = {d.lower() for d in dimensions}
        own = [F.col(f"source.`{c}`") for c in self.source.columns if c.lower() not in named]
        return found.select(*own, *(F.expr(self.dimensions[d]).alias(d) for d in dimensions))

    def _rows(self, used: Sequence[str], where: str | Column | None,
              period: str | Column | None) -> DataFrame:
        rows = self.source.alias("source")
        for position, lookup in enumerate(self.lookups):
            if period is not None and position == 0:
                rows = self._within(rows, lookup, period)
            elif where is not None or not lookup.unique or any(f"{lookup.name}." in e for e in used):
                rows = rows.join(lookup.table.alias(lookup.name), lookup.on(), "left")
        if self.where:
            rows = rows.filter(self.where)
        return rows if where is None else self._named(rows).filter(where)

    def _named(self, rows: DataFrame) -> DataFrame:
        """Rows with the dimensions as columns beside those of the fact and the lookups."""
        taken = {c.lower() for c in rows.columns}
        extra = {}
        for name, expression in self.dimensions.items():
            if name.lower() not in taken:
                extra[name] = expression
            elif expression.split(".")[-1].lower() != name.lower():
                raise ValueError(f"dimension {name!r} hides another column of that name")
        return rows.select("*", *(F.expr(e).alias(n) for n, e in extra.items()))

    def _within(self, rows: DataFrame, lookup: Lookup, period: str | Column) -> DataFrame:
        """Facts of a period. The period's key range is also put on the fact's own key, where it
        reaches the scan and skips files and row groups outside the period."""
        own = {n: e for n, e in self.dimensions.items()
               if f"{lookup.name}." in e and "source." not in e}
        chosen = (lookup.table.alias(lookup.name)
                  .select("*", *(F.expr(e).alias(n) for n, e in own.items()))
                  .filter(period).select(*lookup.table.columns))
        key = F.col(f"source.{lookup.source_key}")
        rows = rows.filter(key.between(chosen.agg(F.min(lookup.key)).scalar(),
                                       chosen.agg(F.max(lookup.key)).scalar()))
        return rows.join(chosen.alias(lookup.name), lookup.on())


@dataclass(frozen=True)
class Asked:
    """The shape of a query: columns to group by and how the result is sorted and cut."""

    keys: dict[str, str]  # dimension to result column; a dimension only sorted by has a hidden one
    hidden: list[str]
    order: list[tuple[str, bool]]  # result column, descending
    limit: int | None

    @classmethod
    def of(cls, known: Mapping[str, str], dimensions: Sequence[str] | Mapping[str, str], measures: Mapping[str, str],
           order_by: Sequence[str], limit: int | None) -> Asked:
        wanted = dict(dimensions) if isinstance(dimensions, Mapping) else {d: d for d in dimensions}
        keys = {source: result for result, source in wanted.items()}
        order = [(name.removeprefix("-"), name.startswith("-")) for name in order_by]
        hidden = {n: f"_{n}" for n, _ in order if n in known and n not in keys and n not in measures}
        keys |= hidden
        return cls(keys, list(hidden.values()), [(keys.get(n, n), desc) for n, desc in order], limit)

    def present(self, result: DataFrame) -> DataFrame:
        if self.order:
            columns = [(F.col(f"`{n}`"), desc) for n, desc in self.order]
            result = result.orderBy(*(c.desc() if desc else c.asc() for c, desc in columns))
        if self.limit is not None:
            result = result.limit(self.limit)
        return result.drop(*self.hidden)


def full_grain(view: MetricView) -> DataFrame:
    """Every measure by every dimension."""
    return view.query(list(view.dimensions), {m: m for m in view.measures})


def metric_views(tables: Mapping[str, DataFrame], as_of: dt.date | str) -> dict[str, MetricView]:
    """The six metric views over the silver facts and the calendar."""
    calendar = tables["dim_time"]

    def by_day(fact: str, dimensions: dict[str, str], measures: dict[str, str],
               day: str = "date_key", where: str | None = None) -> MetricView:
        lookup = Lookup("time_dim", calendar, day, "date_key")
        return MetricView(tables[fact], dimensions, measures, [lookup], where)

    def total(amount: str) -> str:
        # as functions.money_sum: decimals where these hold the amount, whatever the order of the rows
        decimal = f"TRY_CAST({amount} AS DECIMAL(18,4))"
        fits = f"CAST({decimal} AS DOUBLE) <=> {amount}"
        exact = f"CAST(SUM(CASE WHEN {fits} THEN {decimal} END) AS DOUBLE)"
        rest = f"SUM(CASE WHEN NOT ({fits}) THEN {amount} END)"
        return f"COALESCE({exact} + {rest}, {exact}, {rest})"

    def average(amount: str) -> str:
        return f"TRY_DIVIDE({total(amount)}, COUNT({amount}))"

    # Names and definitions of dimensions and measures.
    orders = "COUNT(DISTINCT source.order_id)"
    revenue_per_order = f"TRY_DIVIDE({total('line_amount')}, {orders})"
    return {
        "metric_daily_revenue": by_day(
            "fct_sales_order_lines",
            {"Calendar Date": "time_dim.calendar_date", "Year": "time_dim.year_num",
             "Month": "time_dim.month_name", "Month Num": "time_dim.month_num",
             "Week Start": "time_dim.week_start_date", "Day Name": "time_dim.day_name",
             "Is Weekend": "time_dim.is_weekend"},
            {"Revenue": total("line_amount"), "Order Count": orders, "Line Item Count": "COUNT(1)",
             "Average Line Amount": average("line_amount")}),
        "metric_monthly_revenue": by_day(
            "fct_sales_order_lines",
            {"Calendar Year": "time_dim.year_num", "Calendar Month": "time_dim.month_num",
             "Month Label": "time_dim.month_label", "Fiscal Year": "time_dim.fiscal_year",
             "Fiscal Year Label": "time_dim.fiscal_year_label",
             "Fiscal Month": "time_dim.fiscal_month_num",
             "Fiscal Quarter": "time_dim.fiscal_quarter_num"},
            {"Revenue": total("line_amount"), "Order Count": orders,
             "Average Order Value": revenue_per_order,
             "Units Ordered": "SUM(ordered_qty_packs)",
             "Units Confirmed": "SUM(confirmed_qty_packs)",
             "Fulfillment Rate": "TRY_DIVIDE(SUM(confirmed_qty_packs), SUM(ordered_qty_packs))"}),
        "metric_fiscal_ytd": by_day(
            "fct_sales_order_lines",
            {"Fiscal Year": "time_dim.fiscal_year",
             "Fiscal Year Label": "time_dim.fiscal_year_label",
             "Fiscal Month": "time_dim.fiscal_month_num",
             "Fiscal Quarter": "time_dim.fiscal_quarter_num"},
            {"YTD Revenue": total("line_amount"), "YTD Order Count": orders,
             "YTD Average Order Value": revenue_per_order},
            where="time_dim.calendar_date BETWEEN time_dim.fiscal_year_start_date "
                  f"AND DATE'{as_of}'"),
        "metric_inventory": by_day(
            "fct_inventory_snapshots",
            {"Calendar Date": "time_dim.calendar_date", "Year Month": "time_dim.month_label",
             "Month": "time_dim.month_name", "Fiscal Year": "time_dim.fiscal_year"},
            {"Total On Hand": "SUM(on_hand_packs)", "Total Reserved": "SUM(reserved_packs)",
             "Total In Transit": "SUM(in_transit_packs)",
             "Available for Sale": "SUM(on_hand_packs) - SUM(reserved_packs)",
             "Product Count": "COUNT(DISTINCT product_id)"}),
        "metric_shipments": by_day(
            "fct_shipments",
            {"Ship Date": "time_dim.calendar_date", "Year Month": "time_dim.month_label",
             "Fiscal Quarter": "CONCAT('FQ', time_dim.fiscal_quarter_num)",
             "Shipment Status": "source.shipment_status"},
            {"Shipment Count": "COUNT(1)", "Order Count": "COUNT(DISTINCT order_id)",
             "Unique Customers": "COUNT(DISTINCT customer_id)"}, day="ship_date_key"),
        "metric_returns": by_day(
            "fct_returns",
            {"Return Date": "time_dim.calendar_date", "Year Month": "time_dim.month_label",
             "Fiscal Year": "time_dim.fiscal_year", "Return Reason": "source.reason_code"},
            {"Return Count": "COUNT(1)", "Return Amount": total("credit_amount"),
             "Average Return Amount": average("credit_amount"),
             "Units Returned": "SUM(returned_qty_packs)"}),
    }
