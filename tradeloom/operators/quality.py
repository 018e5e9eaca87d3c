"""Key checks, expectations, referential integrity, breaches and gates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def require_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows whose key columns are all present and not blank."""
    return df.filter(reduce(and_, (F.col(c).isNotNull() & (F.col(c) != "") for c in columns)))


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect_or_drop(df: DataFrame, rules: Mapping[str, str],
                   observation: Observation | str | None = None) -> DataFrame:
    """Drop rows that break any rule; a rule that evaluates to NULL counts as broken.

    ``observation`` collects the input row count and the failures of each rule while the result is
    computed, without a second pass. In a stream it is a name, and the counts of each batch are in
    the query's progress under that name.
    """
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"),
                        *(F.count_if(~_holds(p)).alias(name) for name, p in rules.items()))
    return df.filter(reduce(and_, (_holds(p) for p in rules.values())))


def dropped_in_stream(query: StreamingQuery, observation: str) -> dict[str, int]:
    """Rows seen and failures per rule of a query's recent batches."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(observation)
        for name, count in (row.asDict() if row else {}).items():
            totals[name] = totals.get(name, 0) + count
    return totals


def expectation_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule with the rows seen, failed and kept, from one aggregate over the input."""
    failures = [F.count_if(~_holds(p)).alias(f"f{i}") for i, p in enumerate(rules.values())]
    totals = df.agg(F.count(F.lit(1)).alias("n"), *failures)
    entries = [F.struct(F.lit(name).alias("expectation"), F.col("n").alias("total_rows"),
                        F.col(f"f{i}").alias("failed_rows"),
                        (F.col("n") - F.col(f"f{i}")).alias("passed_rows"))
               for i, name in enumerate(rules)]
    return totals.select(F.inline(F.array(*entries)))


@dataclass(frozen=True)
class Reference:
    """One foreign key of a fact to check against a dimension."""

    fact: str
    dimension: str
    column: str

    @property
    def label(self) -> str:
        return f"{self.fact} -> {self.dimension} ({self.column})"


# The nine foreign keys to check.
STAR_REFERENCES = (
    Reference("fct_sales_orders", "dim_customers_current", "customer_id"),
    Reference("fct_sales_orders", "dim_distribution_centers_current", "dc_id"),
    Reference("fct_sales_order_lines", "dim_products_current", "product_id"),
    Reference("fct_inventory_snapshots", "dim_distribution_centers_current", "dc_id"),
    Reference("fct_inventory_snapshots", "dim_products_current", "product_id"),
    Reference("fct_shipments", "dim_distribution_centers_current", "dc_id"),
    Reference("fct_shipments", "dim_customers_current", "customer_id"),
    Reference("fct_returns", "dim_customers_current", "customer_id"),
    Reference("fct_returns", "dim_products_current", "product_id"),
)


def referential_integrity(tables: Mapping[str, DataFrame],
                          references: Iterable[Reference] = STAR_REFERENCES) -> DataFrame:
    """Rows and unmatched rows of every foreign key; a NULL key counts as unmatched.

    All foreign keys into one dimension are checked by one join. They are counted per (check, key)
    first, so the join sees distinct keys, and a key holding most of a fact is one row of it.
    """
    references = list(references)
    per_dimension = []
    for dimension in dict.fromkeys(r.dimension for r in references):
        checks = [r for r in references if r.dimension == dimension]
        column = checks[0].column
        keys = reduce(DataFrame.unionAll, (
            tables[r.fact].select(F.lit(r.label).alias("check_name"), F.col(r.column).alias("k"))
            for r in checks))
        counted = keys.groupBy("check_name", "k").agg(F.count(F.lit(1)).alias("n"))
        known = tables[dimension].select(F.col(column).alias("d"))
        per_dimension.append(
            counted.join(known, F.col("k") == F.col("d"), "left").groupBy("check_name")
            .agg(F.sum("n").alias("fact_rows"),
                 F.sum(F.when(F.col("d").isNull(), F.col("n")).otherwise(0)).alias("unmatched_rows")))
    found = reduce(DataFrame.unionAll, per_dimension)
    # A fact without rows forms no group above; it still gets its line.
    spark = found.sparkSession
    labels = spark.range(1).select(
        F.explode(F.array(*(F.lit(r.label) for r in references))).alias("check_name"))
    report = labels.join(found, "check_name", "left")
    rows = F.coalesce("fact_rows", F.lit(0))
    return report.select(
        "check_name", rows.alias("fact_rows"), "unmatched_rows",
        F.round(F.try_divide(F.col("unmatched_rows") * 100.0, rows), 4).cast("double")
        .alias("unmatched_pct"))


class IntegrityError(RuntimeError):
    """A quality gate failed."""


def assert_integrity(report: DataFrame) -> None:
    """Fail when the report is empty or any foreign key has unmatched rows."""
    rows = report.select("check_name", "unmatched_rows").collect()  # one row per check
    if not rows:
        raise IntegrityError("the integrity report is empty")
    broken = [f"{r.check_name}: {r.unmatched_rows}" for r in rows if (r.unmatched_rows or 0) > 0]
    if broken:
        raise IntegrityError("unmatched foreign keys: " + "; ".join(sorted(broken)))


def inventory_breaches(inventory: DataFrame, threshold: int) -> DataFrame:
    """Snapshots with fewer available packs than ``threshold`` and how severe that is."""
    available = F.col("on_hand_packs") - F.col("reserved_packs")
    return (inventory.withColumn("available_packs", available)
            .filter(F.col("available_packs") < threshold)
            .withColumn("severity", F.when(F.col("available_packs") <= 0, "CRITICAL")
                        .when(F.col("available_packs") < threshold / 2, "HIGH")
                        .otherwise("MEDIUM")))


def assert_max_rows(df: DataFrame, limit: int) -> None:
    """Fail when the frame has ``limit`` rows or more; stops reading once that many are found."""
    if df.limit(limit).count() >= limit:
        raise IntegrityError(f"{limit} rows or more break the rule")
