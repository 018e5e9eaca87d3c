"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

As in production, the silver tables are written first (timed as ``silver_build``) and the marts, metric
queries and checks read them. Every query is run whole into the ``noop`` sink; all times are the median of
three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tradeloom.operators.quality import inventory_breaches, referential_integrity
from tradeloom.operators.scd2 import scd2_as_of, scd2_history
from tradeloom.plans import metric_queries as mq
from tradeloom.plans.marts import MARTS, mart
from tradeloom.plans.metrics import metric_views
from tradeloom.registry.batch import AS_OF, BREACH_THRESHOLD, YEAR, YEARS
from tradeloom.session import build_session, work_dir
from tradeloom.sources.star import SILVER, Star
from tradeloom.streaming.sinks import publish

CLUSTER = {"fct_sales_orders": ("date_key", "order_id"),
           "fct_sales_order_lines": ("date_key", "order_id"),
           "fct_shipments": ("ship_date_key", "shipment_id"),
           "fct_returns": ("date_key", "return_id"),
           "fct_inventory_snapshots": ("date_key", "snapshot_id")}


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def history_of(log):
    return scd2_history(log, ["user_id"], "_ingested_at", ["event_type"])


def build(spark, folder: str, root: str) -> float:
    """Write all silver tables and the history."""
    star, start = Star(spark, folder), time.perf_counter()
    star.stage_lines(f"{root}/lines")
    for table in SILVER:
        publish(star[table], f"{root}/{table}", CLUSTER.get(table, ()))
    publish(history_of(star.change_log), f"{root}/history")
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    root = work_dir(spark, "bench")
    timings = {"silver_build": statistics.median(build(spark, folder, root) for _ in range(3))}

    tables = {t: spark.read.parquet(f"{root}/{t}") for t in SILVER}
    views = metric_views(tables, AS_OF)
    log, history = Star(spark, folder).change_log, spark.read.parquet(f"{root}/history")
    queries = {name: (lambda n=name: mart(n, tables, AS_OF)) for name in MARTS}
    queries |= {
        "mq_daily_trend": lambda: mq.daily_trend(views, YEAR),
        "mq_monthly_fiscal": lambda: mq.monthly_fiscal(views, YEARS),
        "mq_fiscal_ytd_quarter": lambda: mq.fiscal_ytd_quarter(views, YEARS),
        "mq_inventory_month": lambda: mq.inventory_month(views, YEAR),
        "mq_shipments_status": lambda: mq.shipments_status(views),
        "mq_returns_reason": lambda: mq.returns_reason(views, YEAR),
        "mq_revenue_vs_returns": lambda: mq.revenue_vs_returns(views, YEAR),
        "mq_latest_ytd_kpi": lambda: mq.latest_ytd_kpi(views),
        "mq_daily_90d": lambda: mq.daily_recent(views, AS_OF),
        "mq_monthly_recent": lambda: mq.monthly_recent(views, AS_OF),
        "mq_returns_recent": lambda: mq.returns_recent(views, AS_OF),
        "ri_report": lambda: referential_integrity(tables),
        "inventory_breaches": lambda: inventory_breaches(
            tables["fct_inventory_snapshots"], BREACH_THRESHOLD),
        "scd2_history": lambda: history_of(log),
        "scd2_as_of": lambda: scd2_as_of(log, history, ["user_id"], "_ingested_at",
                                         ["event_type"]).toDF("user_id", "ts", "sent", "found"),
    }
    for name, query in queries.items():
        timings[name] = statistics.median(run(query()) for _ in range(3))
    print(json.dumps({
        "metric": "silver build plus one run of each query", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": {n: round(t, 3) for n, t in timings.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
