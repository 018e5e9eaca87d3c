"""Physical plans over stored silver tables: what must never appear, and what must reach the scan."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.quality import referential_integrity
from tradeloom.plans import metric_queries as mq
from tradeloom.plans.marts import MARTS, mart, publish_marts
from tradeloom.plans.metrics import full_grain, metric_views
from tradeloom.registry.batch import AS_OF
from tradeloom.session import prepare
from tradeloom.sources.star import SILVER, Star
from tradeloom.streaming.sinks import publish

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ObjectHash")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    star, root = Star(spark, "/root/testdata/sf0.001"), tmp_path_factory.mktemp("silver")
    for name in SILVER:
        publish(star[name], f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in SILVER}


@pytest.fixture
def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def reports(tables):
    views = metric_views(tables, AS_OF)
    queries = {name: full_grain(view) for name, view in views.items()}
    return {**queries, "daily_trend": mq.daily_trend(views, 2000),
            "monthly_fiscal": mq.monthly_fiscal(views, (2000, 2001)),
            "revenue_vs_returns": mq.revenue_vs_returns(views, 2000),
            "ri_report": referential_integrity(tables)}


def test_no_forbidden_operator(tables):
    for name, df in {**{n: mart(n, tables, AS_OF) for n in MARTS}, **reports(tables)}.items():
        assert not [f for f in FORBIDDEN if f in plan(df)], name


def test_no_forbidden_operator_without_broadcast(tables, without_broadcast):
    for name, df in {**{n: mart(n, tables, AS_OF) for n in MARTS}, **reports(tables)}.items():
        text = plan(df)
        assert not [f for f in (*FORBIDDEN, "BroadcastHashJoin") if f in text], name


def test_lines_and_orders_are_shuffled_once(tables, without_broadcast):
    """Lines are combined per order before the shuffle and joined on the same partitioning."""
    text = plan(mart("monthly_revenue", tables, AS_OF))
    assert text.count("Exchange hashpartitioning(order_id") == 2
    assert text.count("Exchange") == 3


def scanned(df, column):
    """Read schemas of the scans that read a column."""
    return [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)) if column in s]


def test_scans_read_only_what_is_used(tables):
    lines = scanned(mart("monthly_revenue", tables, AS_OF), "line_amount")
    assert lines == ["order_id:string,line_amount:double"]
    snapshots = scanned(mart("inventory_monthly", tables, AS_OF), "on_hand_packs")
    assert snapshots == ["date_key:int,product_id:string,on_hand_packs:int,reserved_packs:int,"
                         "in_transit_packs:int"]


def test_current_month_reaches_the_scan(tables):
    text = plan(mart("current_month_kpis", tables, dt.date(2001, 7, 15)))
    assert text.count("GreaterThanOrEqual(date_key,20010701),LessThanOrEqual(date_key,20010731)"
                      .replace(",LessThan", ", LessThan")) >= 2
    assert "GreaterThanOrEqual(ship_date_key,20010701)" in text
    lines = next(line for line in text.splitlines() if "FileScan" in line and "line_amount" in line)
    assert "GreaterThanOrEqual(date_key,20010701)" in lines


def test_period_becomes_a_key_range_on_the_fact(tables):
    df = mq.daily_recent(metric_views(tables, AS_OF), AS_OF)
    scan = next(line for line in plan(df).splitlines() if "FileScan" in line and "line_amount" in line)
    filters = scan[scan.index("DataFilters"):]
    assert re.search(r"date_key#\d+ >= Subquery", filters)


def test_marts_are_published(spark, tables, folder):
    publish_marts(tables, AS_OF, lambda name: f"{folder}/{name}")
    assert spark.read.parquet(f"{folder}/monthly_revenue").count() == 80
    assert spark.read.parquet(f"{folder}/current_month_kpis").count() == 5


def test_tasks_of_distinct_counts_read_little(spark):
    """A task that multiplies and combines rows must not get more of them because its session merges more."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    other.conf.set(key, "64m")
    assert prepare(other).conf.get(key) == "16m"


def test_pieces_and_parts_of_a_task_do_not_grow_with_the_tables(spark):
    """Few shuffle parts cannot be merged to a size, only be larger than it; a map task sorts all it reads."""
    other, pieces = spark.newSession(), "spark.sql.files.maxPartitionBytes"
    other.conf.set("spark.sql.shuffle.partitions", "4")

    def parts():
        return re.search(r"hashpartitioning\(.*, (\d+)\)", plan(other.range(10).groupBy((F.col("id") % 3).alias("k")).count()))[1]

    assert (prepare(other).conf.get(pieces), parts()) == ("16m", "1000")
    assert (prepare(other, small_pieces=False).conf.get(pieces) != "16m", parts()) == (True, "4")
    assert (prepare(other, small_tasks=False).conf.get(pieces) != "16m", parts()) == (True, "4")
