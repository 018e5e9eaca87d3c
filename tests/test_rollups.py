"""Rollups answer like the fact, at every grain, and from the smallest rollup that can."""

import datetime as dt
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tradeloom.plans import metric_queries as q
from tradeloom.plans.metrics import Lookup, MetricView, metric_views
from tradeloom.plans.rollups import Parts, Rollups, _bitmaps, build_rollups, number_keys
from tradeloom.registry.batch import AS_OF, YEAR
from tradeloom.registry.rollups import _Rollups
from tradeloom.sources.star import Star

FOLDER = "/root/testdata/sf0.001"
DIMENSIONS = {"Day": "time.d", "Month": "time.m", "Kind": "source.sort"}
MEASURES = {"Rows": "COUNT(1)", "Packs": "SUM(packs)", "Orders": "COUNT(DISTINCT order_id)", "Rate": "TRY_DIVIDE(SUM(packs), COUNT(1))"}
PARTS_OF = Parts({"n": "COUNT(1)", "packs_sum": "SUM(packs)"}, {"orders": "order_id"},
                 {"Rows": "n", "Packs": "packs_sum", "Orders": "orders", "Rate": "TRY_DIVIDE( packs_sum , n )"})


def small_view(spark, rows=400):
    pick = random.Random(6)
    fact = [(pick.choice([None, *range(1, 61)]), pick.choice(["a", "b", None]), pick.choice([None, *(f"o{i}" for i in range(50))]),
             pick.choice([None, 1, 2, 3])) for _ in range(rows)]
    days = [(d, (d - 1) // 30) for d in range(1, 51)]  # some days are in no calendar
    calendar = spark.createDataFrame(days, "d INT, m INT")
    return MetricView(spark.createDataFrame(fact, "date_key INT, sort STRING, order_id STRING, packs INT"), DIMENSIONS, MEASURES,
                      [Lookup("time", calendar, "date_key", "d")])


def test_every_grain_equals_the_fact(spark, folder):
    view = small_view(spark)
    rollups = Rollups(spark, folder, view, PARTS_OF).build({"month": ["Month", "Kind"], "kind": ["Kind"]})
    names = {m: m for m in MEASURES}
    conditions = [{}, {"period": "Month = 0"}, {"where": "Kind = 'a'"}, {"where": F.col("Kind").isNull(), "period": "Day > 20"}]
    for n in range(1, 4):
        for dims in combinations(DIMENSIONS, n):
            for condition in conditions:
                got, want = (sorted(map(repr, x.query(list(dims), names, **condition).collect())) for x in (rollups, view))
                assert got == want, (dims, condition)
    ordered = [x.query(["Kind"], {"o": "Orders"}, order_by=["-Month", "o", "Kind"], limit=3).collect() for x in (rollups, view)]
    assert ordered[0] == ordered[1]


def test_the_smallest_rollup_that_can_answers(spark, folder):
    view = small_view(spark)
    rollups = Rollups(spark, folder, view, PARTS_OF).build({"month": ["Month", "Kind"], "kind": ["Kind"]})

    def read(*args, **options):
        return {p.split("/")[-3] for p in rollups.query(*args, **options).inputFiles()}

    assert rollups.grains() == ["kind", "month", "finest"]
    assert read(["Kind"], {"n": "Rows"}) == {"kind"}
    assert read(["Kind"], {"n": "Orders"}, period="Month = 1") == {"month"}
    assert read(["Kind"], {"n": "Orders"}, order_by=["Day"]) == {"finest"}
    assert rollups.query(["Kind"], {"n": "Orders"}, where="packs = 1").count() == view.query(
        ["Kind"], {"n": "Orders"}, where="packs = 1").count()  # no dimension: from the fact
    with pytest.raises(Exception, match="nowhere"):
        rollups.query(["Kind"], {"n": "Rows"}, where="nowhere = 1")


def test_reports_read_rollups(spark, folder):
    views = metric_views(Star(spark, FOLDER), AS_OF)
    stored = build_rollups(spark, views, folder)
    for report in (lambda v: q.shipments_status(v), lambda v: q.inventory_month(v, YEAR), lambda v: q.monthly_fiscal(v, (YEAR,))):
        df = report(stored)
        assert df.inputFiles() and all(f"{folder}/" in p for p in df.inputFiles())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan
        assert sorted(map(repr, df.columns)) == sorted(map(repr, report(views).columns))
    days = stored["metric_shipments"]._read("finest", "sums").count()
    assert stored["metric_shipments"]._read("month", "sums").count() < days / 10


def test_rebuilding_keeps_numbers(spark, folder):
    path = f"{folder}/ids"
    first = {r.key: r.id for r in number_keys(spark, spark.range(5000).selectExpr("concat('k', id) AS key"), path).collect()}
    assert sorted(first.values()) == list(range(5000))
    more = spark.range(4000, 9000).selectExpr("concat('k', id) AS key")
    second = {r.key: r.id for r in number_keys(spark, more, path).collect()}
    assert sorted(second.values()) == list(range(9000)) and all(second[k] == n for k, n in first.items())
    assert number_keys(spark, more.limit(0), path).count() == 9000
    view = small_view(spark)
    rollups = Rollups(spark, f"{folder}/r", view, PARTS_OF).build({})
    grown = MetricView(view.source.unionAll(spark.createDataFrame([(3, "c", "new", 1)], view.source.schema)), DIMENSIONS, MEASURES, view.lookups)
    rollups = Rollups(spark, f"{folder}/r", grown, PARTS_OF).build({"kind": ["Kind"]})
    got, want = (sorted(map(repr, x.query(["Kind"], {"o": "Orders"}).collect())) for x in (rollups, grown))
    assert got == want


def test_bitmaps_are_made_after_the_shuffle(spark, folder):
    rollups = Rollups(spark, folder, small_view(spark), PARTS_OF).build({"kind": ["Kind"]})
    numbers = rollups._read("finest", "orders")
    assert "bits" not in numbers.columns and numbers.count() == numbers.distinct().count()
    plan = _bitmaps(numbers, ["Kind"])._jdf.queryExecution().sparkPlan().toString()
    above, below = plan.split("Exchange")
    assert "bitmap_construct_agg" in above and "bitmap_construct_agg" not in below


def test_only_views_that_are_asked_for_are_built(spark):
    built = _Rollups(spark, FOLDER)
    assert built["metric_returns"] is built["metric_returns"] and list(built) == ["metric_returns"]
