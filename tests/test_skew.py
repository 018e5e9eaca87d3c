"""Joins and histories in which one key holds much of all rows: same rows, even tasks."""

import datetime as dt
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests_helpers import expected_history
from tradeloom.operators.scd2 import _bucketed, daily, scd2_as_of, scd2_history
from tradeloom.operators.skew import heavy_keys, skew_join

T0 = dt.datetime(2026, 4, 1)


def test_heavy_keys_are_found(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 9 == 0, F.lit("warm"))
                                      .when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    hashes = {r.h: r.k for r in rows.select(F.xxhash64("k").alias("h"), "k").distinct().collect()}
    got = {hashes[r.hash]: r.salts for r in heavy_keys(rows, ["k"], 2000).collect()}
    assert set(got) == {"hot", "warm"} and got["hot"] in (15, 16) and got["warm"] in (2, 3)
    assert heavy_keys(rows.limit(0), ["k"], 10).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_equals_a_plain_one(spark, how):
    pick = random.Random(1)
    left = spark.createDataFrame([(pick.choice(["hot"] * 30 + ["a", "b", None, "missing"]), i, float(i)) for i in range(3000)],
                                 "k STRING, order INT, v DOUBLE")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("c", 4), (None, 5)], "k STRING, w INT")
    got, want = skew_join(left, right, ["k"], ["order"], 100, how), left.join(right, ["k"], how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_half_of_all_rows_on_one_key_is_spread(spark):
    """Without broadcast and without adaptive help, the longest task is near the median."""
    lines = spark.range(80_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("p"), (F.col("id") % 4001).cast("string"))).alias("product_id"), F.col("id").alias("order_id"))
    products = lines.select("product_id").distinct().withColumn("area", F.substring("product_id", 1, 2))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        def tasks(joined):
            return sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect())
        plain = tasks(lines.join(products, "product_id"))
        even = tasks(skew_join(lines, products, ["product_id"], ["order_id"], 500))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(plain) == sum(even) == 80_000
    assert max(plain) > 6 * statistics.median(plain) and max(even) < 1.8 * statistics.median(even)


def test_buckets_by_count(spark):
    """One key with a busy day: its records spread over buckets, versions and lookups are the same."""
    pick = random.Random(7)
    busy = [("hot", T0 + dt.timedelta(seconds=pick.randrange(80_000)), pick.choice("xy"), None) for _ in range(1500)]
    rest = [(f"k{pick.randrange(40)}", T0 + dt.timedelta(hours=pick.randrange(900)), pick.choice("xy"), None) for _ in range(300)]
    log = spark.createDataFrame(busy + rest, "k STRING, at TIMESTAMP, a STRING, zones ARRAY<STRING>").repartition(5)
    history = scd2_history(log, ["k"], "at", ["a", "zones"], rows_per_bucket=50)
    assert sorted(map(repr, (tuple(r) for r in history.collect()))) == sorted(map(repr, expected_history(busy + rest)))
    facts = log.select("k", F.expr("at + INTERVAL 7 SECONDS").alias("at"), F.lit(1).alias("one"))
    by_count, by_day = (scd2_as_of(facts, history, ["k"], "at", ["a"], rows_per_bucket=n) for n in (50, None))
    assert sorted(map(repr, by_count.collect())) == sorted(map(repr, by_day.collect()))

    def sizes(**options):
        rows = _bucketed(log, ["k"], "at", daily, **options).filter("k = 'hot'").groupBy(F.col("_bucket").cast("string").alias("_bucket")).count().collect()
        return Counter({r._bucket: r["count"] for r in rows})
    assert max(sizes(rows_per_bucket=None).values()) == 1500
    spread = sizes(rows_per_bucket=50)
    assert max(spread.values()) < 50 and sum(spread.values()) == 1500
