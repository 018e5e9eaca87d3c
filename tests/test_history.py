"""Type-2 history and point-in-time lookups against brute force."""

import datetime as dt
import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests_helpers import expected_history
from tradeloom.operators.scd2 import (_versions_by_bucket, current_dimension, daily, scd2_as_of,
                                      scd2_history)

T0 = dt.datetime(2024, 1, 1)
LOG = "k STRING, at TIMESTAMP, a STRING, zones ARRAY<STRING>"


def history(spark, records, **options):
    log = spark.createDataFrame(records, LOG)
    return scd2_history(log, ["k"], "at", ["a", "zones"], **options)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def hot_log(seed, n=400):
    """A third of the records share one key; states repeat; moments fall on few days."""
    rng = random.Random(seed)
    records = []
    for _ in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}"
        at = T0 + dt.timedelta(days=rng.randrange(6), minutes=rng.randrange(0, 1440, 30))
        zones = rng.choice([None, ["A"], ["A", "B"]])
        records.append((key, at, rng.choice(["x", "y", None]), zones))
    return records


def test_history_equals_brute_force(spark):
    for seed in (1, 2, 3):
        records = hot_log(seed)
        assert collected(history(spark, records)) == expected_history(records)


def test_bucket_width_does_not_matter(spark):
    records = hot_log(3)
    want = expected_history(records)
    for bucket in (lambda c: F.date_trunc("hour", c), lambda c: F.date_trunc("year", c)):
        assert collected(history(spark, records, bucket=bucket)) == want


def test_runs_cross_empty_and_unchanged_buckets(spark):
    days = [("k", T0 + dt.timedelta(days=d), a, None)
            for d, a in [(0, "x"), (1, "x"), (5, "x"), (6, "y"), (6.5, "y"), (9, "y"), (12, "x")]]
    by_bucket = collected(history(spark, days))
    assert by_bucket == [
        ("k", "x", None, T0, T0 + dt.timedelta(days=6)),
        ("k", "x", None, T0 + dt.timedelta(days=12), None),
        ("k", "y", None, T0 + dt.timedelta(days=6), T0 + dt.timedelta(days=12))]


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60),
                          st.sampled_from(["x", "y"])), min_size=1, max_size=25), st.randoms())
def test_history_ignores_order_and_copies(spark, rows, rng):
    records = [(k, T0 + dt.timedelta(hours=3 * h), a, None) for k, h, a in rows]
    shuffled = records + rng.sample(records, len(records) // 2)
    rng.shuffle(shuffled)
    assert collected(history(spark, shuffled)) == expected_history(records)


def test_windows_over_a_whole_hot_key_see_one_row_per_bucket(spark):
    records = spark.createDataFrame([], "k STRING, __START_AT TIMESTAMP, _state STRUCT<a: STRING>")
    plan = _versions_by_bucket(records, ["k"], daily)._jdf.queryExecution().analyzed().toString()
    windows = [line for line in plan.splitlines() if "+- Window" in line or "Window [" in line]
    whole_key = [w for w in windows if re.search(r"\], \[k#\d+\], \[", w)]
    assert len(windows) > len(whole_key) == 2
    assert all("_last_state" in w or "_opens" in w for w in whole_key)


def test_current_rows(spark):
    versions = spark.createDataFrame(
        [("CUST-1", "NORTH", 1.0, T0, T0 + dt.timedelta(hours=1)),
         ("CUST-1", "INLAND", 720.25, T0 + dt.timedelta(hours=1), None)],
        "customer_id STRING, region STRING, credit_limit DOUBLE, __START_AT TIMESTAMP, "
        "__END_AT TIMESTAMP")
    assert [tuple(r) for r in current_dimension(versions).collect()] == [
        ("CUST-1", "INLAND", 720.25)]


def test_as_of_equals_brute_force(spark):
    records = hot_log(5)
    versions = expected_history(records)
    rng = random.Random(6)
    facts = [(i, rng.choice(["hot", "hot", "k1", "k2", "unknown", None]),
              T0 + dt.timedelta(days=rng.randrange(-2, 9), minutes=rng.randrange(0, 1440, 15)))
             for i in range(300)]
    df = spark.createDataFrame(facts, "id INT, k STRING, ts TIMESTAMP")
    stored = history(spark, records)
    found = scd2_as_of(df, stored, ["k"], "ts", ["a", "zones", "__START_AT"])
    got = {r.id: (r.a, r.zones, r["__START_AT"]) for r in found.collect()}
    assert len(got) == 300
    for i, key, ts in facts:
        match = [(a, z, s) for k, a, z, s, e in versions
                 if k == key and s <= ts and (e is None or ts < e)]
        assert got[i] == (match[0] if match else (None, None, None))
    kept = scd2_as_of(df, stored, ["k"], "ts", ["a"], how="inner").count()
    assert kept == sum(1 for v in got.values() if v[2] is not None)


def test_as_of_respects_closed_versions(spark):
    versions = spark.createDataFrame(
        [("k", "x", T0, T0 + dt.timedelta(days=2))],
        "k STRING, a STRING, __START_AT TIMESTAMP, __END_AT TIMESTAMP")
    facts = spark.createDataFrame([(1, "k", T0), (2, "k", T0 + dt.timedelta(days=1, hours=23)),
                                   (3, "k", T0 + dt.timedelta(days=2))], "id INT, k STRING, ts TIMESTAMP")
    found = scd2_as_of(facts, versions, ["k"], "ts", ["a"])
    assert {r.id: r.a for r in found.collect()} == {1: "x", 2: "x", 3: None}


def test_version_without_a_start_is_never_found(spark):
    stored = spark.createDataFrame([("k", "old", None, T0), ("k", "new", T0, None)],
                                   "k STRING, a STRING, __START_AT TIMESTAMP, __END_AT TIMESTAMP")
    facts = spark.createDataFrame([(1, "k", T0 - dt.timedelta(days=1)), (2, "k", T0)], "id INT, k STRING, ts TIMESTAMP")
    found = scd2_as_of(facts, stored, ["k"], "ts", ["a"]).orderBy("id").collect()
    assert [r.a for r in found] == [None, "new"]
