"""Type-2 history from a change log, its current rows, and point-in-time lookups.

Both operators order the records of a key in time, per (key, time bucket), with one row per bucket carried
across the buckets of a key: a key that holds a large part of the log is spread over as many tasks as it
has buckets. By default buckets have a fixed width, the caller's choice. With ``rows_per_bucket`` keys that hold more rows
than that, found by a sketch, get buckets of about equally many rows, whatever the time these span: their bounds
are quantiles of the key's own moments. Only the records of one moment cannot be divided.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.operators.skew import heavy_keys
from tradeloom.schemas import LINEAGE

START, END = "__START_AT", "__END_AT"
Bucket = Callable[[Column], Column]


def daily(moment: Column) -> Column:
    """Default time bucket of hot keys."""
    return F.date_trunc("day", moment)


BOUNDS = 255  # quantiles of a heavy key


def _time_bounds(records: DataFrame, keys: Sequence[str], moment: str, rows_per_bucket: int) -> DataFrame:
    """(hash, bounds) of the keys with more rows than a bucket should have; a bounded number of rows."""
    heavy = F.broadcast(heavy_keys(records, keys, rows_per_bucket))
    some = records.select(F.xxhash64(*keys).alias("_hash"), moment).join(heavy, F.col("_hash") == F.col("hash"))
    parts = [i / (BOUNDS + 1) for i in range(1, BOUNDS + 1)]
    return some.groupBy("hash").agg(F.percentile_approx(moment, parts).alias("bounds"))


def _bucketed(records: DataFrame, keys: Sequence[str], moment: str, bucket: Bucket, rows_per_bucket: int | None) -> DataFrame:
    """The records with ``_bucket``, which grows with the moment within each key."""
    plain = bucket(F.col(moment))
    if rows_per_bucket is None:
        return records.withColumn("_bucket", plain)
    bounds = F.broadcast(_time_bounds(records, keys, moment, rows_per_bucket))
    below = F.array_max(F.filter("bounds", lambda bound: bound <= F.col(moment)))
    own = F.coalesce(below, F.lit("0001-01-01").cast("timestamp"))
    return (records.withColumn("_hash", F.xxhash64(*keys)).join(bounds, F.col("_hash") == F.col("hash"), "left")
            .withColumn("_bucket", F.when(F.col("bounds").isNull(), plain.cast("timestamp")).otherwise(own))
            .drop("_hash", "hash", "bounds"))


def _present(columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


def scd2_history(log: DataFrame, keys: Sequence[str], sequence: str,
                 tracked: Sequence[str] | None = None, bucket: Bucket = daily,
                 then: Sequence[str] = (), rows_per_bucket: int | None = None) -> DataFrame:
    """Versions of each key: the tracked columns with ``__START_AT`` and ``__END_AT``.

    Consecutive records with equal tracked columns are one version. Of several records with the same
    key and sequence the last by the columns ``then`` counts, and of those the largest by the tracked
    columns; without ``then`` the smallest. So the history is a function of the set of records, whatever
    their order or batches. A record without key or sequence has no place in
    it and is left out; check for such records with expectations first.
    """
    keys = list(keys)
    if tracked is None:
        tracked = [c for c in log.columns if c not in {*keys, sequence, *then, *LINEAGE}]
    tracked = list(tracked)
    log = log.select(*keys, F.col(sequence).alias(START), F.struct(*then).alias("_then") if then
                     else F.lit(None).alias("_then"), F.struct(*tracked).alias("_state"))
    log = log.filter(_present([*keys, START]))

    # one record per key and moment; copies collapse before the shuffle
    last = F.max(F.struct("_then", "_state"))["_state"] if then else F.min("_state")
    moments = log.groupBy(*keys, START).agg(last.alias("_state"))
    versions = _versions_by_bucket(moments, keys, bucket, rows_per_bucket)
    return (versions
            .select(*keys, *(F.col(f"_state.{c}").alias(c) for c in tracked), START, END))


def _changes(records: DataFrame, partition: Sequence[str]) -> DataFrame:
    """The first record of each partition and those that differ from the one before, each with the
    start of the next of them."""
    window = Window.partitionBy(*partition).orderBy(START)
    return (records
            .withColumns({"_before": F.lag("_state").over(window),
                          "_head": F.row_number().over(window) == 1})
            .filter(F.col("_head") | ~F.col("_state").eqNullSafe(F.col("_before")))
            .drop("_before").withColumn("_next", F.lead(START).over(window)))


def _versions_by_bucket(records: DataFrame, keys: Sequence[str], bucket: Bucket,
                        rows_per_bucket: int | None = None) -> DataFrame:
    # The join below implies this NULL check for one of its sides. With it on both, the sides are
    # planned alike and share their shuffles.
    records = _bucketed(records, keys, START, bucket, rows_per_bucket).filter("_bucket IS NOT NULL")
    candidates = _changes(records, [*keys, "_bucket"])

    # Across buckets: does the first record continue the last version of an earlier bucket, and when
    # does the next version after this bucket begin?
    edges = candidates.groupBy(*keys, "_bucket").agg(
        F.min_by("_state", START).alias("_first_state"),
        F.max_by("_state", START).alias("_last_state"),
        F.min(START).alias("_first_start"),
        F.min(F.when(~F.col("_head"), F.col(START))).alias("_second_start"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    later = (Window.partitionBy(*keys).orderBy(F.desc("_bucket"))
             .rowsBetween(Window.unboundedPreceding, -1))
    edges = (edges
             .withColumn("_continues",
                         F.col("_first_state").eqNullSafe(F.lag("_last_state").over(across)))
             .withColumn("_opens", F.when(F.col("_continues"), F.col("_second_start"))
                         .otherwise(F.col("_first_start")))
             .withColumn("_later", F.last("_opens", ignorenulls=True).over(later))
             .select(*keys, "_bucket", "_continues", "_later"))

    return (candidates.join(edges, [*keys, "_bucket"])
            .filter(~(F.col("_head") & F.col("_continues")))
            .select(*keys, "_state", START, F.coalesce("_next", "_later").alias(END)))


def current_dimension(history: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The open version of each key without the version columns."""
    wanted = columns or [c for c in history.columns if c not in (START, END)]
    return history.filter(F.col(END).isNull()).select(*wanted)


def scd2_as_of(facts: DataFrame, history: DataFrame, keys: Sequence[str], moment: str,
               attributes: Sequence[str], how: str = "left", bucket: Bucket = daily,
               rows_per_bucket: int | None = None) -> DataFrame:
    """Facts with the attributes of the version valid at ``moment`` (start inclusive, end exclusive).

    ``how="left"`` keeps facts without a valid version with NULL attributes, ``"inner"`` drops them.
    Versions and facts are merged in time order instead of joined on the key, which would compare
    every fact of a key with every version of it. A version without a start is never valid. Store both if they are costly to compute.
    """
    keys, attributes = list(keys), list(attributes)
    versions = history.filter(_present([*keys, START])).select(
        *keys, F.col(START).alias("_at"), F.lit(0).alias("_kind"),
        F.struct(F.col(START).alias("_from"), F.col(END).alias("_to"),
                 F.struct(*attributes).alias("_values")).alias("_version"))
    findable = _present([*keys, moment])
    probes = facts.filter(findable).select(
        *keys, F.col(moment).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*facts.columns).alias("_fact"))
    merged = versions.unionByName(probes, allowMissingColumns=True)
    found = _latest_by_bucket(_bucketed(merged, keys, "_at", bucket, rows_per_bucket), keys)
    valid = F.col("_version").isNotNull() & (F.col("_version._to").isNull()
                                             | (F.col("_at") < F.col("_version._to")))
    found = found.withColumn("_valid", valid)
    if how == "inner":
        found = found.filter("_valid")
    result = found.select(
        *(F.col(f"_fact.{c}").alias(c) for c in facts.columns),
        *(F.when(F.col("_valid"), F.col(f"_version._values.{c}")).alias(c) for c in attributes))
    if how == "inner":
        return result
    # Facts without a key or moment match nothing; they take no part in the shuffle above.
    types = {f.name: f.dataType for f in history.schema}
    lost = facts.filter(~findable).select(
        *facts.columns, *(F.lit(None).cast(types[c]).alias(c) for c in attributes))
    return result.unionAll(lost)


def _latest_by_bucket(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    inside = [*keys, "_bucket"]
    running = (Window.partitionBy(*inside).orderBy("_at", "_kind")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = (merged.withColumn("_version", F.last("_version", ignorenulls=True).over(running))
            .filter("_kind = 1"))
    earlier = (Window.partitionBy(*keys).orderBy("_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = (merged.groupBy(*inside)
               .agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_tail"))
               .withColumn("_carried", F.last("_tail", ignorenulls=True).over(earlier))
               .select(*inside, "_carried"))
    return (seen.join(carried, inside, "left")
            .select("_at", "_fact", F.coalesce("_version", "_carried").alias("_version")))
