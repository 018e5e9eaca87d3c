"""Joins on keys of which a few hold a large part of one side.

Heavy keys are found by a sketch of bounded size and spread over several salts, the more the heavier; the other side's
rows of these keys are repeated once per salt. All other keys join as they are. Nothing is collected: the
heavy keys are a table of at most ``k`` rows inside the same plan, and it works whatever the adaptive planner
sees, also inside a stage it cannot split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS, TRACKED = 256, 4096  # keys that are told apart; counters of the sketch


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int, k: int = HEAVY_KEYS, tracked: int = TRACKED) -> DataFrame:
    """(hash, salts) of the keys that hold more rows than a task should: at most ``k`` rows.

    The sketch counts within 1 / ``tracked`` of all rows, so a key heavier than that cannot be missed.
    """
    hashes = df.filter(_present(keys)).select(F.xxhash64(*keys).alias("hash"))
    rows = hashes.agg(F.expr(f"approx_top_k(hash, {k}, {tracked})").alias("top")).select(F.inline("top")).toDF("hash", "n")
    salts = F.ceil(F.col("n") / rows_per_task).cast("int")
    return rows.select("hash", salts.alias("salts")).filter("salts > 1")


def _present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present &= F.col(key).isNotNull()
    return present


def skew_join(large: DataFrame, other: DataFrame, keys: Sequence[str], spread_by: Sequence[str], rows_per_task: int,
              how: str = "inner") -> DataFrame:
    """``large`` joined to ``other`` on equal ``keys``, inner or left; the result's columns are those of a plain join.

    Rows of a heavy key are dealt out by a hash of ``spread_by``, columns of ``large`` that differ within a key: a
    repeated task deals them out alike.
    """
    if how not in ("inner", "left"):
        raise ValueError("only rows of the large side may be kept")
    keys = list(keys)
    heavy = F.broadcast(heavy_keys(large, keys, rows_per_task))  # a bounded number of rows

    def salted(side: DataFrame, salt: Column) -> DataFrame:
        hashed = side.withColumn("_hash", F.xxhash64(*keys))
        return hashed.join(heavy, F.col("_hash") == F.col("hash"), "left").withColumn("_salt", salt).drop("_hash", "hash", "salts")

    dealt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.col("salts"))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    return salted(large, dealt).join(salted(other, every), [*keys, "_salt"], how).drop("_salt")
