"""Batch de-duplication on a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    # Spark turns "row_number = 1" into a group limit that runs before the shuffle as well, so each
    # task sends one row per key and a key with millions of copies does not overload its reducer.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key; ``order`` must be total inside a key for a stable result."""
    return _one_per_key(df, keys, [F.col(c) if isinstance(c, str) else c for c in order])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key. Not what the facts use: they keep the first arrival."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in order])
