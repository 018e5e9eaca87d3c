"""Helpers the operators share: text rules, stored intermediate tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import work_dir

SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

# An Arrow batch holds this many rows at most, so that a batch of long documents stays small.
BATCH_ROWS = "256"


def prepare_llm(spark: SparkSession) -> SparkSession:
    """Bound the rows of an Arrow batch; texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends here and survives lost executors."""
    return saved_at(df, label)[0]


def saved_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As `saved`, with the table's path."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of `saved_at` that a later one replaces."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves the remainder; False for a NULL key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a, b): one row (node, root) for each node except roots.

    ``root`` is the smallest node of the component. Alternates the large-star and small-star steps
    until the links are stars; each step sends every link to the smallest neighbour found so far, so
    the rounds grow with the logarithm of a component's diameter. The minimum per node is combined
    before its shuffle, and the joins back may be split by AQE, so a node with very many links is no
    bottleneck. Each round is a stored table.
    """
    spark = edges.sparkSession
    links, path = saved_at(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(least, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        old, (links, path) = path, saved_at(small, "links")
        remove(spark, old)
        before, state = state, _state(links)
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
