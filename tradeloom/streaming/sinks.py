"""Stored tables and the queries that append to them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.schemas import Table
from tradeloom.session import STORED
from tradeloom.sources.admission import EVERYTHING, Admission


def create_table(spark: SparkSession, path: str, table: Table) -> None:
    """Make sure the folder exists as an empty table, so that readers may start before writers."""
    try:
        spark.read.schema(table.ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([], table.ddl).write.mode("ignore").parquet(path)


def read_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    return spark.read.schema(table.ddl).parquet(path).select(*table.names)


def stream_table(spark: SparkSession, path: str, table: Table, admission: Admission = EVERYTHING) -> DataFrame:
    """Rows appended to a stored table, as a stream."""
    reader = admission.on(spark.readStream.schema(table.ddl))
    return reader.option("recursiveFileLookup", True).parquet(path)


def append_stream(df: DataFrame, path: str, table: Table, checkpoint: str,
                  partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Start appending all available rows to a table; columns are matched by name."""
    create_table(df.sparkSession, path, table)
    writer = df.select(*table.names).writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (writer.option("path", path).option("compression", STORED).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def flow_path(path: str, flow: str) -> str:
    return f"{path}/flow={flow}"


def append_flow(df: DataFrame, path: str, table: Table, flow: str,
                checkpoint: str) -> StreamingQuery:
    """Start one of several flows into one table.

    Two file sinks must not share a folder: each numbers its batches from zero in the folder's one
    log, and the second loses data. So each flow has a folder and a log of its own. Readers follow the log:
    a batch counts once it is in there, and the files of an attempt that failed are never read.
    """
    return append_stream(df, flow_path(path, flow), table, checkpoint)


def stream_flows(spark: SparkSession, path: str, table: Table, flows: Sequence[str],
                 admission: Admission = EVERYTHING) -> DataFrame:
    """Rows appended to a table by its flows, as one stream; each row is seen exactly once."""
    for flow in flows:
        create_table(spark, flow_path(path, flow), table)
    return reduce(DataFrame.unionByName, (stream_table(spark, flow_path(path, f), table, admission) for f in flows))


def read_flows(spark: SparkSession, path: str, table: Table, flows: Sequence[str]) -> DataFrame:
    """A table fed by flows, with the flow of each row."""
    for flow in flows:
        create_table(spark, flow_path(path, flow), table)
    return reduce(DataFrame.unionByName, (read_table(spark, flow_path(path, f), table).withColumn("flow", F.lit(f))
                                          for f in flows))


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries that run at the same time; if one fails, the others are stopped and it raises."""
    started = list(queries)
    try:
        for query in started:
            query.awaitTermination()
    except BaseException:
        for query in started:
            query.stop()
        raise


def publish(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> None:
    """Replace a stored table by a fully recomputed result.

    ``cluster_by`` lays rows out by range, so that readers with a range condition on these columns
    skip files and row groups. End it with a fine-grained column: a range cannot be cut inside one
    combination of values, and a single busy day would otherwise be one task.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)


def publish_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Replace a catalog table stored in buckets of ``keys``.

    Two tables bucketed alike on a join key join without a shuffle. Orders and order lines bucketed
    on ``order_id`` serve every revenue mart this way.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
