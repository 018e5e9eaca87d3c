"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Whether a stream's progress tells how many rows its state holds; to know that, each write looks its key up once more.
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"

# Deletes a query's shuffle files when it ends. Otherwise they stay until the driver's memory is cleared, at most half an hour.
DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Whether tables laid out by some of the columns they are joined by are shuffled once more, by all of these.
SPREAD = "spark.sql.requireAllClusterKeysForCoPartition"
STORED = "zstd"  # compression of stored tables

# Settings every run needs for right results or bounded memory.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # a document that repeats a field must not stop the stream that reads it
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a task reads of a shuffle is merged up to this size. Distinct counts multiply each row before they are combined,
    # and packed rows grow thirtyfold in a hash map: a task's memory follows this size, not that of the tables.
    MERGED: "16m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a checkpoint of the state writes what changed, not the whole state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",  # a stream keeps the one it was begun with
}

# For batch queries, in sessions that set none of their own. A shuffle starts from so many parts, which are merged up to the
# size above: with few parts each would grow with the tables. Files are read in pieces, as map tasks sort what they send.
PIECES = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.files.maxPartitionBytes": "16m",
}
# Streams write a file for each piece they read, so theirs are larger; stored texts and tables grow severalfold when read.
STREAM_PIECES = {"spark.sql.files.maxPartitionBytes": "32m"}

# Settings for large inputs: start from many small shuffle partitions and let AQE merge them up to
# the advisory size, so the same code fits 1 GB and 100 TB without a hand-picked partition count.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "2000",  # also the number of streaming state partitions
    COUNTED: "false",
    DROPPED: "true",
}

_LOCAL_WORK: dict[str, str] = {}


def build_session(app_name: str = "tradeloom", master: str | None = None, cluster: bool = False,
                  **conf: str) -> SparkSession:
    """A session with the base settings; ``cluster=True`` adds the large-input ones."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(CLUSTER_CONF if cluster else {}), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, small_tasks: bool = True, small_pieces: bool = True) -> SparkSession:
    """Pin the settings results depend on in a session somebody else built, and, with ``small_tasks``, what a task reads
    of a shuffle, with ``small_pieces`` from many parts and pieces of files, without them in a stream's pieces; without
    ``small_tasks`` that is as the session was begun with."""
    for key, value in BASE_CONF.items():
        if key.startswith(("spark.sql.session.", "spark.sql.streaming.", "spark.sql.mapKey")):
            spark.conf.set(key, value)
    begun = spark.sparkContext.getConf()
    if small_tasks:
        spark.conf.set(MERGED, BASE_CONF[MERGED])
    elif spark.conf.get(MERGED) == BASE_CONF[MERGED]:
        spark.conf.set(MERGED, begun.get(MERGED, "64m"))
    wanted = (PIECES if small_pieces else STREAM_PIECES) if small_tasks else {}
    for key in PIECES:
        if not begun.contains(key):
            spark.conf.set(key, wanted[key]) if key in wanted else spark.conf.unset(key)
    return spark


@contextmanager
def state_partitions(spark: SparkSession, number: int):
    """Start streams with at most so many state partitions, whatever machine they start on, and rows of state uncounted.

    A stream keeps the number it first started with, so this is for short-lived streams over little data: more
    partitions than their state needs are overhead. Others take ``spark.sql.shuffle.partitions`` as it is.
    """
    key = "spark.sql.shuffle.partitions"
    before, counted = spark.conf.get(key), spark.conf.get(COUNTED, None)
    spark.conf.set(key, min(int(before), number))
    spark.conf.set(COUNTED, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)
        spark.conf.unset(COUNTED) if counted is None else spark.conf.set(COUNTED, counted)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting for the queries that are begun meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """Batch queries and streams begun meanwhile delete their shuffle files when they, or a stream's batch, end.

    For work that runs each plan once: what runs a plan again has to shuffle again.
    """
    return setting(spark, DROPPED, "true")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own: on a cluster the folder
    must be visible to every executor and survive the loss of any of them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        if context.applicationId not in _LOCAL_WORK:
            _LOCAL_WORK[context.applicationId] = tempfile.mkdtemp(prefix="tradeloom-")
        base = _LOCAL_WORK[context.applicationId]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of stored data that nothing refers to any more, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
