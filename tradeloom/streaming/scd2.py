"""Type-2 history kept up to date from a change stream, at a cost that follows the batch.

Under the root of a history, besides the manifest (see `segments`):

``log``       every change record, a segment per batch; the truth
``late``      per batch, the keys that received a record not newer than all their earlier ones
``versions``  per batch, the recomputed versions of the batch's keys
``open``      the open version of every key, in ``parts`` by key hash, each part in one of two slots
``work``      the records a batch's keys are recomputed from

The manifest also holds the number of parts and the current slot of each. A key with only newer records continues
from its open version. A late key is recomputed from the log and voids the versions earlier batches wrote for it;
they leave when their segments are merged. Only open rows of touched parts are rewritten, into the slot that
is not current, so nothing is read and replaced by the same plan and a batch that is repeated after a
failure reads what it read before. All folders must be on shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.scd2 import END, START, scd2_history
from tradeloom.session import STORED, remove_folder
from tradeloom.streaming.segments import FAN, Segments, Version

PARTS = 64  # choose so that the open versions of one part are some hundred MB
_SEEN = "_last_seen"


def _slots(version: Version) -> dict[int, int]:
    """The current slot of each part: at most ``parts`` entries."""
    return {int(part): slot for part, slot in version.settings.get("slots", {}).items()}


def _open_rows(spark: SparkSession, root: str, slots: dict[int, int]) -> DataFrame | None:
    """Open versions in the given slots; reads no other part."""
    if not slots:
        return None
    current = F.lit(False)
    for slot in (0, 1):
        current |= (F.col("_slot") == slot) & F.col("_part").isin(
            [p for p, s in slots.items() if s == slot])
    return spark.read.parquet(f"{root}/open").filter(current).drop("_slot")


def _part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.hash(*keys), F.lit(parts)).alias("_part")


def _standing(versions: DataFrame, late: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Versions without those that a later batch voided."""
    if late is None:
        return versions
    voids = late.groupBy(*keys).agg(F.max("batch_id").alias("_void_before"))
    return (versions.join(voids, list(keys), "left")
            .filter(F.col("_void_before").isNull() | (F.col("batch_id") >= F.col("_void_before"))).drop("_void_before"))


def scd2_apply(changes: DataFrame, keys: Sequence[str], sequence: str, tracked: Sequence[str],
               root: str, checkpoint: str, parts: int = PARTS, then: Sequence[str] = (), fan: int = FAN) -> StreamingQuery:
    """Start applying all available changes to the history under ``root``.

    Of records of a key with one ``sequence``, the last by the columns ``then`` counts; see `scd2_history`. A
    history keeps the number of ``parts`` it was begun with; another one is refused.
    """
    keys, tracked, then = list(keys), list(tracked), list(then)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = Segments(spark, root, fan)
        base = store.start(batch_id, parts=parts)
        number = F.lit(batch_id).cast("long").alias("batch_id")
        fresh = store.write(batch.select(*keys, sequence, *tracked, *then, number), "log", batch_id).drop("batch_id")
        news = fresh.groupBy(*keys, _part(keys, parts)).agg(
            F.min(sequence).alias("_first"), F.max(sequence).alias("_newest"))
        touched = [r._part for r in news.select("_part").distinct().collect()]  # at most ``parts`` rows
        if not touched:
            return
        # A key's records are the new ones and its open version, unless the log is needed below.
        slots = _slots(base)
        before = _open_rows(spark, root, {p: s for p, s in slots.items() if p in touched})

        records, written = fresh, ["log", "versions"]
        if before is not None:
            written.append("late")
            late = store.write(before.join(news, keys).filter(F.col("_first") <= F.col(_SEEN))
                               .select(*keys, number), "late", batch_id).drop("batch_id")
            continued = (before.join(news.select(*keys), keys, "left_semi")
                         .select(*keys, F.col(START).alias(sequence), *tracked))
            if late.isEmpty():
                records = fresh.unionByName(continued, allowMissingColumns=True)
            else:
                log = store.read("log", base).drop("batch_id").unionByName(fresh)
                records = (fresh.unionByName(continued, allowMissingColumns=True).join(late, keys, "left_anti")
                           .unionByName(log.join(late, keys, "left_semi").select(*fresh.columns)))
            records = store.write(records, "work", batch_id)
        versions = store.write(scd2_history(records, keys, sequence, tracked, then=then).withColumn("batch_id", number),
                               "versions", batch_id).drop("batch_id")

        rows = (versions.filter(F.col(END).isNull()).drop(END)
                .join(news.select(*keys, "_part", "_newest"), keys))
        if before is None:
            rows = rows.withColumnRenamed("_newest", _SEEN)
        else:
            seen = before.select(*keys, _SEEN)
            rows = (rows.join(seen, keys, "left")
                    .withColumn(_SEEN, F.greatest(_SEEN, "_newest")).drop("_newest")
                    .unionByName(before.join(news.select(*keys), keys, "left_anti")))
        # A part never seen starts in slot 0, a known one changes slots.
        target = {p: 1 - slots[p] if p in slots else 0 for p in touched}
        in_second = F.col("_part").isin([p for p, s in target.items() if s == 1])
        (rows.withColumn("_slot", F.when(in_second, 1).otherwise(0))
         .hint("rebalance", "_part").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_slot", "_part")
         .parquet(f"{root}/open", compression=STORED))

        base.settings["slots"] = {str(p): s for p, s in (slots | target).items()}
        late = store.read("late", base)
        if before is not None:
            own = store.read("late", base, [[batch_id, batch_id, 0]])
            late = own if late is None else late.unionByName(own)
        store.commit(batch_id, base, written, {
            "versions": lambda rows, low, high: _standing(rows, late, keys).hint("rebalance"),
            "late": lambda rows, low, high: rows.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))})
        remove_folder(spark, store.folder("work", batch_id, batch_id))

    return (changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_current(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """The open version of every key, with its start but without an end."""
    rows = _open_rows(spark, root, _slots(version or Segments(spark, root).version()))
    if rows is None:
        raise ValueError(f"no history under {root}")
    rows = rows.drop("_part", _SEEN)
    return rows.select(*(c for c in rows.columns if c != START), START)


def read_history(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """All versions of every key, as of the last batch that was committed."""
    store = Segments(spark, root)
    version = store.version()
    current = read_current(spark, root, version)
    closed = _standing(store.read("versions", version).filter(F.col(END).isNotNull()), store.read("late", version), keys)
    return closed.select(*current.columns, END).unionByName(
        current.withColumn(END, F.lit(None).cast("timestamp")))
