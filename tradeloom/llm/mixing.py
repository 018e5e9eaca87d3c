"""Mixing sources to target weights by hash-random order, prefix sums and an exact cut.

Every document has a pseudo-random key. Within a source the documents are taken in key order, whole
epochs first, and the last epoch ends at the word that meets the budget. The order is never sorted in
one place: keys are uniform, so equal ranges of keys are equal shares of a source. Word counts are summed
per (source, key range), the sums are accumulated over wide ranges, then over the ranges of the one wide
range in which a source's budget ends, and only the one range in which it ends is ordered key by key. What
comes out is one row per source (epochs, cut key, words before it), and each document's share follows from
comparing its key with the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.base import WORD, saved

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
SEED = "mix"
RANGE_DIGITS = 4  # key ranges of a source: 16 ** 4
WIDE_DIGITS = 2  # ranges of a source that are accumulated first: 16 ** 2


def size_of(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def key_of(doc_id: Column, seed: str = SEED) -> Column:
    """The document's place in the random order: 32 hexadecimal digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
                 .cast("binary"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) with ``target``: the share of all words, by weight, capped and reshared.

    Sources are taken by code point, NULL last, and get the weights in turn. With ``level`` words per
    unit of weight a source gets min(most * size, weight * level). Ordered by most * size / weight,
    the capped sources come first, so one pass over the sources (not the documents) finds the level.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    cap = F.lit(most) * F.col("source_size")
    ranked = (sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
              .withColumn("cap", cap.cast("double"))
              .withColumn("reach", F.col("cap") / F.col("weight")))
    order = Window.orderBy("reach", F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(everything)
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = ranked.withColumn("level", level).withColumn(
        "level", F.min(F.when(F.col("level") <= F.col("reach"), F.struct("reach", F.col("source").isNull(), "source", "level")))
        .over(everything)["level"])
    return levels.select("source", "source_size", F.when(F.col("reach") <= F.col("level"), F.col("cap"))
                         .otherwise(F.col("weight") * F.col("level")).alias("target"))


def cuts(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
         seed: str = SEED) -> DataFrame:
    """One row per source: target, whole ``epochs``, and where the last one is cut.

    ``cut_key`` is NULL when nothing is left over; ``cut_words`` of the ``cut_size`` words under that
    key are taken.
    """
    keyed = docs.select("source", key_of(F.col("doc_id"), seed).alias("key"),
                        size_of(F.col("text")).alias("size"))
    keys = saved(keyed.groupBy("source", "key").agg(F.sum("size").alias("size")), "mix-keys")
    ranges = saved(keys.groupBy("source", F.substring("key", 1, RANGE_DIGITS).alias("range"))
                   .agg(F.sum("size").alias("words")), "mix-ranges")
    plan = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    budget, whole = F.floor("target").cast("long"), F.col("source_size")
    plan = (plan.withColumn("epochs", F.when(whole > 0, F.expr("floor(target) div source_size"))
                            .otherwise(0).cast("long"))
            .withColumn("rest", budget - F.col("epochs") * whole))
    ranges = ranges.withColumn("wide", F.substring("range", 1, WIDE_DIGITS))
    wide = ranges.groupBy("source", "wide").agg(F.sum("words").alias("words"))
    ends = _end_part(_on_source(wide, plan.select("source", F.col("rest").alias("left"))), "wide")
    ends = _end_part(_on_source(ranges, ends.drop("words"), "wide"), "range")
    inside = _on_source(keys.withColumn("range", F.substring("key", 1, RANGE_DIGITS)), ends.drop("words"), "range")
    ends = _end_part(inside.withColumnRenamed("size", "words"), "key").select(
        "source", F.col("key").alias("cut_key"), F.col("words").alias("cut_size"), F.col("left").alias("cut_words"))
    # stored, so that Spark knows its size: a short list of sources is then no reason to shuffle documents
    return saved(_on_source(plan.drop("rest"), ends, how="left"), "mix-cuts")


def _end_part(parts: DataFrame, name: str) -> DataFrame:
    """Of each source's parts in order of ``name``, the one in which its ``left`` words end, and what is left there."""
    along = Window.partitionBy("source").orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    return (parts.withColumn("upto", F.sum("words").over(along))
            .filter("upto - words < left AND left <= upto")
            .select("source", name, "words", (F.col("left") - (F.col("upto") - F.col("words"))).alias("left")))


def _on_source(left: DataFrame, right: DataFrame, *also: str, how: str = "inner") -> DataFrame:
    """Join on source (NULL equals NULL) and more columns."""
    other = right.select(*[F.col(c).alias(f"_{c}" if c in ("source", *also) else c) for c in right.columns])
    on = left["source"].eqNullSafe(other["_source"])
    for c in also:
        on = on & (left[c] == other[f"_{c}"])
    return left.join(other, on, how).drop("_source", *[f"_{c}" for c in also])


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
        seed: str = SEED) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target``, ``epochs`` and ``taken`` (words).

    All columns of ``docs`` stay, except that columns with the names added here are replaced. A NULL
    text has size 0; a NULL source is a source of its own, last in order. Rows with equal doc_id (NULL
    included) share a place in the order; if the cut falls there, each takes its share of what is left,
    rounded down. An empty table gives an empty result. Reruns agree.
    """
    added = ["source_size", "target", "epochs", "cut_key", "cut_size", "cut_words"]
    plan = cuts(docs, weights, share, most, seed)
    out = docs.drop("size", "taken", "_mix_key", *added)
    out = (out.withColumn("size", size_of(F.col("text")))
           .withColumn("_mix_key", key_of(F.col("doc_id"), seed)))
    out = _on_source(out, plan, how="left")
    last = (F.when(F.col("_mix_key") < F.col("cut_key"), F.col("size"))
            .when(F.col("_mix_key") == F.col("cut_key"), F.expr("cut_words * size div cut_size"))
            .otherwise(0))
    return (out.withColumn("taken", F.col("epochs") * F.col("size") + last)
            .drop("_mix_key", "cut_key", "cut_size", "cut_words"))


def mixture(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
            seed: str = SEED) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each epoch of a document.

    The one document of a source in which its budget ends appears once more with just the words that
    are still due (its text up to there) and ``n_chars`` to match; documents without a word are in no
    epoch.
    """
    names = docs.columns
    mixed = mix(docs, weights, share, most, seed).filter("taken > 0")
    parts = F.expr("sequence(1L, taken div size + int(taken % size > 0))")
    rows = mixed.withColumn("_epoch", F.explode(parts)).withColumn(
        "_due", F.when(F.col("_epoch") * F.col("size") > F.col("taken"), F.col("taken") % F.col("size")))
    opening = F.expr(r"regexp_extract(text, concat('^(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){', _due, '}+'), 0)")
    rows = rows.withColumn("text", F.when(F.col("_due").isNull(), F.col("text")).otherwise(opening))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(F.col("_due").isNull(), F.col("n_chars"))
                               .otherwise(F.length("text").cast("long")))
    return rows.select(*names)


def mixing_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM d GROUP BY source),
r AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, CAST(2 * source_size AS DOUBLE) / weight AS reach FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY reach, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
      / CAST(sum(weight) OVER (ORDER BY reach, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lv
  FROM r),
f AS (SELECT lv FROM l WHERE lv <= reach ORDER BY reach, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN reach <= f.lv THEN cap ELSE weight * f.lv END AS target
  FROM l, f),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
o AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY k) AS BIGINT) AS upto,
         CAST(sum(size) OVER (PARTITION BY source, k) AS BIGINT) AS whole
  FROM d)
SELECT o.doc_id, o.size, p.source_size, p.target,
       CAST(p.epochs * o.size + CASE WHEN o.whole = 0 THEN 0 ELSE
         greatest(0, least(o.whole, CAST(floor(p.target) AS BIGINT) - p.epochs * p.source_size - (o.upto - o.whole)))
         * o.size // o.whole END AS BIGINT) AS taken
FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source
"""
