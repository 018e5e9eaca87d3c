"""Hard negatives by Kronecker-packed integer products.

Components become whole numbers and are biased to be non-negative, so an inner product of biased vectors is a sum of
non-negative terms with a known bound. That bound gives the width of a field, and as many candidates as fit
are packed beside each other into one wide number per component: multiplying it once by an anchor's component
multiplies all of them, no field ever carries into the next, and the exact scores are unpacked from the sum.
Wide numbers of up to 53 bits travel in doubles, which hold them exactly, so that the products run as matrix
products; components that leave no room for that are packed into Python's integers of any size.

The anchors are a stated query set, compared with all rows block by block: a block of anchors of bounded size is
broadcast, all rows stream past it where they lie, and each task keeps the best few per anchor. Only those
are shuffled. A first pass finds each anchor's positives, a second the negatives in each positive's window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.base import saved

SCALE, CLASSES = 256, 10
EVERY, RELABELLED = 100, 7  # anchors are rows whose vec_id is divisible by the one, moved labels by the other
POSITIVES, NEGATIVES, LEAST = 5, 5, 80  # per anchor; per positive; percent of the positive's score
BITS = 53  # of a whole number in a double
WIDE = 8  # candidates in one of Python's integers
BLOCK = 1 << 16  # anchors that are broadcast at once
BLOCK_BYTES = 1 << 26  # and at most so many bytes of components
TILE_ANCHORS, TILE_ROWS = 512, 4096  # scores in memory at once
LOW = np.iinfo(np.int64).min


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles, as int64 where all fit with room to add, else as Python integers."""
    if not vectors.size or np.abs(vectors).max() * scale < 2.0 ** 31:
        return np.floor(scale * vectors).astype(np.int64)
    exact = [int(x) * scale if abs(x) >= 2.0 ** 52 else int(np.floor(scale * x)) for x in vectors.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(vectors.shape)


def packed_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All exact inner products of whole-number vectors (anchors x rows)."""
    size = anchors.shape[1]
    bias_a, bias_b = -min(int(anchors.min()), 0), -min(int(rows.min()), 0)
    a, b = anchors + bias_a, rows + bias_b
    bound = max(sum(int(x) * int(y) for x, y in zip(a.max(axis=0), b.max(axis=0))), int(b.max()), 1)
    width = bound.bit_length()
    fields = BITS // width
    wide = not fields
    if wide:
        fields, a, b = WIDE, a.astype(object), b.astype(object)
    missing = -len(b) % fields
    if missing:
        b = np.concatenate([b, np.zeros((missing, size), dtype=b.dtype)])
    packed = sum(b[f::fields] * (1 << width * f) for f in range(fields))
    total = a @ packed.T if wide else (a.astype(np.float64) @ packed.astype(np.float64).T).astype(np.int64)
    out = np.empty((len(a), len(b)), dtype=total.dtype)
    for f in range(fields):
        out[:, f::fields] = (total >> width * f) & ((1 << width) - 1)
    out -= bias_b * a.sum(axis=1)[:, None] + bias_a * b.sum(axis=1)[None, :] - size * bias_a * bias_b
    return out[:, :len(rows)]


class Best:
    """The first ``k`` (score, id) of each of several lists, higher scores first, ties by smaller id."""

    def __init__(self, lists: int, k: int):
        self.k, self.lists = k, lists
        self.least = np.full(lists, LOW)  # no lower score can enter a list
        self.found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))  # list, score, id

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer scores (lists from ``first`` x rows); `LOW` stands for no candidate."""
        upto = first + len(scores)
        least = self.least[first:upto]
        good = (scores >= least[:, None]) & (scores != LOW)
        if good.sum() > 4 * self.k * len(scores) and scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
            good = (scores >= least[:, None]) & (scores != LOW)
        at, row = np.nonzero(good)
        if not len(at):
            return
        part = [np.concatenate(c) for c in zip(self.found, (at + first, scores[at, row], ids[row]))]
        order = np.lexsort((part[2], -part[1], part[0]))
        lists = part[0][order]
        place = np.arange(len(order)) - np.searchsorted(lists, lists)
        order = order[place < self.k]
        self.found = tuple(c[order] for c in part)
        lists, place = self.found[0], np.arange(len(order)) - np.searchsorted(self.found[0], self.found[0])
        full = place == self.k - 1
        self.least[lists[full]] = self.found[1][full]


def _clip(scores: np.ndarray) -> np.ndarray:
    """Scores as long; sums beyond its range, of enormous components, become its ends."""
    return scores if scores.dtype == np.int64 else np.array(
        [[min(max(s, LOW + 1), -(LOW + 1)) for s in row] for row in scores], dtype=np.int64).reshape(scores.shape)


def gathered(batches: Iterator[pa.RecordBatch], rows: int = TILE_ROWS) -> Iterator[pa.Table]:
    """Batches put together until they have so many rows."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(b.num_rows for b in kept) >= rows:
            yield pa.Table.from_batches(kept).combine_chunks()
            kept = []
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


@dataclass
class Anchors:
    """A block of anchors in order of their vectors' sizes: places in the block are positions in ``ids``."""

    ids: np.ndarray
    labels: np.ndarray
    matrices: dict[int, tuple[int, np.ndarray]]  # size: (place of the first, whole numbers)

    @classmethod
    def of(cls, table: pa.Table) -> Anchors:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("vec_id", "label", "vector"))), key=lambda r: (len(r[2]), r))
        matrices = {}
        for size, some in groupby(enumerate(rows), key=lambda r: len(r[1][2])):
            some = list(some)
            matrices[size] = (some[0][0], whole(np.array([r[2] for _, r in some], dtype=np.float64)))
        return cls(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), matrices)

    def tiles(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(anchors as a slice, scores, ids of rows, labels of rows) of rows (vec_id, label, vector), tile by tile.

        Vectors meet anchors of their own size only.
        """
        for table in gathered(batches):
            ids, labels = (table.column(i).to_numpy().astype(np.int64) for i in (0, 1))
            vectors = table.column(2).combine_chunks()
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for size, (first, matrix) in self.matrices.items():
                same = np.flatnonzero(sizes == size)
                for r in range(0, len(same), TILE_ROWS):
                    some = same[r:r + TILE_ROWS]
                    own = whole(flat[starts[some][:, None] + np.arange(size)])
                    for a in range(0, len(matrix), TILE_ANCHORS):
                        part = matrix[a:a + TILE_ANCHORS]
                        yield (slice(first + a, first + a + len(part)), _clip(packed_products(part, own)), ids[some], labels[some])


def sound_rows(vectors: DataFrame, relabelled: int = RELABELLED, classes: int = CLASSES) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, labels moved on where vec_id is divisible by ``relabelled``."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % relabelled == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return (vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0))
            .filter(F.coalesce(finite, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"),
                    F.col("embedding").cast("array<double>").alias("vector")))


def _first(rows: DataFrame, anchors: Anchors, windows: list, k: int) -> DataFrame:
    """The first ``k`` rows (window, place, rank, score, vec_id) of each anchor in each of its windows.

    ``windows`` is a list of (same label or not, least scores, most scores), bounds per anchor.
    """
    shared = rows.sparkSession.sparkContext.broadcast((anchors, windows))

    def work(batches):
        anchors, windows = shared.value
        best = [Best(len(anchors.ids), k) for _ in windows]
        for some, scores, ids, labels in anchors.tiles(batches):
            other = ids[None, :] != anchors.ids[some, None]
            same = labels[None, :] == anchors.labels[some, None]
            for kept, (alike, least, most) in zip(best, windows):
                fits = other & (same == alike) & (scores >= least[some, None]) & (scores <= most[some, None])
                if fits.any():
                    kept.add(some.start, np.where(fits, scores, LOW), ids)
        for i, kept in enumerate(best):
            place, score, vec_id = kept.found
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), i, np.int32)), *map(pa.array, (place, score, vec_id))],
                names=["window", "place", "score", "vec_id"])

    found = rows.mapInArrow(work, "window int, place long, score long, vec_id long")
    rank = F.row_number().over(Window.partitionBy("window", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _mine(rows: DataFrame, anchors: Anchors, positives: int, negatives: int, least: int) -> DataFrame:
    """Hard negatives of one block of anchors."""
    spark, size = rows.sparkSession, len(anchors.ids)
    everything = (np.full(size, LOW + 1), np.full(size, -(LOW + 1)))
    near = saved(_first(rows, anchors, [(True, *everything)], positives), "negatives-positives")
    low, high = (np.full((positives, size), end) for end in (-(LOW + 1), LOW + 1))  # windows of no score
    for r in near.select("place", "rank", "score").collect():  # so many per anchor of the block
        low[r.rank - 1, r.place], high[r.rank - 1, r.place] = -(-least * r.score // 100), r.score
    hard = _first(rows, anchors, [(False, low[i], high[i]) for i in range(positives)], negatives)
    ids = spark.createDataFrame(pa.table({"place": np.arange(size), "anchor_id": anchors.ids}))
    near = near.select("place", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
                       F.col("score").alias("positive_score")).join(ids, "place")
    return hard.join(near, ["place", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; other columns are not read. Rows with a NULL in one of them, an empty
    vector, or a NULL or non-finite component take no part; vectors of different sizes do not meet. Rows that repeat
    a vec_id are rows of their own, except that no row of an anchor's vec_id is one of its positives or negatives
    and that equal anchors are one. A positive with a score below zero has no negatives. Ties go to the smaller
    vec_id. Scores beyond the range of a long, of components above some 10^8, end there. An empty table, or one without
    anchors, gives an empty result.
    """
    rows = sound_rows(vectors)
    asked = saved(rows.filter(F.col("vec_id") % every == 0).distinct(), "negatives-anchors")
    count, size = asked.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    blocks = -(-count // max(1, min(block, BLOCK_BYTES // (8 * size)))) if count else 0
    number = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)) if blocks else None
    results = [saved(_mine(rows, Anchors.of(table), positives, negatives, least), "negatives")
               for g in range(blocks) if (table := asked.filter(number == g).toArrow()).num_rows]
    if not results:
        return rows.sparkSession.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, results)


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def negatives_query(spark, folder: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{folder}/embeddings.parquet"))


NEGATIVES_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM r a JOIN r c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
