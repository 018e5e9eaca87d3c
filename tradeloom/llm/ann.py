"""Approximate nearest neighbours: inverted lists scanned by columns, with early abandoning.

Centroids fitted on a bounded sample divide all vectors into lists; a query probes the lists with the nearest
centroids. Within a list, queries and vectors are rotated at random, so that a squared distance over the
first columns, scaled up, estimates the whole. After each block of columns a hypothesis test abandons the
candidates whose estimate exceeds the query's current k-th distance by more than chance explains. The
survivors' distances are computed on the original vectors. Lists are worked in blocks of vectors and
blocks of queries, so a crowded list is many tasks, and a block returns at most k rows per query. A query
whose nearest lists hold too few vectors probes on until they hold k others.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.base import saved
from tradeloom.llm.vectors import matrix, orthonormal, runs, usable

NEAREST = 10
SAMPLE, LISTS, ROUNDS = 8192, 256, 8  # vectors the centroids are fitted on, most lists, k-means rounds
PROBED = 0.55  # share of the lists a query probes; vectors without clusters need about half for a recall of 0.9
COLUMNS = 16  # of a block
CONFIDENCE = 2.1  # standard errors a partial distance may be off before the candidate is abandoned
VECTORS, QUERIES = 4096, 512  # of a block of a list
ROUNDING = 1e-9  # of the squared norms: far above what rounding adds to a partial distance
SEED = 20


def fit_centroids(rows: np.ndarray, lists: int = LISTS, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from the sample's first different rows; at most a list for 16 vectors."""
    start = np.unique(rows, axis=0)
    count = max(1, min(lists, len(start) // 16 or 1))
    centroids = start[np.random.default_rng(SEED).permutation(len(start))[:count]]
    for _ in range(rounds):
        own = nearest_lists(rows, centroids, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        n = np.bincount(own, minlength=len(centroids))[:, None]
        centroids = np.where(n > 0, sums / np.maximum(n, 1), centroids)
    return centroids


def nearest_lists(rows: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    """The lists nearest to each row, nearest first."""
    distance = (centroids ** 2).sum(axis=1)[None, :] - 2 * rows @ centroids.T
    return np.argsort(distance, axis=1, kind="stable")[:, :count]


def scan(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, turn: np.ndarray,
         nearest: int = NEAREST, confidence: float = CONFIDENCE) -> list[tuple[int, int, float]]:
    """(query id, vector id, distance) of the nearest vectors to each query that the tests leave."""
    size = vectors.shape[1]
    turned_q, turned_v = queries @ turn.T, vectors @ turn.T
    norms_q, norms_v = (queries ** 2).sum(axis=1), (vectors ** 2).sum(axis=1)
    out = []
    # with up to n vectors of an id, the best n * nearest vectors are those of `nearest` ids at least
    bounding = nearest * int(np.unique(ids, return_counts=True)[1].max())
    for q, query_id in enumerate(query_ids):
        alive = np.flatnonzero(ids != query_id)
        partial = np.zeros(len(alive))
        limit = np.inf
        for at in range(0, size, COLUMNS):
            end = min(at + COLUMNS, size)
            partial += ((turned_v[alive, at:end] - turned_q[q, at:end]) ** 2).sum(axis=1)
            if end == size or len(alive) <= bounding:
                break
            # the exact distances of the candidates that look best bound the k-th distance
            best = np.argpartition(partial, bounding - 1)[:bounding]
            limit = min(limit, ((vectors[alive[best]] - queries[q]) ** 2).sum(axis=1).max())
            # rotated and original vectors round differently, so a limit of 0 must leave the exact copies
            slack = ROUNDING * (norms_q[q] + norms_v[alive])
            stays = partial * (size / end) <= limit * (1 + confidence / np.sqrt(end)) ** 2 + slack
            stays[best] = True
            alive, partial = alive[stays], partial[stays]
        distance = np.sqrt(((vectors[alive] - queries[q]) ** 2).sum(axis=1))
        order = np.lexsort((ids[alive], distance))
        first = np.sort(np.unique(ids[alive][order], return_index=True)[1])  # an id's nearest vector
        order = order[first[:nearest]]
        out += [(int(query_id), int(ids[alive[o]]), float(distance[o])) for o in order]
    return out


def lists_to_probe(near: np.ndarray, held: np.ndarray, count: int, needed: int) -> list[np.ndarray]:
    """Of each row's lists, nearest first, the first ``count``, and as many more as it takes to hold ``needed`` vectors."""
    enough = (np.cumsum(held[near], axis=1) < needed).sum(axis=1) + 1
    return [row[:n] for row, n in zip(near, np.maximum(enough, count))]


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, probed: float = PROBED,
                       lists: int = LISTS, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance): the nearest found for each query.

    Both tables have vec_id and embedding; other columns are not read. A query's candidates are all rows
    with another vec_id. Ties go to the smaller vec_id. Rows with NULL id, vectors that are NULL, empty, zero or
    hold NULL or non-finite components, and vectors whose length is not the most common one take no
    part. Repeated rows are one; if an id has several vectors, its nearest counts. A query gets all ids there are, if
    fewer than ``nearest``. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    fields = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")]

    def sound(df: DataFrame) -> DataFrame:
        return df.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(*fields)

    sized = sound(vectors).groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if sized is None:
        return spark.createDataFrame([], schema)
    size = sized["size"]
    rows = sound(vectors).filter(F.size("embedding") == size).distinct()
    asked = sound(queries).filter(F.size("embedding") == size).distinct()
    sample = rows.orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).select("embedding").collect()
    centroids = fit_centroids(np.array([r.embedding for r in sample]), lists)
    shared = spark.sparkContext.broadcast((centroids, orthonormal(size, size, SEED)))

    def listed(df: DataFrame, choose) -> DataFrame:
        def work(batches):
            for batch in batches:
                near = choose(nearest_lists(matrix(batch.column(1)), shared.value[0], len(shared.value[0])))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([row.astype(np.int32) for row in near], pa.list_(pa.int32()))],
                    names=["vec_id", "embedding", "lists"])
        return (df.mapInArrow(work, "vec_id bigint, embedding array<double>, lists array<int>")
                .select("vec_id", "embedding", F.explode("lists").alias("list")))

    placed = saved(listed(rows, lambda near: near[:, :1]), "ann-lists")
    # an id counts in one list only, so lists that hold `nearest` + 1 hold as many ids besides the query's own
    held_ids = np.zeros(len(centroids), dtype=np.int64)
    for r in placed.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():  # a row per list
        held_ids[r["list"]] = r["count"]
    count = max(1, math.ceil(probed * len(centroids)))
    probing = saved(listed(asked, lambda near: lists_to_probe(near, held_ids, count, nearest + 1)), "ann-queries")
    # blocks per list, from counts of its vectors and queries
    held = placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / VECTORS).cast("int").alias("v_blocks"))
    asks = probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("q_blocks"))
    blocks = F.broadcast(held.join(asks, "list"))  # a row per list, at most `lists`
    own = F.xxhash64("vec_id", "embedding")
    left = (placed.join(blocks, "list").withColumn("v", F.pmod(own, F.col("v_blocks")).cast("int"))
            .withColumn("q", F.explode(F.expr("sequence(0, q_blocks - 1)"))).withColumn("asks", F.lit(0)))
    right = (probing.join(blocks, "list").withColumn("q", F.pmod(own, F.col("q_blocks")).cast("int"))
             .withColumn("v", F.explode(F.expr("sequence(0, v_blocks - 1)"))).withColumn("asks", F.lit(1)))
    both = left.unionByName(right).select("list", "v", "q", "asks", "vec_id", "embedding")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(tasks, "list", "v", "q").sortWithinPartitions("list", "v", "q")

    def work(batches):
        for group in runs(batches, 3):
            asks = group.column("asks").to_numpy() == 1
            if asks.all() or not asks.any():
                continue
            ids, values = group.column("vec_id").to_numpy(), matrix(group.column("embedding").combine_chunks())
            found = scan(values[asks], ids[asks], values[~asks], ids[~asks], shared.value[1], nearest, confidence)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.float64())], names=["query_id", "vec_id", "score"])

    found = (both.mapInArrow(work, "query_id bigint, vec_id bigint, score double")
             .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
            .select("query_id", "rank", "vec_id", "score"))


def ann_query(spark, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"))
