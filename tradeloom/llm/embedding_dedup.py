"""Near-duplicate embeddings by lattice hashing.

Equal vectors are one class with a multiplicity. In each of several tables the unit vector is projected
to eight random directions, scaled, and decoded to the nearest point of the E8 lattice: its home cell.
It also probes the neighbouring cells whose points come next. Two vectors are candidates if one's home is
the other's home or among the cells it probes, in some table; every candidate's cosine is computed. A
pair met in several ways counts where it is met first, which both vectors' cells tell.

Cells are worked in blocks of at most `BLOCK` members, so a crowded cell is many tasks; pairs are products
of blocks, and only sums per vector and the links of spanning forests leave a task. Most cells have a few
members; their pairs are compared many cells at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.base import components, saved
from tradeloom.llm.vectors import matrix, orthonormal, packs, usable

COSINE = 0.9
TABLES, PROBES, SCALE = 8, 6, 2.0
BLOCK = 1024
PACK = 8192  # rows of block pairs worked at a time
FEW = 4096  # pairs up to which a block pair is worked together with others
SEED = 8


def _coset(x: np.ndarray, shift: float):
    """Points of D8 + shift near x: the nearest, and others by rounding up to three coordinates off.

    Returns points (n, 4, 8) and squared distances (n, 4).
    """
    y = x - shift
    near = np.round(y)
    off = y - near
    order = np.argsort(-np.abs(off), axis=1, kind="stable")[:, :3]
    odd = (near.sum(axis=1).astype(np.int64) % 2 != 0)
    step = np.where(off >= 0, 1.0, -1.0)
    rows = np.arange(len(x))
    points = np.repeat(near[:, None, :], 4, axis=1)
    # a point of D8 has an even sum: an even number of flips if the rounded sum is even, else an odd one
    for slot, (even_flips, odd_flips) in enumerate((((), (0,)), ((0, 1), (1,)), ((0, 2), (2,)), ((1, 2), (0, 1, 2)))):
        for flips, chosen in ((even_flips, ~odd), (odd_flips, odd)):
            for f in flips:
                at = order[chosen, f]
                points[rows[chosen], slot, at] += step[chosen, at]
    return points + shift, ((points + shift - x[:, None, :]) ** 2).sum(axis=2)


def lattice_cells(x: np.ndarray, count: int) -> np.ndarray:
    """The E8 points nearest to each row, best first, doubled so that they are whole numbers."""
    whole, d0 = _coset(x, 0.0)
    half, d1 = _coset(x, 0.5)
    points, distances = np.concatenate([whole, half], axis=1), np.concatenate([d0, d1], axis=1)
    order = np.argsort(np.round(distances, 9), axis=1, kind="stable")[:, :count]
    return np.round(2 * np.take_along_axis(points, order[:, :, None], axis=1)).astype(np.int64)


def cells(units: np.ndarray, tables: int, probes: int, scale: float) -> np.ndarray:
    """Keys (n, tables, 1 + probes) of the home cell and the probed ones."""
    size = units.shape[1]
    width = max(size, 8)
    padded = np.pad(units, ((0, 0), (0, width - size)))
    out = np.empty((len(units), tables, 1 + probes), dtype=np.uint64)
    for t in range(tables):
        spread = scale * np.sqrt(width / 8)
        points = lattice_cells(padded @ orthonormal(width, 8, SEED + t).T * spread, 1 + probes).astype(np.uint64)
        key = np.full(points.shape[:2], t * 1000003 + size, dtype=np.uint64)
        for i in range(8):
            key = (key ^ points[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        out[:, t] = key
    return out.view(np.int64)


def _units(column: pa.Array) -> np.ndarray:
    rows = matrix(column)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of cell keys (n, tables, 1 + probes) with a < b: number of the first way they meet.

    Ways of table t: 3t common home, 3t + 1 b probes a's home, 3t + 2 a probes b's home.
    """
    home = a[:, :, 0] == b[:, :, 0]
    b_probes = (b[:, :, 1:] == a[:, :, :1]).any(axis=2)
    a_probes = (a[:, :, 1:] == b[:, :, :1]).any(axis=2)
    ways = np.stack([home, b_probes, a_probes], axis=2).reshape(len(a), -1)
    return ways.argmax(axis=1)


def _spanning(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric boolean matrix."""
    left = np.ones(len(adjacent), dtype=bool)
    links, waiting = [], []
    for at in range(len(adjacent)):
        if left[at]:
            left[at] = False
            waiting.append(at)
        while waiting:
            v = waiting.pop()
            new = np.flatnonzero(adjacent[v] & left)
            left[new] = False
            links += [(v, int(u)) for u in new]
            waiting += new.tolist()
    return links


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of the given links."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    links = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[p] = q
            links.append((x, y))
    return links


def _paired(left: np.ndarray, right: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row of ``left`` with every row of ``right`` in its run; both are in order of the runs."""
    start, end = (np.searchsorted(run[right], run[left], side) for side in ("left", "right"))
    n = end - start
    i = np.repeat(left, n)
    return i, right[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)]


def _close(units: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the pairs of rows reach the cosine."""
    out = np.empty(len(i), dtype=bool)
    step = max(1, (1 << 20) // units.shape[1])
    for at in range(0, len(i), step):
        part = slice(at, at + step)
        out[part] = np.einsum("ij,ij->i", units[i[part]], units[j[part]]) >= cosine
    return out


def _meet(rows: pa.Table, run: np.ndarray, tables: int, probes: int, scale: float, cosine: float, together: int):
    """Link counts and forest links of whole block pairs of cells.

    Rows have side (1: of the left block), home, cid, copies, tab and embedding, the vectors of one length;
    ``run`` numbers the block pairs; those of at most ``together`` pairs are compared together.
    """
    side, home, cid, copies, tab = (rows.column(c).to_numpy() for c in ("side", "home", "cid", "copies", "tab"))
    is_left, is_right = (side == 1) & home, side == 0
    pairs = np.bincount(run, is_left) * np.bincount(run, is_right)
    if not pairs.any():
        return None
    units = _units(rows.column("embedding").combine_chunks())

    def differ(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        # two homes are compared from the smaller id only; a vector is not compared with itself
        return np.where(home[j], cid[i] < cid[j], cid[i] != cid[j])

    few = (pairs <= together)[run]
    i, j = _paired(np.flatnonzero(is_left & few), np.flatnonzero(is_right & few), run)
    keep = differ(i, j)
    i, j = i[keep], j[keep]
    keep = _close(units, i, j, cosine)
    parts = [(i[keep], j[keep])]
    for many in np.flatnonzero(pairs > together):
        left, right = np.flatnonzero(is_left & (run == many)), np.flatnonzero(is_right & (run == many))
        i, j = np.nonzero(units[left] @ units[right].T >= cosine)
        i, j = left[i], right[j]
        keep = differ(i, j)
        parts.append((i[keep], j[keep]))
    met = np.concatenate([np.r_[i, j] for i, j in parts])
    if not len(met):
        return None
    used, sample = np.unique(cid[met], return_index=True)
    keys = cells(units[met[sample]], tables, probes, scale)
    counts = np.zeros(len(used), dtype=np.int64)
    links = []
    for number, (i, j) in enumerate(parts):
        here = np.where(home[j], 0, np.where(cid[i] < cid[j], 1, 2))
        a, b = np.searchsorted(used, cid[i]), np.searchsorted(used, cid[j])
        first = np.empty(len(i), dtype=np.int64)
        for at in range(0, len(i), 1 << 15):
            part = slice(at, at + (1 << 15))
            first[part] = _first_meeting(keys[np.minimum(a[part], b[part])], keys[np.maximum(a[part], b[part])])
        new = first == 3 * tab[i] + here
        i, j, a, b = i[new], j[new], a[new], b[new]
        np.add.at(counts, a, copies[j])
        np.add.at(counts, b, copies[i])
        if number == 0:
            links += _forest(cid[i], cid[j])
            continue
        ids, place = np.unique(np.r_[cid[i], cid[j]], return_inverse=True)
        adjacent = np.zeros((len(ids), len(ids)), dtype=bool)
        adjacent[place[:len(i)], place[len(i):]] = adjacent[place[len(i):], place[:len(i)]] = True
        links += [(ids[x], ids[y]) for x, y in _spanning(adjacent)]
    return used[counts > 0], counts[counts > 0], links


def embedding_links(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES,
                    scale: float = SCALE) -> DataFrame:
    """The rows with ``n_links``, ``component_id`` and ``kept``; columns with these names are replaced.

    ``vectors`` has vec_id and embedding. A row links with every other row found whose cosine reaches
    ``cosine``, copies included; ``component_id`` is the smallest vec_id reachable, itself included. Vectors
    that are NULL, zero, empty or hold NULL or non-finite components link with nothing, as do rows
    without a vec_id (their component_id is NULL and they are not kept). Vectors of different lengths are
    not compared. An empty table gives an empty result.
    """
    vectors = vectors.drop("n_links", "component_id", "kept")
    kept = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    classes = saved(kept.groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("cid", F.monotonically_increasing_id()), "vector-classes")

    def keyed(batches):
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(1)])
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                keys = cells(_units(part.column(1)), tables, probes, scale)
                n = len(keys)
                tab = np.broadcast_to(np.arange(tables)[None, :, None], keys.shape).ravel()
                home = np.broadcast_to(np.arange(1 + probes)[None, None, :] == 0, keys.shape).ravel()
                cid = np.repeat(part.column(0).to_numpy(), keys.shape[1] * keys.shape[2])
                for a in range(0, len(cid), 1 << 16):
                    b = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()[b]), pa.array(tab[b].astype(np.int32)), pa.array(home[b]), pa.array(cid[b])],
                        names=["cell", "tab", "home", "cid"])
                assert n == part.num_rows

    placed = saved(classes.select("cid", "embedding").mapInArrow(keyed, "cell bigint, tab int, home boolean, cid bigint"),
                   "vector-cells")
    busy = (placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("lived"))
            .filter("n > 1 AND lived").select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    members = placed.join(busy, "cell").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # left block i meets right block j: homes go to (own, every), all go to (every, own)
    every = F.expr("sequence(0, blocks - 1)")
    lefts = members.filter("home").select("cell", "tab", "home", "cid", F.lit(1).alias("side"), F.col("own").alias("i"), F.explode(every).alias("j"))
    rights = members.select("cell", "tab", "home", "cid", F.lit(0).alias("side"), F.explode(every).alias("i"), F.col("own").alias("j"))
    dealt = lefts.unionByName(rights).join(classes.select("cid", "copies", "embedding"), "cid")
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (dealt.select("cell", "i", "j", "side", "home", "cid", "copies", "tab", "embedding")
             .repartition(tasks, "cell", "i", "j").sortWithinPartitions("cell", "i", "j", "cid"))

    together = FEW

    def meet(batches):
        for pack, run in packs(batches, 3, PACK):
            sizes = pc.list_value_length(pack.column("embedding")).to_numpy()
            for size in np.unique(sizes):
                own = sizes == size
                found = _meet(pack if own.all() else pack.filter(pa.array(own)), run[own], tables, probes, scale, cosine, together)
                if found is None:
                    continue
                ids, counts, links = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*ids, *[a for a, _ in links]], pa.int64()), pa.array([*counts, *[0] * len(links)], pa.int64()),
                     pa.array([*[None] * len(ids), *[b for _, b in links]], pa.int64())], names=["a", "n", "b"])

    met = saved(dealt.mapInArrow(meet, "a bigint, n bigint, b bigint"), "vector-links")
    counts = met.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    roots = components(met.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cid")
    rooted = (classes.join(roots, "cid", "left").join(counts, "cid", "left")
              .select("embedding", "first", "copies", F.coalesce("root", "cid").alias("root"), F.coalesce("n", F.lit(0)).alias("n")))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    known = rooted.join(ids, "root").select("embedding", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = kept.join(known, "embedding").select(*vectors.columns, "n_links", "component_id")
    alone = (vectors.filter(~(usable(F.col("embedding")) & F.col("vec_id").isNotNull()))
             .select(*vectors.columns, F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def embedding_query(spark, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return embedding_links(vectors).select("vec_id", "n_links", "component_id", "kept")


# All pairs are few rows in the tables that SQL is run on; vectors there are usable and of one length.
EMBEDDING_SQL = """
WITH RECURSIVE
u AS (SELECT vec_id, list_transform(embedding, x -> CAST(x AS DOUBLE)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND list_bool_or(list_transform(embedding, x -> x <> 0))
        AND list_bool_and(list_transform(embedding, x -> x IS NOT NULL AND isfinite(x)))),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
r(vec_id, reach) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT p.b, r.reach FROM r JOIN p ON p.a = r.vec_id),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
