"""Embedding near-duplicates and nearest neighbours against all pairs."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_simhash import groups

from tradeloom.llm import ann, embedding_dedup
from tradeloom.llm.ann import nearest_neighbours
from tradeloom.llm.embedding_dedup import embedding_links, lattice_cells
from tradeloom.llm.vectors import packs

SCHEMA = "vec_id bigint, embedding array<float>, label int"
ODD = [(901, None), (902, []), (903, [0.0] * 16), (904, [1.0, None] + [0.0] * 14), (905, [float("nan")] * 16),
       (906, [float("inf")] + [0.0] * 15), (None, [1.0] * 16), (907, [1.0, 2.0]), (908, [2.0, 4.0])]


def vectors(seed, clusters, copies, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for centre, n in zip(rng.standard_normal((clusters, size)), itertools.cycle(copies)):
        rows += [(centre + rng.standard_normal(size) * 0.12).astype(np.float32).tolist() for _ in range(n)]
    rows += [rows[0]] * 30  # exact copies
    ids = random.Random(seed).sample(range(900), len(rows))
    return list(zip(ids, rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)


def sound(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("rows", [1, 5, 40, 1000])
def test_packs_divide_no_run(rows):
    pick = random.Random(rows)
    keys = sorted((pick.randrange(6), pick.randrange(3)) for _ in range(300)) + [(9, 9)] * 200
    batches, at = [], 0
    while at < len(keys):
        part = keys[at:at + pick.randrange(0, 30)]
        at += len(part)
        batches.append(pa.RecordBatch.from_arrays([pa.array([k[i] for k in part], pa.int64()) for i in (0, 1)], names=["a", "b"]))
    seen, whole = [], []
    for table, run in packs(iter(batches), 2, rows):
        mine = list(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))
        assert [x != y for x, y in zip(mine, mine[1:])] == [x != y for x, y in zip(run, run[1:])]
        seen += mine
        whole += sorted(set(mine))
    assert seen == keys and len(whole) == len(set(keys))


@pytest.mark.parametrize("block,few", [(embedding_dedup.BLOCK, embedding_dedup.FEW), (16, embedding_dedup.FEW), (16, 20),
                                       (embedding_dedup.BLOCK, 0)])
def test_links_against_all_pairs(spark, monkeypatch, block, few):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "FEW", few)
    rows = vectors(1, 40, [1, 3, 60, 8, 1])
    good = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in rows + [(907, [1.0, 2.0]), (908, [2.0, 4.0])]}
    near = {(a, b) for a, b in itertools.permutations(good, 2)
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9}
    roots = groups(sorted(good), lambda a, b: (a, b) in near)
    want = {i: (sum((i, j) in near for j in good), roots[i], roots[i] == i) for i in good}
    want |= {i: (0, i, i is not None) for i, v in ODD if i not in want}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_links(frame(spark, rows + ODD)).collect()}
    assert got == want


def test_links_of_repeated_rows_and_empty_tables(spark):
    rows = frame(spark, [(1, [1.0] * 8)] * 3 + [(2, [1.0] * 8), (3, [1.0] * 7 + [-1.0] * 1)])
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_links(rows.withColumn("n", F.lit("x"))
                                                                               .withColumn("root", F.lit(1))).collect())
    assert got == [(1, 3, 1)] * 3 + [(2, 3, 1), (3, 0, 3)]
    assert embedding_links(rows.limit(0)).count() == 0


def test_lattice_points_are_nearest():
    """Against all points of E8 around the origin, of norm up to 4 (doubled coordinates)."""
    rng = np.random.default_rng(3)
    even = np.array([p for p in itertools.product((-1, 0, 1), repeat=8) if sum(p) % 2 == 0]) * 2
    half = np.array([p for p in itertools.product((-1, 1), repeat=8) if sum(p) % 4 == 0])
    twos = np.array([s * 4 * np.eye(8, dtype=int)[i] for i in range(8) for s in (1, -1)])
    points = np.concatenate([even, half, twos])
    x = rng.uniform(-0.45, 0.45, (200, 8))
    got = lattice_cells(x, 1)[:, 0]
    best = ((points[None] / 2 - x[:, None]) ** 2).sum(axis=2).min(axis=1)
    assert np.allclose(((got / 2 - x) ** 2).sum(axis=1), best)
    assert all((g % 2 == g[0] % 2).all() and g.sum() % 4 == 0 for g in got)


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTORS", 64)
    monkeypatch.setattr(ann, "QUERIES", 8)
    rows = vectors(5, 30, [1, 40, 9, 20]) + [(1000 + i, np.full(16, 0.5, np.float32).tolist()) for i in range(200)]
    table = frame(spark, rows + ODD)
    got = {}
    for r in nearest_neighbours(table, table.filter("vec_id % 10 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    data = {i: np.array(v, float) for i, v in rows}
    hits = total = 0
    for q in (i for i in data if i % 10 == 0):
        want = sorted((math.sqrt(((data[q] - v) ** 2).sum()), i) for i, v in data.items() if i != q)[:10]
        assert [g[0] for g in got[q]] == list(range(1, 11))
        assert [(g[2], g[1]) for g in got[q]] == sorted((g[2], g[1]) for g in got[q])
        assert all(g[2] == pytest.approx(math.sqrt(((data[q] - data[g[1]]) ** 2).sum()), abs=1e-12) for g in got[q])
        hits += len({w[1] for w in want} & {g[1] for g in got[q]})
        total += 10
        if q >= 1000:
            assert [g[1] for g in got[q]] == [i for i in range(1000, 1011) if i != q][:10]
    assert hits >= 0.97 * total and set(got) == {i for i in data if i % 10 == 0}


@pytest.mark.parametrize("size", [64, 128])
@pytest.mark.parametrize("asked", [1, 7])
def test_scan_keeps_exact_copies(size, asked):
    """A limit of exactly zero meets partial distances of rotated vectors that differ in the last bits."""
    rng = np.random.default_rng(size + asked)
    turn = ann.orthonormal(size, size, ann.SEED)
    for _ in range(100):
        queries = rng.standard_normal((asked, size)).astype(np.float32).astype(float)
        vectors = np.concatenate([np.repeat(queries[:1], 30, axis=0), rng.standard_normal((200, size))])
        ids = rng.permutation(len(vectors))
        got = [f for f in ann.scan(queries, np.arange(1000, 1000 + asked), vectors, ids, turn) if f[0] == 1000]
        assert got == [(1000, int(i), 0.0) for i in sorted(ids[:30])[:10]]


def test_queries_probe_on_until_there_are_enough(spark):
    """With one list probed, a small and far cluster's list holds too few; an id with many near vectors is one."""
    rng = np.random.default_rng(4)
    rows = [(1000 + i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(600)]
    rows += [(i * 100, (50 + rng.standard_normal(8)).astype(np.float32).tolist()) for i in range(4)]
    rows += [(77, (50 + rng.standard_normal(8) * 0.5).astype(np.float32).tolist()) for _ in range(40)]
    table = frame(spark, rows)
    got = {}
    for r in nearest_neighbours(table, table.filter("vec_id < 1000 AND vec_id % 100 = 0"), probed=0.01).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 100, 200, 300} and all(len(set(g)) == 10 for g in got.values())
    assert all({77, 0, 100, 200, 300} - {q} == set(g[:4]) for q, g in got.items())


@pytest.mark.parametrize("confidence", [ann.CONFIDENCE, 1e6])
def test_scan_counts_ids_once(confidence):
    rng = np.random.default_rng(9)
    queries, vectors = rng.standard_normal((3, 64)), rng.standard_normal((500, 64))
    vectors[:60] = queries[0] + rng.standard_normal((60, 64)) * 0.01
    ids = np.r_[np.full(60, 5), np.arange(10, 450)]
    got = ann.scan(queries, np.array([1, 2, 3]), vectors, ids, ann.orthonormal(64, 64, ann.SEED), confidence=confidence)
    for q in range(3):
        best = {}
        for i, d in zip(ids, ((vectors - queries[q]) ** 2).sum(axis=1)):
            best[int(i)] = min(d, best.get(int(i), np.inf))
        mine = [f[1] for f in got if f[0] == q + 1]
        want = sorted(best, key=lambda i: (best[i], i))[:10]
        assert len(set(mine)) == 10 and len(set(mine) & set(want)) >= (10 if confidence > 100 else 7) and (q or mine[0] == 5)


def test_neighbours_of_small_and_empty_tables(spark):
    table = frame(spark, [(100, [1.0, 0.0]), (200, [0.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0])]).withColumn("list", F.lit(1))
    got = [(r.query_id, r["rank"], r.vec_id) for r in nearest_neighbours(table, table.filter("vec_id % 100 = 0"))
           .orderBy("query_id", "rank").collect()]
    assert got == [(100, 1, 3), (100, 2, 200), (200, 1, 3), (200, 2, 100)]
    assert nearest_neighbours(table.limit(0), table.limit(0)).count() == 0
    assert nearest_neighbours(frame(spark, ODD[:6]), frame(spark, ODD)).count() == 0


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in nearest_neighbours(table, table.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    data = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    ids, rows = np.array(sorted(data)), np.array([data[i] for i in sorted(data)])
    hits = 0
    for q in got:
        d = ((rows - data[q]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        hits += len(got[q] & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(got) and len(got) == sum(i % 100 == 0 for i in data)
