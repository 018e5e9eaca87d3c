"""Hard negatives against brute force with Python's integers."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tradeloom.llm import hard_negatives as hn

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType())])


def brute_force(rows):
    sound = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        sound.append((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for anchor in sorted(set(s for s in sound if s[0] % 100 == 0)):
        scored = sorted((-sum(a * b for a, b in zip(anchor[2], s[2])), s[0], s[1]) for s in sound
                        if s[0] != anchor[0] and len(s[2]) == len(anchor[2]))
        for p, pid, _ in [s for s in scored if s[2] == anchor[1]][:5]:
            fit = [s for s in scored if s[2] != anchor[1] and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(anchor[0], pid, k, nid, -p, -n) for k, (n, nid, _) in enumerate(fit, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], ROWS).repartition(3)


def random_rows(n, size, seed, scale=1.0):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((6, size))
    return [(int(i * 20), [float(x) for x in np.float32(scale * (centres[i % 6] + 0.4 * pick.standard_normal(size)) / size ** 0.5)],
             int(i % 4)) for i in range(n)]


@pytest.mark.parametrize("block", [2, hn.BLOCK])
def test_against_brute_force(spark, block):
    rows = random_rows(150, 16, 1)
    copies = [(i * 100 + 5, rows[0][1], 3) for i in range(40)]  # ties
    odd = [(1, None, 1), (2, [1.0, None] * 8, 1), (3, [math.nan] * 16, 1), (4, [math.inf] * 16, 1), (None, rows[1][1], 1),
           (6, rows[1][1], None), (8, [], 1), (100, rows[5][1], 1), (100, rows[5][1], 1), (100, rows[9][1], 2), (9, [0.0] * 16, 0),
           (200, [0.5, 0.25], 0), (33, [0.5, 0.3], 0), (34, [0.5, 0.25], 1), (300, [0.0] * 16, 5), (35, rows[3][1], 5)]
    got = hn.hard_negatives(table(spark, rows + copies + odd), block=block)
    assert sorted(map(tuple, got.collect())) == brute_force(rows + copies + odd)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_large_components(spark):
    """Components that leave no room for two fields, or none at all, in a double."""
    for scale in (1e4, 1e6):
        rows = random_rows(60, 4, 2, scale)
        assert sorted(map(tuple, hn.hard_negatives(table(spark, rows)).collect())) == brute_force(rows)
    beyond = hn.hard_negatives(table(spark, random_rows(60, 4, 2, 1e8))).collect()  # scores end at a long's range
    assert {r.positive_score for r in beyond} == {2 ** 63 - 1}


def test_empty(spark):
    assert hn.hard_negatives(table(spark, [(1, [1.0], 1)])).count() == 0
    out = hn.hard_negatives(table(spark, [(1, [1.0], 1)]).limit(0))
    assert out.count() == 0 and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.integers(1, 12), st.sampled_from([1, 300, 1 << 20, 1 << 30]), st.integers(0, 2 ** 32))
def test_products_are_exact(size, n, m, top, seed):
    pick = random.Random(seed)
    a, b = ([[pick.randint(-top, top) for _ in range(size)] for _ in range(k)] for k in (n, m))
    got = hn.packed_products(np.array(a, np.int64), np.array(b, np.int64))
    assert got.tolist() == [[sum(x * y for x, y in zip(r, s)) for s in b] for r in a]


def test_several_candidates_share_a_product():
    """Unit vectors leave room for two candidates in a double: the packed matrix has half the rows."""
    pick = np.random.default_rng(0)
    a, b = (hn.whole(v / np.linalg.norm(v, axis=1, keepdims=True)) for v in pick.standard_normal((2, 50, 64)))
    a, b = a - a.min(), b - b.min()
    width = max(int((a.max(axis=0) * b.max(axis=0)).sum()), 1).bit_length()
    assert hn.BITS // width == 2
