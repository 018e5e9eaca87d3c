import random

import xxhash
from llm_helpers import docs_frame, odd_rows, prose
from pyspark.sql import functions as F

from tradeloom.llm.base import components
from tradeloom.llm.simhash import near_links, simhash_groups


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {n: top(n) for n in nodes}


def near(a, b):
    return (a ^ b).bit_count() <= 2


def test_against_brute_force(spark):
    rows = odd_rows()
    pick = random.Random(5)
    for i in range(40):  # near copies: one word of a long text changed
        words = prose(i % 4, 400).split()
        words[pick.randrange(len(words))] = "changed"
        rows.append((100 + i, " ".join(words), "en", "a"))
    got = simhash_groups(docs_frame(spark, rows)).collect()
    prints = {t: plain_print(t) for t in {r[1] for r in rows}}
    classes = groups(sorted(set(prints.values())), near)
    ids = {}
    for r in rows:
        ids.setdefault(classes[prints[r[1]]], []).append(r[0])
    want = sorted(((r[0], f"{prints[r[1]]:016x}", min((x for x in ids[classes[prints[r[1]]]] if x is not None), default=None))
                   for r in rows), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want


def test_dense_posting_lists(spark):
    """Thousands of fingerprints in one list, and sparse ones: the same classes as all pairs give."""
    pick = random.Random(7)
    values = {pick.getrandbits(10) | 0xABC << 48 for _ in range(500)} | {pick.getrandbits(64) for _ in range(200)}
    base = pick.getrandbits(64)
    values |= {base ^ 1 << a ^ 1 << b for a in range(0, 64, 5) for b in range(0, 64, 7)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(4)
    roots = {r.node: r.root for r in components(near_links(frame)).collect()}
    want = groups(sorted(signed), lambda a, b: near(a % (1 << 64), b % (1 << 64)))
    assert {v: roots.get(v, v) for v in signed} == want


def test_components_of_chains_and_stars(spark):
    pick = random.Random(3)
    order = list(range(300))
    pick.shuffle(order)
    links = list(zip(order, order[1:])) + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(1, 300)} | {1000 + i: 1000 for i in range(1, 400)}
    assert got == want


def test_empty_and_clashing(spark):
    docs = docs_frame(spark, odd_rows())
    assert simhash_groups(docs.limit(0)).count() == 0
    clash = docs.withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1)).withColumn("root", F.lit(2))
    assert simhash_groups(clash).count() == docs.count()
