"""SimHash near-duplicates by an inverted index over byte positions with count filtering.

Two fingerprints of eight bytes that differ in at most ``d`` bits differ in at most ``d`` bytes, so they
share at least ``8 - d`` positional bytes: that is the guaranteed minimum. A list per single positional
byte would hold 1/256 of the corpus, so the postings are the combinations of ``8 - d`` positional bytes:
a pair is in a common list exactly if its tally of shared positional bytes reaches the minimum. A
list can hold at most ``256 ** d`` different fingerprints (65,536 for two bits), whatever the input.
Within a list the pairs are tallied and verified by their differing bits, and only the links of a
spanning forest leave it, fewer than the list has members.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.base import components, saved

SHINGLE, DISTANCE, SEED = 3, 2, 42
BYTES = 8
CHUNK = 1 << 16  # shingles whose bits are counted at a time


def _shingles(words: list[bytes], size: int):
    """Hashes of the shingles, chunk by chunk."""
    digest = xxhash.xxh64_intdigest
    text = b" ".join(words)
    if len(words) <= size:
        yield np.array([digest(text, SEED)], dtype=np.uint64)
        return
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    for at in range(0, len(words) - size + 1, CHUNK):
        last = min(at + CHUNK, len(words) - size + 1)
        yield np.array([digest(text[a:b - 1], SEED) for a, b in
                        zip(starts[at:last], ends[at + size - 1:last + size - 1])], dtype=np.uint64)


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, as an unsigned number; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    ones, total = np.zeros(64, dtype=np.int64), 0
    for hashes in _shingles(words, size):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        total += len(hashes)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed long."""
    def work(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t, size) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))],
                                             names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, fp bigint")


def _tallied(left: np.ndarray, right: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs share the guaranteed number of positional bytes and differ in few enough bits."""
    differ = left ^ right
    shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    return (shared >= BYTES - distance) & (np.bitwise_count(differ) <= distance)


def _close_pairs(prints: np.ndarray, distance: int):
    """Places of the pairs of a long list whose tally and bits hold; candidates come from looking up each
    fingerprint with up to so many of the list's free bits flipped, which misses none."""
    free = int(np.bitwise_or.reduce(prints ^ prints[0]))
    bits = [1 << b for b in range(64) if free >> b & 1]
    for n in range(1, distance + 1):
        for some in combinations(bits, n):
            other = prints ^ np.uint64(sum(some))
            at = np.minimum(np.searchsorted(prints, other), len(prints) - 1)
            found = np.flatnonzero((prints[at] == other) & (prints < other))
            found = found[_tallied(prints[found], prints[at[found]], distance)]
            yield from zip(found.tolist(), at[found].tolist())


def _forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over the verified pairs of one posting list."""
    size = len(prints)
    if size <= 64:
        left, right = np.triu_indices(size, 1)
        good = _tallied(prints[left], prints[right], distance)
        pairs = zip(left[good].tolist(), right[good].tolist())
    else:
        prints = np.sort(prints)
        pairs = _close_pairs(prints, distance)
    root = list(range(size))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for a, b in pairs:
        x, y = top(a), top(b)
        if x != y:
            root[x] = y
            links.append((a, b))
    signed = prints.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in links]


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fp`` within ``distance`` bits of each other."""
    keys = []
    for i, kept in enumerate(combinations(range(BYTES), BYTES - distance)):
        mask = sum(0xFF << 8 * b for b in kept)
        mask -= (1 << 64) if mask >> 63 else 0
        keys.append(F.struct(F.lit(i).cast("tinyint").alias("i"),
                             F.col("fp").bitwiseAND(F.lit(mask)).alias("k")))
    lists = (prints.select("fp", F.explode(F.array(*keys)).alias("key"))
             .groupBy("key").agg(F.collect_list("fp").alias("fps"))
             .filter(F.size("fps") > 1).select("fps"))

    def work(batches):
        for batch in batches:
            found = []
            for fps in batch.column(0):
                found += _forest(fps.values.to_numpy().view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                names=["a", "b"])

    return lists.mapInArrow(work, "a bigint, b bigint").distinct()


def simhash_groups(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (16 hex digits), component_id.

    Every row of ``docs`` gives a row. NULL and empty texts, and texts of white space, have fingerprint
    zero and link like any other. Texts with fewer words than a shingle are hashed whole. ``component_id``
    is the smallest doc_id reachable; NULL ids never are, unless a component has no other. Only doc_id
    and text are read; other columns do not matter. An empty table gives an empty result.
    """
    marked = saved(with_fingerprints(docs, size), "simhash")
    classes = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(near_links(classes, distance)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(groups, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return simhash_groups(docs).select("doc_id", "fingerprint", "component_id")
