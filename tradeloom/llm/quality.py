"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a vector of hashed terms: its words, their shapes, how often words repeat, and its length.
Document frequencies over all texts weigh the terms, and the leading singular vectors of a bounded sample of
labelled texts span the latent space. The labelled vectors, at most `LABELLED`, are broadcast; every
document's cosines with all of them are exact products of blocks of rows, and the most similar ones vote with
the fourth power of their cosine.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.base import held_out

LABELLED = 4096  # labelled rows a model is fitted on, chosen by hash
DIMENSIONS, NEIGHBOURS = 32, 15
WORD_TERMS, SHAPE_TERMS, STATISTICS = 4096, 1024, 64
TERMS = WORD_TERMS + SHAPE_TERMS + STATISTICS
REMEMBERED, SHORT = 1 << 18, 64

_LETTERS, _DIGITS, _SAME = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1+")


def _case(m: re.Match) -> str:
    return "A" if m[0].isupper() else "a" if m[0].islower() else "Aa"


def shape(word: str) -> str:
    """Letters by case, digits as 9, other characters as they are; repeats shortened to two."""
    return _SAME.sub(r"\1\1", _DIGITS.sub("9", _LETTERS.sub(_case, word)))[:12]


def _terms_of(word: str) -> int:
    """The word's term and its shape's, as one number to base `TERMS`."""
    return (zlib.crc32(word.lower().encode()) % WORD_TERMS
            + TERMS * (WORD_TERMS + zlib.crc32(shape(word).encode()) % SHAPE_TERMS))


class Terms:
    """Term weights of texts; remembers the terms of short words, a bounded number of them."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def terms(self, word: str) -> int:
        found = _terms_of(word)
        if len(word) <= SHORT:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[word] = found
        return found

    def places(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Terms of the words and of their shapes."""
        known = self.seen.get
        codes = np.array([known(w) or self.terms(w) for w in counts], dtype=np.int64)
        return codes % TERMS, codes // TERMS

    def statistics(self, words: list[str], counts: Counter) -> list[tuple[int, float]]:
        """(term, weight) of the share of different words, of words said twice running, and of the length."""
        n = len(words)
        again = sum(map(eq, words, islice(words, 1, None)))
        at = WORD_TERMS + SHAPE_TERMS
        return [(at + int(10 * len(counts) / n), n * 0.5), (at + 16 + min(15, int(100 * again / n)), n * 0.2),
                (at + 32 + min(31, n.bit_length()), n * 0.1)]

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        """A row per text: log of each term's share; zero for texts without words."""
        out = np.zeros((len(texts), TERMS), dtype=np.float32)
        for row, text in zip(out, texts):
            words = (text or "").split()
            if not words:
                continue
            counts = Counter(words)
            times = np.fromiter(counts.values(), np.float64, len(counts))
            row += sum(np.bincount(p, weights=times, minlength=TERMS) for p in self.places(counts)).astype(np.float32)
            for at, weight in self.statistics(words, counts):
                row[at] = weight
            row *= 100 / len(words)
        return np.log1p(out, out=out)

    def add_presence(self, text: str | None, found: np.ndarray) -> None:
        """Count each term that the text has once."""
        words = (text or "").split()
        if not words:
            return
        counts = Counter(words)
        has = np.zeros(TERMS, dtype=bool)
        for places in self.places(counts):
            has[places] = True
        has[[at for at, _ in self.statistics(words, counts)]] = True
        found += has


@dataclass
class Voters:
    """Term weights, the projection to the latent space, and the labelled vectors there."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, matrix: np.ndarray) -> np.ndarray:
        out = (matrix * self.weights) @ self.projection
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors; the prior if none is similar."""
        cosines = self.latent(matrix) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, near, 1), 0, None).astype(float) ** 4
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.clip(np.where(total > 1e-12, votes / np.maximum(total, 1e-12), self.prior), 0, 1)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each term is, and how many there are; a row per term and task is moved."""
    def work(batches):
        terms, found, rows = Terms(), np.zeros(TERMS + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                terms.add_presence(text, found[:-1])
            found[-1] += batch.num_rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at])], names=["term", "n"])

    rows = docs.select("text").mapInArrow(work, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(TERMS + 1)
    for r in rows:
        out[r.term] = r.n
    return out[:-1], int(out[-1])


def leading(matrix: np.ndarray, dimensions: int, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    start = np.random.default_rng(0).standard_normal((matrix.shape[1], min(dimensions + 10, *matrix.shape)))
    basis = np.linalg.qr(start)[0].astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    small = matrix @ basis
    _, _, turn = np.linalg.svd(small, full_matrices=False)
    return (basis @ turn.T)[:, :dimensions].astype(np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Voters | None:
    """Voters from at most ``labelled`` rows of ``labels`` (doc_id, quality); None without any.

    ``docs`` are all documents: their texts give the term weights. A doc_id labelled more than once counts
    with its lowest label, one that stands for several texts with the smallest of them.
    """
    chosen = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
              .agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))

    def vectors(batches):
        terms = Terms()
        for batch in batches:
            rows = terms.matrix(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.flatnonzero(r) for r in rows], pa.list_(pa.int32())),
                 pa.array([r[np.flatnonzero(r)] for r in rows], pa.list_(pa.float32())), batch.column(1)],
                names=["at", "weight", "quality"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").cast("int").alias("quality"))
            .select("text", "quality").mapInArrow(vectors, "at array<int>, weight array<float>, quality int")
            .collect())  # at most ``labelled``, as many as were chosen
    if not rows:
        return None
    matrix = np.zeros((len(rows), TERMS), dtype=np.float32)
    for row, r in zip(matrix, rows):
        row[r.at] = r.weight
    known, total = document_frequencies(docs)
    weights = (np.log((1 + total) / (1 + known)) + 1).astype(np.float32)
    weighted = matrix * weights
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    labels_ = np.array([r.quality for r in rows], dtype=float)
    voters = Voters(weights, leading(weighted, DIMENSIONS), np.zeros(0), labels_, float(labels_.mean()))
    voters.vectors = voters.latent(matrix)
    return voters


def score_quality(docs: DataFrame, voters: Voters | None) -> DataFrame:
    """The rows with ``score`` (0 to 1) and ``predicted``; columns with these names are replaced.

    Only ``text`` is read. NULL, empty and blank texts, and all texts if nothing was learned, get the
    share of label 1 among the labelled rows (0.5 without any). Very long texts are read whole.
    """
    docs = docs.drop("score", "predicted")
    if voters is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    shared = docs.sparkSession.sparkContext.broadcast(voters)
    place = docs.columns.index("text")

    def work(batches):
        terms = Terms()
        for batch in batches:
            scores = shared.value.scores(terms.matrix(batch.column(place).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(work, f"{fields}, score double, predicted int")


def quality_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = held_out(F.col("doc_id"), 3, 1)
    voters = fit_quality(docs, labels.filter(~out).select("doc_id", "quality"))
    return score_quality(docs.withColumn("held_out", out), voters).select("doc_id", "held_out", "score", "predicted")
