"""Language-model scores: the marginal probability of a text over all its subword segmentations.

The pieces come from an existing public vocabulary. Its scores give the first weights; rounds of
expectation-maximisation over the words of all training documents turn them into log probabilities
of a unigram model. As no piece holds a space after another character, the segmentations of a text are the
products of those of its words: the forward recursion runs once per different word and not once per
occurrence.

Words that make up at least ``1 / HEAVY`` of all training tokens, at most ``HEAVY`` of them, are broadcast
and handled where a document is read. The other (document, word) pairs are counted there and meet the
table of words in one shuffled join.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.base import held_out, saved
from tradeloom.llm.pieces import MARK, MODEL, Lattice, Vocabulary, built, load_vocabulary, share

HEAVY = 1 << 16
ROUNDS, SMOOTHING = 2, 0.1
FLUSH = 200_000  # different words a task counts before it passes them on
ROWS = 50_000  # of a batch that a task passes on
END = b""  # the end of a text, counted like a word; no word is empty


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, a): occurrences in documents whose ``train`` is true, and in all; ends included."""
    def work(batches):
        train, every = Counter(), Counter()

        def flush():
            words = list(every)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64()),
                 pa.array(list(every.values()), pa.int64())], names=["word", "c", "a"])

        for batch in batches:
            for text, learn in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                words = _words(text)
                words.append(END)
                every.update(words)
                if learn:
                    train.update(words)
            if len(every) > FLUSH:
                yield flush()
                train.clear()
                every.clear()
        yield flush()

    return (docs.select("text", "train").mapInArrow(work, "word binary, c bigint, a bigint")
            .groupBy("word").agg(F.sum("c").alias("c"), F.sum("a").alias("a")))


def first_weights(vocabulary: Vocabulary, end: float) -> list[float]:
    """Log weights from the vocabulary's scores: a score is minus a rank, and use falls with the rank."""
    use = [1 / (2 - s) if i >= 0 else 0.0 for i, s in enumerate(vocabulary.scores)]
    least = min(use[i] for i in vocabulary.pieces.values())
    for i in vocabulary.byte_ids:
        use[i] = least
    ids = [*vocabulary.pieces.values(), *vocabulary.byte_ids]
    total = sum(use[i] for i in ids)
    return [math.log(u / total * (1 - end)) if u > 0 else -math.inf for u in use]


def _spelled(word: bytes) -> str:
    return MARK + word.decode(errors="replace")


def fit(words: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, smoothing: float = SMOOTHING):
    """(weights, log P(end)): expected piece counts over all training words, smoothed and normalised.

    What reaches the driver is one number per piece of the vocabulary.
    """
    spark = words.sparkSession
    learned = words.filter(F.col("c") > 0)
    ends = learned.filter(F.col("word") == F.lit(END)).agg(F.sum("c")).first()[0] or 0
    learned = learned.filter(F.col("word") != F.lit(END)).select("word", "c")
    ids = [*vocabulary.pieces.values(), *vocabulary.byte_ids]
    weights = first_weights(vocabulary, 0.01)
    log_end = math.log(0.01)
    for _ in range(rounds):
        shared = share(spark, (vocabulary, weights))

        def expect(batches, shared=shared):
            lattice = built(shared, Lattice)
            counts = [0.0] * len(lattice.weights)
            for batch in batches:
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    lattice.expected(_spelled(word), n, counts)
            used = [i for i, x in enumerate(counts) if x]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([counts[i] for i in used], pa.float64())],
                                             names=["piece", "uses"])

        uses = {r.piece: r.uses for r in learned.mapInArrow(expect, "piece int, uses double")
                .groupBy("piece").agg(F.sum("uses").alias("uses")).collect()}
        total = sum(uses.values()) + ends + smoothing * (len(ids) + 1)
        weights = [-math.inf] * len(weights)
        for i in ids:
            weights[i] = math.log((uses.get(i, 0.0) + smoothing) / total)
        log_end = math.log((ends + smoothing) / total)
        shared.unpersist()
    return weights, log_end


def with_log_probability(words: DataFrame, vocabulary: Vocabulary, weights, log_end: float) -> DataFrame:
    """The words with ``lattice``, the log probability over all segmentations."""
    shared = share(words.sparkSession, (vocabulary, weights))

    def work(batches):
        lattice = built(shared, Lattice)
        for batch in batches:
            scores = [lattice.log_probability(_spelled(w)) if w else log_end for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=["word", "c", "lattice"])

    return words.select("word", "c").mapInArrow(work, "word binary, c bigint, lattice double")


def lm_scores(docs: DataFrame, path: str = MODEL, rounds: int = ROUNDS, heavy: int = HEAVY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``.

    ``docs`` has doc_id, text and a boolean ``train``; other columns are not read. NULL and empty texts
    have only their end. Rows with equal doc_id and text, and their repeats, get equal scores. Without
    training documents all counts are zero and the weights are those of the vocabulary, smoothed.
    """
    spark = docs.sparkSession
    vocabulary = load_vocabulary(path)
    counted = saved(count_words(docs), "lm-words")
    row = counted.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long"))).first()
    tokens, known = row[0] or 0, row[1] or 0
    weights, log_end = fit(counted, vocabulary, rounds)
    words = saved(with_log_probability(counted, vocabulary, weights, log_end), "lm-scored")
    floor = max(1, -(-tokens // heavy))  # at most `heavy` words are this frequent
    top = {bytes(r.word): (r.c, r.lattice) for r in words.filter(F.col("c") >= floor).collect()}
    shared = spark.sparkContext.broadcast(top)
    below = math.log10(tokens + 0.5 * (known + 1)) if known else 0.0

    def base(c: int) -> float:
        return math.log10(c + 0.5) - below

    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        top = {w: (base(c), s) for w, (c, s) in shared.value.items()}
        schema = pa.schema([("doc_id", id_type[0]), ("h", pa.int64()), ("word", pa.binary()), ("n", pa.int64()),
                            ("copies", pa.int64()), ("out", pa.bool_()), ("tokens", pa.int64()),
                            ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

        def documents(batch):
            for doc_id, text, learn in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1).cast(pa.binary()),
                                                                    batch.column(2)))):
                h = xxhash.xxh3_64_intdigest(text or b"") - (1 << 63)
                found = Counter(_words(text))
                found[END] = 1
                n_known, base_sum, score = 0, 0.0, 0.0
                tokens = sum(found.values())
                for word in [w for w in found if w in top]:
                    n, hit = found.pop(word), top[word]
                    n_known += n
                    base_sum += n * hit[0]
                    score += n * hit[1]
                # under a key no word has, so that these rows are dealt out evenly
                own = b" %d %d" % (h, doc_id or 0)
                yield doc_id, h, own, not learn, tokens, n_known, base_sum, score, found

        def rows(some):
            """A row per document, then one for each of its words that is not broadcast."""
            count, words, times = [len(d[-1]) for d in some], [d[2] for d in some], [0] * len(some)
            for d in some:
                words.extend(d[-1].keys())
                times.extend(d[-1].values())
            others = sum(count)
            place = np.concatenate([np.arange(len(some)), np.repeat(np.arange(len(some)), count)])

            def own(i, kind, rest):
                return pa.concat_arrays([pa.array([d[i] for d in some], kind), rest])

            nothing, zero = pa.array(np.zeros(others, np.int64)), pa.array(np.zeros(others))
            whole = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in some], id_type[0]).take(pa.array(place)),
                 pa.array([d[1] for d in some], pa.int64()).take(pa.array(place)),
                 pa.array(words, pa.binary()), pa.array(times, pa.int64()),
                 pa.concat_arrays([pa.array(np.ones(len(some), np.int64)), nothing]), own(3, pa.bool_(), pa.nulls(others, pa.bool_())),
                 own(4, pa.int64(), nothing), own(5, pa.int64(), nothing), own(6, pa.float64(), zero),
                 own(7, pa.float64(), zero)], schema=schema)
            return [whole.slice(at, ROWS) for at in range(0, whole.num_rows, ROWS)]

        for batch in batches:
            id_type[0] = batch.schema.field(0).type
            schema = schema.set(0, pa.field("doc_id", id_type[0]))
            some, held = [], 0
            for document in documents(batch):
                some.append(document)
                held += len(document[-1]) + 1
                if held >= ROWS:
                    yield from rows(some)
                    some, held = [], 0
            if some:
                yield from rows(some)

    id_type = [pa.int64()]
    parts = docs.select("doc_id", "text", "train").mapInArrow(
        work, f"doc_id {kind}, h bigint, word binary, n bigint, copies bigint, out boolean, "
              "tokens bigint, known bigint, base double, score double")
    # the words' side has each word once, so its parts are even and far smaller: only they are held, nothing is sorted
    met = parts.join(words.filter(F.col("c") < floor).hint("shuffle_hash"), "word", "left")
    c, n = F.coalesce("c", F.lit(0)), F.col("n")
    per_text = met.groupBy("doc_id", "h").agg(
        F.sum("copies").alias("copies"), F.max("out").alias("held_out"), F.sum("tokens").alias("tokens"),
        F.sum(F.col("known") + F.when(c > 0, n).otherwise(0)).alias("known"),
        F.sum(F.col("base") + n * (F.log10(c + 0.5) - F.lit(below))).alias("base"),
        F.sum(F.col("score") + n * F.coalesce("lattice", F.lit(0.0))).alias("score"))
    each = per_text.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)")))
    return each.select(
        "doc_id", "held_out", F.expr("tokens div copies").alias("n_tokens"), F.expr("known div copies").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies") / math.log(10)).alias("score"))


def lm_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return lm_scores(docs.withColumn("train", ~held_out(F.col("doc_id"), 5, 1)))
