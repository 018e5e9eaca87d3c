"""Language-model scores and the piece codec against plain versions."""

import math
import random
import zlib
from collections import Counter
from functools import cache

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import docs_frame, odd_rows
from pyspark.sql import functions as F

from tradeloom.llm.base import held_out
from tradeloom.llm import pieces
from tradeloom.llm.lm_scoring import fit, count_words, first_weights, lm_scores
from tradeloom.llm.pieces import MARK, Lattice, built, load_vocabulary, share
from tradeloom.llm.sentencepiece_codec import Codec, decode, encode


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary()


def arcs_of(vocabulary, text, raw, weights, unknown):
    """(start, end, weight, ids) of every piece and every spelled character, by trying all parts."""
    out = []
    for a in range(len(text)):
        for b in range(a + 1, min(len(text), a + 20) + 1):
            if text[a:b] in vocabulary.pieces:
                i = vocabulary.pieces[text[a:b]]
                out.append((a, b, weights[i], (i,)))
        if text[a] not in vocabulary.pieces:
            ids = tuple(vocabulary.byte_ids[x] for x in raw[a].encode())
            out.append((a, a + 1, sum(weights[i] for i in ids) if unknown is None else unknown, ids))
    return out


def all_paths(arcs, size):
    @cache
    def upto(end):
        if end == 0:
            return [((), 0.0)]
        return [(ids + more, w + s) for a, b, w, more in arcs if b == end for ids, s in upto(a)]
    return upto(size)


def test_viterbi_is_the_best_of_all_segmentations(vocabulary):
    codec, pick = Codec(vocabulary), random.Random(4)
    parts = ["the", "ing", " ", "  ", "a", "é", "ß", "\r", ")", "\n", "😀", MARK, "￾", "x1", "Th"]
    for _ in range(300):
        raw = "".join(pick.choice(parts) for _ in range(pick.randrange(1, 5)))
        if len(raw) > 11:
            continue
        text = raw.replace(MARK, "￾").replace(" ", MARK)
        arcs = arcs_of(vocabulary, text, raw, vocabulary.scores, codec.unknown)
        ids, score = codec.best(raw)
        paths = all_paths(arcs, len(text))
        assert score == pytest.approx(max(s for _, s in paths))
        assert ids in [p for p, s in paths if s == pytest.approx(score)]
        if len(raw) > 2:  # cutting before spaces changes no score
            assert sum(s for _, s in codec.encode(raw)) == pytest.approx(codec.best(" " + raw)[1])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_decoding_restores_any_text(text):
    codec = _codec()
    ids = [i for unit, _ in codec.encode(text) for i in unit]
    assert codec.decode(ids) == text


@cache
def _codec():
    return Codec(load_vocabulary())


def test_codec_on_tables(spark):
    rows = odd_rows() + [(90, MARK + " literal " + MARK * 3, "en", "a"), (91, " lead  trail ", "en", "a")]
    docs = docs_frame(spark, rows).withColumn("ids", F.lit("clash")).withColumn("piece", F.lit(1))
    out = decode(encode(docs))
    got = out.collect()
    assert len(got) == len(rows) and all(r.decoded == r.text for r in got)
    assert all((r.ids is None) == (r.text is None) and (r.ids is None or len(r.ids) == r.n_pieces) for r in got)
    assert decode(encode(docs.limit(0))).count() == 0


def test_forward_recursion_sums_all_segmentations(vocabulary):
    pick = random.Random(9)
    weights = [math.log(pick.random()) - 8 for _ in vocabulary.scores]
    lattice = Lattice((vocabulary, weights))
    for word in ["▁the", "▁thing", "▁é1", "▁\r)", "▁😀a", "▁" + "ing" * 3, "▁x▁y"]:
        paths = all_paths(arcs_of(vocabulary, word, word, weights, None), len(word))
        assert lattice.log_probability(word) == pytest.approx(math.log(sum(math.exp(s) for _, s in paths)), abs=1e-9)
        counts = [0.0] * len(weights)
        lattice.expected(word, 2, counts)
        want, total = Counter(), sum(math.exp(s) for _, s in paths)
        for ids, s in paths:
            for i in ids:
                want[i] += 2 * math.exp(s) / total
        assert all(counts[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def train(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


@pytest.mark.parametrize("heavy", [8, 1 << 16])
def test_scores_against_a_plain_version(spark, vocabulary, heavy):
    rows = odd_rows()
    docs = docs_frame(spark, rows).withColumn("train", ~held_out(F.col("doc_id"), 5, 1)).withColumn("word", F.lit("w"))
    counts = Counter()
    for r in rows:
        if train(r[0]):
            counts.update([*(r[1] or "").encode().lower().split(), b""])
    total, different = sum(counts.values()), len(counts)
    weights, log_end = fit(count_words(docs), vocabulary)
    assert math.log(sum(math.exp(w) for w in weights if w > -math.inf) + math.exp(log_end)) == pytest.approx(0)
    lattice = Lattice((vocabulary, weights))

    def plain(doc_id, text):
        words = [*(text or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (different + 1))) for w in words)
        score = sum(lattice.log_probability(MARK + w.decode()) if w else log_end for w in words) / math.log(10)
        return (doc_id, not train(doc_id), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6), round(score, 4))

    got = lm_scores(docs, heavy=heavy).collect()
    assert sorted(((*r[:5], round(r[5], 6), round(r[6], 4)) for r in got), key=repr) == sorted(
        (plain(r[0], r[1]) for r in rows), key=repr)


def test_rare_words_meet_their_table_unsorted(spark, monkeypatch):
    """In batches smaller than a text has words; equal texts score alike."""
    monkeypatch.setattr("tradeloom.llm.lm_scoring.ROWS", 3)
    docs = spark.createDataFrame([(1, "a b c d e f g a", True), (2, None, True), (3, "a b c d e f g a", False)],
                                 "doc_id bigint, text string, train boolean")
    scores = lm_scores(docs, heavy=1)
    plan = scores._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    got = {r.doc_id: r for r in scores.collect()}
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in (got[1], got[2], got[3])] == [(9, 9, 10), (1, 1, 10), (9, 9, 10)]
    assert got[1].score == pytest.approx(got[3].score) and got[2].score > got[1].score


def test_empty_table(spark):
    docs = docs_frame(spark, odd_rows()).limit(0).withColumn("train", F.lit(True))
    assert lm_scores(docs).count() == 0


def test_learning_raises_held_out_scores(spark, vocabulary):
    rows = [(i, r[1], r[2], r[3]) for i, r in enumerate(odd_rows() * 2) if r[1] and len(r[1]) < 2000]
    docs = docs_frame(spark, rows).withColumn("train", F.col("doc_id") % 2 == 0)
    scores = [lm_scores(docs, rounds=n).filter("held_out").agg(F.sum("score")).first()[0] for n in (0, 1, 3)]
    assert scores[0] < scores[1] < scores[2]


def test_workers_follow_the_broadcast(spark):
    """A worker must not answer from an object it built of an earlier broadcast."""
    for i in range(30):
        shared = share(spark, i)

        def work(batches, shared=shared):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([built(shared, str)] * batch.num_rows)], names=["made"])

        made = spark.range(8, numPartitions=2).mapInArrow(work, "made string").collect()
        assert {r.made for r in made} == {str(i)}
        shared.destroy()


def test_plain_probabilities_equal_logarithms_and_give_way_to_them(vocabulary, monkeypatch):
    lattice = Lattice((vocabulary, first_weights(vocabulary, 0.01)))
    words = [MARK + w for w in ("a", "of", "segmentations", "x" * 20, "an" * 30)]
    long = MARK + "xq7" * 400

    def results(word):
        counts = [0.0] * len(lattice.weights)
        lattice.expected(word, 3, counts)
        return [lattice.log_probability(word), *counts]

    assert all(lattice._expected_of_short(w, 1, [0.0] * len(lattice.weights)) for w in words)
    assert not lattice._expected_of_short(long, 1, [])
    plain = [results(w) for w in [*words, long]]
    monkeypatch.setattr(pieces, "TINY", math.inf)
    for found, word in zip(plain, [*words, long]):
        assert found == pytest.approx(results(word), rel=1e-9, abs=1e-12)
