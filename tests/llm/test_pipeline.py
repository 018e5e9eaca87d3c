"""The pipeline's stages and their sum against plain versions."""

import random

import corpus_pipeline as pipeline
from llm_helpers import docs_frame, odd_rows, prose
from pyspark.sql import functions as F
from test_mixing import brute_force, size
from test_simhash import groups, near, plain_print

from tradeloom.llm.sentencepiece_codec import decode


def rows():
    pick = random.Random(8)
    out = odd_rows() + [(200 + i, prose(1000 + i, 50, "de" if i % 2 else "en"), "de" if i % 2 else "en", "abc"[i % 3])
                        for i in range(40)]
    out += [(300, f"{prose(77)} mail me a.b@c.example {prose(78)}", "en", "a")]
    out += [(400 + i, out[-1 - pick.randrange(20)][1], "en", "b") for i in range(10)]
    return out


def test_stages(spark):
    docs = docs_frame(spark, rows())
    one = pipeline.language_id(spark, docs, "")
    assert one.columns == docs.columns
    kept = [tuple(r) for r in one.collect()]
    assert all(any(map(str.isalpha, r[1])) for r in kept)
    clean = [r for r in rows() if r[1] and r[0] is not None and r[0] >= 20]
    assert {r[0] for r in clean} <= {r[0] for r in kept}

    two = pipeline.near_duplicates(spark, docs, "")
    assert two.columns == docs.columns
    prints = {r[1]: plain_print(r[1]) for r in rows()}
    classes = groups(sorted(set(prints.values())), near)
    members = {}
    for r in rows():
        members.setdefault(classes[prints[r[1]]], []).append(r)
    got = [(r.doc_id, r.text) for r in two.collect()]
    assert sorted(classes[prints[t]] for _, t in got) == sorted(members)
    for doc_id, text in got:
        assert doc_id == min((m[0] for m in members[classes[prints[text]]] if m[0] is not None), default=None)

    three = pipeline.personal_data(spark, docs, "")
    texts = {r.doc_id: r.text for r in three.collect()}
    assert three.count() == len(rows()) and "[EMAIL]" in texts[300] and "a.b@" not in texts[300]
    assert all(texts[r[0]] == r[1] for r in clean if r[0] != 300 and "a.b@" not in r[1])

    four = pipeline.mixing(spark, docs, "")
    want, _ = brute_force(rows())
    assert four.columns == docs.columns
    assert sum(size(r.text) for r in four.collect()) == sum(w[3] for w in want)

    five = pipeline.encoding(spark, docs, "")
    assert sorted(map(repr, (r.decoded for r in decode(five).collect()))) == sorted(repr(r[1]) for r in rows())


def test_whole_pipeline(spark, tmp_path):
    folder = str(tmp_path / "in")
    docs_frame(spark, rows()).write.parquet(f"{folder}/documents.parquet")
    out = pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "lang", "source", "n_pieces", "piece_score", "ids"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    by_hand = [repr(tuple(r)) for r in docs.collect()]
    assert sorted(by_hand) == sorted(repr(tuple(r)) for r in out.collect())
    assert len(pipeline.STAGES) == 5


def test_one_document_of_each_group_stays(spark):
    """A doc_id may stand for texts of several groups; the smallest of a group stays, whatever its other texts do."""
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [(7, a, "en", "x"), (3, a, "en", "x"), (7, b, "en", "x"), (9, b, "en", "x"), (9, c, "en", "x"), (9, c, "en", "x"),
            (None, a, "en", "x"), (None, None, None, None), (4, "", None, None)]
    for _ in range(2):
        got = pipeline.near_duplicates(spark, docs_frame(spark, rows), "").collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted([(3, a), (7, b), (9, c), (4, "")])


def test_own_columns_stay(spark):
    docs = docs_frame(spark, rows())
    own = ["score", "spans", "size", "_nats", "_text", "_key", "fp", "a.b", "epochs", "rejected", "seed"]
    extra = docs
    for name in own:
        extra = extra.withColumn(name, F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, extra, "")
        assert out.columns == extra.columns
        got = out.collect()
        assert all(r[name] == f"{name} {'none' if r.doc_id is None else r.doc_id}" for r in got for name in own)
        assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, (tuple(r) for r in stage(spark, docs, "").collect())))
    few = docs.select("doc_id", "text").dropDuplicates(["doc_id"])
    assert pipeline.near_duplicates(spark, few, "").columns == ["doc_id", "text"]


def test_empty_table(spark):
    docs = docs_frame(spark, rows()).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
    extra = docs_frame(spark, rows()).withColumn("fp", F.lit("x")).withColumn("size", F.lit("y")).withColumn("spans", F.lit("z"))
    for _, stage in pipeline.STAGES[:-1]:
        assert set(stage(spark, extra, "").columns) >= {"doc_id", "text", "lang", "source", "n_chars"}
