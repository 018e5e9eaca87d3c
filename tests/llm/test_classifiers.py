"""Language identification and quality: held-out accuracy, probabilities, odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import docs_frame, odd_rows, prose
from pyspark.sql import functions as F

from tradeloom.llm import language_id
from tradeloom.llm.language_id import ORDER, fit_languages, identify, language_query, train_model
from tradeloom.llm.quality import NEIGHBOURS, TERMS, Terms, fit_quality, leading, quality_query, score_quality, shape

FOLDER = "/root/testdata/sf0.1"


def plain_kneser_ney(grams, letters):
    """Probability of a character after a context, by the textbook recursion on Python counters."""
    levels = {ORDER: Counter(grams)}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def discount(k):
        n1, n2 = (sum(v == n for v in levels[k].values()) for n in (1, 2))
        return min(max(n1 / (n1 + 2 * n2), 0.1), 0.95) if n1 + n2 else 0.5

    def p(context, c):
        k = len(context) + 1
        lower = p(context[1:], c) if context else 1 / (letters + 1)
        total = sum(v for g, v in levels[k].items() if g[:-1] == context)
        if not total:
            return lower
        d = discount(k)
        kinds = sum(g[:-1] == context for g in levels[k])
        return max(levels[k][context + c] - d, 0) / total + d * kinds / total * lower

    return p


def test_model_is_interpolated_kneser_ney():
    grams = {"a": Counter(), "b": Counter()}
    for lang, text in (("a", "the cat that sat on the mat"), ("b", "der die das dem den des dass")):
        for w in text.split():
            w = "   " + w + " "
            grams[lang].update(w[i:i + ORDER] for i in range(len(w) - ORDER + 1))
    for g in (" der", "   t"):
        grams["a"][g] += 5
    model = train_model([(lang, g, n) for lang, c in grams.items() for g, n in c.items()])
    union = {c for counts in grams.values() for g in counts for c in g[-1]}
    for i, lang in enumerate(model.languages):
        plain = plain_kneser_ney(grams[lang], len(union))
        for g in ["   t", "  th", "the ", "xxxt", " dez", "atde", "zzzz"]:
            got = np.exp(model.log_probabilities(np.array([[ord(c) for c in g]], dtype=np.uint32)))[0, i]
            assert got == pytest.approx(plain(g[:-1], g[-1]), rel=1e-9)
        total = sum(np.exp(model.log_probabilities(np.array([[ord(x) for x in "the"] + [ord(c)]], dtype=np.uint32)))[0, i]
                    for c in union)
        assert total <= 1 + 1e-9


def test_languages_held_out(spark):
    got = language_query(spark, FOLDER).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.995 * len(out)
    assert sum(r.rejected for r in got) <= 0.002 * len(got)
    assert len(got) == len(truth) and all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(spark):
    docs = docs_frame(spark, odd_rows()).withColumn("score", F.lit("x")).withColumn("n", F.lit(1))
    model = fit_languages(docs)
    out = identify(docs, model)
    got = out.collect()
    assert len(got) == len(odd_rows()) and out.columns.count("score") == 1
    for r in got:
        none = not any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == none and (r.score == 0) == none and (not none or r.rejected)
    right = [r for r in got if r.doc_id and r.doc_id >= 20]
    assert all(r.lang_pred == r.lang and not r.rejected for r in right)
    strange = docs_frame(spark, [(1, "привет как дела что нового сегодня", None, None), (2, "qzxj wvkq jjxz kqqw zzvx pqjx", None, None)])
    assert all(r.rejected for r in identify(strange, model).collect())
    assert identify(docs.limit(0), model).count() == 0
    assert fit_languages(docs.limit(0)) is None
    assert {(r.lang_pred, r.rejected) for r in identify(docs, None).collect()} == {("und", True)}


def test_rare_languages_keep_their_clean_documents(spark):
    """One row, a few rows and copies of one row tell no quantile; a language with many rows still has one."""
    rows = [(i, prose(i, 30), "en", "a") for i in range(1200)] + [(3000 + i, prose(5000, 30, "de"), "de", "a") for i in range(50)]
    rows += [(4000 + i, prose(6000 + i, 30, "de").translate(str.maketrans("aeiou", "áéíóú")), "xx", "a") for i in range(3)]
    model = fit_languages(docs_frame(spark, rows))
    assert set(model.limits) == {"en"}
    new = [(i, prose(7000 + i, 30, "de"), None, "a") for i in range(300)]
    new += [(300 + i, r[1].translate(str.maketrans("aeiou", "áéíóú")), None, "a") for i, r in enumerate(new)]
    new += [(900 + i, prose(9000 + i, 30), None, "a") for i in range(300)]
    got = identify(docs_frame(spark, new), model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["de"] * 300 + ["xx"] * 300 + ["en"] * 300
    assert sum(r.rejected for r in got if r.lang_pred != "en") == 0 and sum(r.rejected for r in got) <= 1


def test_no_language_is_crowded_out(spark, monkeypatch):
    """However few cells a model may have, every language keeps all its n-grams; results do not depend on it."""
    swap = {f"l{i:02d}": str.maketrans("aeiou", "".join(chr(0x430 + 5 * i + j) for j in range(5))) for i in range(6)}
    rows = [(i, prose(i, 60), "en", "a") for i in range(60)]
    rows += [(100 + i, prose(i, 60, "de").translate(t), lang, "a") for i, (lang, t) in enumerate(swap.items())]
    docs = docs_frame(spark, rows)
    got = []
    for cells in (1 << 21, 2000, 1):
        monkeypatch.setattr(language_id, "CELLS", cells)
        model = fit_languages(docs)
        assert model.languages == ["en", *swap]
        got.append({r.doc_id: (r.lang_pred, round(r.score, 9), r.rejected) for r in identify(docs, model).collect()})
    grams = {(r[2], f"   {w} "[j:j + ORDER]) for r in rows for w in r[1].split() for j in range(len(w) + 1)}
    assert len(model.models) == 7 and sum(len(m.keys[-1]) for m in model.models) == len(grams)
    assert got[0] == got[1] == got[2]
    assert all(got[0][r[0]][0] == r[2] for r in rows)


def test_quality_held_out(spark):
    got = {r.doc_id: r for r in quality_query(spark, FOLDER).collect()}
    labels = [r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if got[r.doc_id].held_out]
    right = [(got[r.doc_id].predicted == r.quality, r.quality) for r in labels]
    assert all(np.mean([x for x, q in right if q == v]) >= 0.97 for v in (0, 1))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())


def test_quality_of_odd_rows(spark):
    rows = odd_rows() + [(100 + i, " | ".join(prose(i).split()), "en", "a") for i in range(30)]
    docs = docs_frame(spark, rows).withColumn("predicted", F.lit("x")).withColumn("quality", F.lit("y"))
    labels = spark.createDataFrame([(20 + i, 1) for i in range(25)] + [(100 + i, 0) for i in range(25)]
                                   + [(20, 1), (None, 0), (21, None), (5, 7)], "doc_id bigint, quality int")
    voters = fit_quality(docs, labels)
    got = score_quality(docs, voters).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == 1 for r in got if r.doc_id in range(45, 50))
    assert all(r.predicted == 0 for r in got if r.doc_id in range(125, 130))
    assert {r.score for r in got if not (r.text or "").split()} == {voters.prior}
    assert score_quality(docs.limit(0), voters).count() == 0
    assert fit_quality(docs, labels.limit(0)) is None
    assert {r.score for r in score_quality(docs, None).collect()} == {0.5}


def test_votes_are_exact_neighbours(spark):
    rng = np.random.default_rng(0)
    wide = rng.standard_normal((60, 40)).astype(np.float32)
    kept = leading(wide, 10)
    _, _, exact = np.linalg.svd(wide, full_matrices=False)
    assert np.linalg.norm(wide @ kept) == pytest.approx(np.linalg.norm(wide @ exact[:10].T), rel=1e-2)


def test_votes_against_brute_force(spark):
    """Scores of all documents from all cosines in plain loops; repeated doc_ids do not crowd out labelled rows."""
    rows = [(i, prose(i, 40) if i % 2 else " | ".join(prose(i, 40).split()), "en", "a") for i in range(60)]
    docs = docs_frame(spark, rows + [(3, prose(500 + i, 40), "en", "a") for i in range(80)] + [(61, None, "en", "a")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    voters = [fit_quality(docs.repartition(n), labels, labelled=40) for n in (2, 5)]
    assert len(voters[0].labels) == 40 and sorted(voters[0].labels) == sorted(voters[1].labels)
    got = {(r.doc_id, r.text): r.score for r in score_quality(docs, voters[0]).collect()}
    assert got.keys() == {(r.doc_id, r.text) for r in docs.collect()}
    terms = Terms()
    for (doc_id, text), score in got.items():
        own = voters[0].latent(terms.matrix([text]))[0]
        cosines = sorted(((float(np.dot(own, v)), q) for v, q in zip(voters[0].vectors, voters[0].labels)), reverse=True)[:NEIGHBOURS]
        weights = [max(c, 0) ** 4 for c, _ in cosines]
        want = sum(w * q for w, (_, q) in zip(weights, cosines)) / sum(weights) if sum(weights) > 1e-12 else voters[0].prior
        assert score == pytest.approx(want, abs=1e-4), doc_id


def test_term_presence_is_that_of_the_weights():
    texts = [r[1] for r in odd_rows()] + ["a a a b", "Word! WORD!! word"]
    terms, found = Terms(), np.zeros(TERMS, dtype=np.int64)
    for text in texts:
        terms.add_presence(text, found)
    assert (found == (terms.matrix(texts) > 0).sum(axis=0)).all()


def test_shapes():
    assert [shape(w) for w in ("Word,", "WORD!!!", "a-b", "x12", "###")] == ["Aa,", "A!!", "a-a", "a9", "##"]
