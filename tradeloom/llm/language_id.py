"""Language identification by interpolated Kneser-Ney character models held in sorted hash arrays.

Each language has a character model of order `ORDER` over its words, padded with spaces, so that a
text's log probability is the sum over its words and a word that repeats is scored once in a worker. The
languages of a model share one sorted array of n-gram hashes per order with one column of interpolated log
probabilities per language; a lookup is a binary search, and n-grams that are not there back off by
the weight of their context. The language with the lowest cross-entropy per character is chosen.

Each text is scored once: calibration and decisions read the stored cross-entropies. Counting runs over all training texts in Spark, and all n-grams of all languages are kept, singletons too.
Languages are independent but for the number of letters, so they are divided into models of at most
`CELLS` (n-gram, language) cells, or of one language, and texts are scored by one model after the other:
a broadcast grows with the n-grams of one language at most, not with the languages. Calibration reads the
cross-entropies of all different training texts in Spark; a few numbers per language reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.base import held_out, remove, saved, saved_at

ORDER = 4
CELLS = 1 << 21
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
FALSE_REJECTS = 0.001
RANKS = 20_000  # a quantile's rank is off by at most one in so many
MARGIN = 2.5  # the rejection limit is this much beyond the calibrated quantile
FLUSH, REMEMBERED, SHORT = 200_000, 1 << 18, 40
UNDETERMINED = "und"

LETTERS = re.compile(r"[^\W\d_]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter at all."""
    found = LETTERS.findall((text or "").lower())
    return found if any(any(map(str.isalpha, w)) for w in found) else []


def hashes(codes: np.ndarray) -> np.ndarray:
    """One 64-bit hash per row of character codes."""
    out = np.full(len(codes), codes.shape[1], dtype=np.uint64)
    for i in range(codes.shape[1]):
        out = (out ^ codes[:, i].astype(np.uint64)) * _MIX[i % 4]
        out ^= out >> np.uint64(29)
    return out


def _runs(flat: np.ndarray):
    """Start and length of equal neighbours in a sorted array."""
    starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, int)
    return starts, np.diff(np.r_[starts, len(flat)])


@dataclass
class CharModel:
    """Sorted hash arrays per order: ``keys[k]`` with ``logs[k]``, ``contexts[k]`` with ``backoffs[k]``."""

    languages: list[str]
    keys: list = field(default_factory=list)
    logs: list = field(default_factory=list)
    contexts: list = field(default_factory=list)
    backoffs: list = field(default_factory=list)
    floor: float = 0.0

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each window, per language."""
        out = np.full((len(windows), len(self.languages)), self.floor)
        for k in range(1, windows.shape[1] + 1):
            part = windows[:, -k:]
            at, hit = _find(self.contexts[k - 1], hashes(part[:, :-1]) if k > 1 else np.zeros(len(part), np.uint64))
            out[hit] += self.backoffs[k - 1][at[hit]]
            at, hit = _find(self.keys[k - 1], hashes(part))
            out[hit] = self.logs[k - 1][at[hit]]
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """Log probability of each whole word with the space after it, per language."""
        if not words:
            return np.zeros((0, len(self.languages)))
        pad = " " * (ORDER - 1)
        codes = np.frombuffer("".join(f"{pad}{w} " for w in words).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.array([len(w) + 1 for w in words])
        starts = np.r_[0, np.cumsum(sizes + ORDER - 1)[:-1]]
        first = np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        out = np.zeros((len(words), len(self.languages)))
        word = np.repeat(np.arange(len(words)), sizes)
        for a in range(0, len(first), 1 << 18):
            part = first[a:a + (1 << 18)]
            logs = self.log_probabilities(codes[part[:, None] + np.arange(ORDER)])
            np.add.at(out, word[a:a + (1 << 18)], logs)
        return out


@dataclass
class Languages:
    """Models over all languages, in the order of their names, and what calibration found."""

    models: list[CharModel]
    sharpness: float = 10.0
    limits: dict = field(default_factory=dict)

    @property
    def languages(self) -> list[str]:
        return [lang for model in self.models for lang in model.languages]

    @property
    def floor(self) -> float:
        return self.models[0].floor


def _find(keys: np.ndarray, wanted: np.ndarray):
    if not len(keys):
        return np.zeros(len(wanted), int), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def train_model(rows: list[tuple[str, str, int]], letters: int | None = None) -> CharModel:
    """The model from (language, n-gram of `ORDER` characters, count).

    ``letters``: how many different characters all languages have, if ``rows`` are some of the languages only.
    """
    languages = sorted({r[0] for r in rows})
    model = CharModel(languages)
    grams = sorted({r[1] for r in rows})
    place = {g: i for i, g in enumerate(grams)}
    column = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(grams), len(languages)))
    for lang, gram, n in rows:
        counts[place[gram], column[lang]] += n
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), dtype=np.uint32).reshape(-1, ORDER)
    levels = []  # from the highest order down: codes, counts; below it, numbers of different left neighbours
    for k in range(ORDER, 0, -1):
        levels.append((codes, counts))
        if k > 1:
            shorter = codes[:, 1:]
            order = np.lexsort(shorter.T[::-1])
            packed = hashes(shorter)[order]
            starts, _ = _runs(packed)
            counts = np.add.reduceat((counts > 0)[order].astype(float), starts)
            codes = shorter[order][starts]
    letters = letters or len(levels[-1][0])
    model.floor = -float(np.log(letters + 1))
    for codes, counts in reversed(levels):
        k = codes.shape[1]
        n1, n2 = (counts == 1).sum(0), (counts == 2).sum(0)
        discount = np.where(n1 + n2 > 0, n1 / np.maximum(n1 + 2 * n2, 1), 0.5)
        discount = np.clip(discount, 0.1, 0.95)
        context = hashes(codes[:, :-1]) if k > 1 else np.zeros(len(codes), np.uint64)
        order = np.argsort(context, kind="stable")
        starts, lengths = _runs(context[order])
        total = np.add.reduceat(counts[order], starts)
        kinds = np.add.reduceat((counts[order] > 0).astype(float), starts)
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = np.where(total > 0, discount * kinds / np.maximum(total, 1e-9), 1.0)
            own = np.maximum(counts[order] - discount, 0) / np.maximum(np.repeat(total, lengths, 0), 1e-9)
        lower = model.log_probabilities(codes[:, 1:]) if k > 1 else np.full(counts.shape, model.floor)
        probability = own + np.repeat(backoff, lengths, 0) * np.exp(lower[order])
        model.contexts.append(context[order][starts])
        model.backoffs.append(np.log(backoff))
        keys = hashes(codes)[order]
        rank = np.argsort(keys)
        model.keys.append(keys[rank])
        model.logs.append(np.log(probability)[rank])
    return model


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts with a language: words are counted first, then their n-grams."""
    def flush(counter):
        pairs = list(counter)
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string()),
             pa.array(list(counter.values()), pa.int64())], names=["lang", "part", "n"])

    def words(batches):
        counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(words_of(text)).items():
                    counter[lang, word] += n
            if len(counter) > FLUSH:
                yield flush(counter)
                counter.clear()
        yield flush(counter)

    def grams(batches):
        counter = Counter()
        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                word = " " * (ORDER - 1) + word + " "
                for i in range(len(word) - ORDER + 1):
                    counter[lang, word[i:i + ORDER]] += n
            if len(counter) > FLUSH:
                yield flush(counter)
                counter.clear()
        yield flush(counter)

    kind = "lang string, part string, n bigint"
    each = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(words, kind)
    each = each.groupBy("lang", "part").agg(F.sum("n").alias("n"))
    return each.mapInArrow(grams, kind).groupBy("lang", "part").agg(F.sum("n").alias("n"))


def with_entropies(docs: DataFrame, model: Languages, keep_text: bool = True) -> DataFrame:
    """The rows with ``_nats`` (per language, per character; NULL without letters) and ``_chars``.

    Each of several models is a pass, whose result is stored for the next one.
    """
    names, path, last = docs.columns, None, len(model.models) - 1
    nats = F.col("_nats")
    for part in model.models[:last]:
        scored = _with_entropies(docs, part, True).select(*names, nats.alias("_before"))
        old, (docs, path) = path, saved_at(scored, "language-pass")
        if old:
            remove(docs.sparkSession, old)
        nats = F.concat("_before", "_nats")
    out = _with_entropies(docs, model.models[last], keep_text)
    return out.withColumn("_nats", nats).drop("_before") if last else out


def _with_entropies(docs: DataFrame, model: CharModel, keep_text: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")
    kept = [i for i in range(len(docs.columns)) if keep_text or i != place]

    def work(batches):
        model = shared.value
        known: dict[str, int] = {}
        table = np.zeros((0, len(model.languages)))
        for batch in batches:
            if len(known) > REMEMBERED:
                known.clear()
                table = table[:0]
            nats, chars = [], []
            texts = [words_of(t) for t in batch.column(place).to_pylist()]
            new = list({w for words in texts for w in words if len(w) <= SHORT and w not in known})
            known.update(zip(new, range(len(table), len(table) + len(new))))
            table = np.concatenate([table, model.words(new)])
            for words in texts:
                if not words:
                    nats.append(None)
                    chars.append(0)
                    continue
                at = [known[w] for w in words if len(w) <= SHORT]
                total = table[at].sum(axis=0)
                if len(at) < len(words):
                    total = total + model.words([w for w in words if len(w) > SHORT]).sum(axis=0)
                size = sum(map(len, words)) + len(words)
                nats.append((-total / size).tolist())
                chars.append(size)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(nats, pa.list_(pa.float64())), pa.array(chars, pa.int64())],
                names=[*(batch.schema.names[i] for i in kept), "_nats", "_chars"])

    return docs.mapInArrow(work, T.StructType([
        *(docs.schema[i] for i in kept), T.StructField("_nats", T.ArrayType(T.DoubleType())), T.StructField("_chars", T.LongType())]))


def grouped(sizes: list[tuple[str, int]], cells: int) -> list[list[str]]:
    """Languages, given with their numbers of n-grams, in groups whose models have at most so many cells or one language."""
    groups, grams = [], 0
    for lang, n in sorted(sizes):
        if groups and (grams + n) * (len(groups[-1]) + 1) <= cells:
            groups[-1].append(lang)
            grams += n
        else:
            groups.append([lang])
            grams = n
    return groups


def learn_languages(docs: DataFrame) -> Languages | None:
    """The models learned from all rows of ``docs`` with text and lang, not calibrated; None without any letters."""
    counted = saved(count_grams(docs), "language-grams")
    sizes = [(r.lang, r.n) for r in counted.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    if not sizes:
        return None
    letters = counted.select(F.substring("part", ORDER, 1)).distinct().count()
    model = Languages([])
    for langs in grouped(sizes, CELLS):
        table = counted.filter(F.col("lang").isin(langs)).toArrow()
        model.models.append(train_model(list(zip(*(c.to_pylist() for c in table.columns))), letters))
    return model


def fit_languages(docs: DataFrame) -> Languages | None:
    """The calibrated models learned from all rows of ``docs`` with text and lang; None without any letters."""
    model = learn_languages(docs)
    if model is not None:
        usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.xxhash64("text").alias("_text"), "text")
        scored = saved(with_entropies(usable, model, keep_text=False), "language-entropies")
        calibrate(model, different(scored))
    return model


def different(scored: DataFrame) -> DataFrame:
    """The scored texts (lang, ``_text``, ``_nats``, ``_chars``) that have letters, once per language."""
    return scored.filter("_nats IS NOT NULL").select("lang", "_text", "_nats", "_chars").dropDuplicates(["lang", "_text"])


def learn_and_identify(docs: DataFrame, learns: Column, keep_text: bool = True) -> DataFrame:
    """The rows with ``_language`` (lang_pred, score, rejected), learned from those rows where ``learns`` holds.

    Equal to `identify` with the model of `fit_languages`, but each text is scored once: the cross-entropies
    are stored, calibration reads those of the training texts, and the decisions all of them. Without
    ``keep_text`` the result has no text.
    """
    usable = learns & F.col("lang").isNotNull() & F.col("text").isNotNull()
    model = learn_languages(docs.filter(usable))
    names = [c for c in docs.columns if keep_text or c != "text"]
    if model is None:
        return docs.select(*names).withColumn("_language", undetermined())
    rows = docs.withColumns({"_learns": F.coalesce(usable, F.lit(False)), "_text": F.xxhash64("text")})
    scored = saved(with_entropies(rows, model, keep_text), "language-entropies")
    calibrate(model, different(scored.filter("_learns")))
    return scored.withColumn("_language", decision(model)).select(*names, "_language")


def calibrate(model: Languages, scored: DataFrame) -> None:
    """Set how sharply scores fall with cross-entropy, and the limit beyond which a language is rejected.

    ``scored``: lang, ``_nats`` and ``_chars`` of all different training texts. Sharpness maximises the
    likelihood of their languages. The limit of a language is the quantile of its rightly recognised texts'
    cross-entropies at the rate of false rejections, moved `MARGIN` times as far from their median; texts
    of few characters vary more, so their limit widens with 1 / sqrt(length). A language with fewer such texts
    than it takes to see that rate once gets no limit of its own.
    """
    column = {lang: i for i, lang in enumerate(model.languages)}
    names = F.array(*[F.lit(lang) for lang in model.languages])
    low = F.array_min("_nats")
    scored = (scored.withColumns({"own": F.array_position(names, F.col("lang")).cast("int"), "low": low})
              .filter("own > 0"))

    def likelihood(sharp: float) -> Column:
        weigh = F.aggregate("_nats", F.lit(0.0), lambda acc, x: acc + F.exp(-F.lit(sharp) * (x - F.col("low"))))
        return F.avg(-F.lit(sharp) * (F.element_at("_nats", F.col("own")) - F.col("low")) - F.log(weigh))

    means = scored.agg(*[likelihood(s) for s in SHARPNESS]).first()
    if means[0] is None:
        return
    model.sharpness = max(zip(means, SHARPNESS), key=lambda m: m[0])[1]
    right = scored.filter(F.array_position("_nats", F.col("low")) == F.col("own"))
    middles = {r.lang: r.middle for r in right.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("low", 0.5, RANKS).alias("middle")).collect()
        if r.n * FALSE_REJECTS >= 1}
    if not middles:
        return
    middle = F.element_at(F.array(*[F.lit(middles.get(lang, 0.0)) for lang in column]), F.col("own"))
    wide = (F.col("low") - middle) / (1 + 10 / F.sqrt(F.col("_chars").cast("double")))
    for r in (right.filter(F.col("lang").isin(list(middles))).groupBy("lang")
              .agg(F.percentile_approx(wide, 1 - FALSE_REJECTS, RANKS).alias("reach")).collect()):
        model.limits[r.lang] = (middles[r.lang], MARGIN * r.reach + 0.05)


def undetermined() -> Column:
    """What is decided without letters or without a model."""
    return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))


def decision(model: Languages) -> Column:
    """(lang_pred, score, rejected) from ``_nats`` and ``_chars``; see `identify`."""
    low = F.array_min("_nats")
    middle, reach = (F.array(*[F.lit(model.limits.get(lang, (None, None))[i]).cast("double") for lang in model.languages])
                     for i in (0, 1))
    best = F.array_position("_nats", low).cast("int")
    names = F.array(*[F.lit(lang) for lang in model.languages])
    weigh = F.aggregate("_nats", F.lit(0.0), lambda acc, x: acc + F.exp(-F.lit(model.sharpness) * (x - low)))
    far = (low - F.element_at(middle, best)) / (1 + 10 / F.sqrt(F.col("_chars").cast("double"))) > F.element_at(reach, best)
    far = F.coalesce(far, low > -model.floor)
    return F.when(F.col("_nats").isNotNull(), F.struct(
        F.element_at(names, best).alias("lang_pred"), (1 / weigh).alias("score"), far.alias("rejected"))).otherwise(undetermined())


def identify(docs: DataFrame, model: Languages | None) -> DataFrame:
    """The rows with ``lang_pred``, ``score`` (0 to 1) and ``rejected``; columns with these names are replaced.

    ``lang_pred`` is ``und`` with score 0 if the text is NULL or has no letter, or nothing was learned; such rows
    are rejected. A language without a limit of its own rejects only what it explains worse than equally likely
    characters do. Of equal cross-entropies the first language by name is taken. Very long texts are read whole.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    out = docs.withColumn("_language", undetermined()) if model is None else (
        with_entropies(docs, model).withColumn("_language", decision(model)))
    return out.select(*docs.columns, "_language.*")


def language_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id"), 5, 0))
    return learn_and_identify(docs, ~F.col("held_out"), keep_text=False).select("doc_id", "held_out", "_language.*")
