"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are learned without labels.

Each rule looks at one measure of a text and votes good, bad or nothing. Whether a text is good is a hidden class.
Expectation-maximisation estimates, from how the rules agree over all documents, how common good texts are and
how often each rule is right on good and on bad ones; the posterior probability of the class then decides, so a
weak rule is outvoted and a strict one decides alone. No single rule removes a document.

Votes are few: all documents are summed up as counts of the different combinations of votes, at most 3 to
the number of rules, and every round of the estimation is an aggregate over that stored table. A handful of numbers
per rule reaches the driver. Everything is written with DataFrame functions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.base import SPACE, saved

WINDOW = 5  # words whose repetition counts
FEW_WORDS, MOST_REPEATED = 10, 20  # words; percent of words
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
ROUNDS = 30
# Where the estimation starts: a bad text breaks some of the rules, a good one hardly any, and most texts are good.
RIGHT_ON_GOOD, RIGHT_ON_BAD, COMMON = 0.99, 0.3, 0.8
PRIOR = 10.0  # votes that the start is worth
KEEP = 0.5

GOOD, BAD, NONE = 1, -1, 0


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in windows found twice or more.

    Windows are compared by 64-bit hashes. Only a text in which some repeat is sorted: equal hashes are then
    neighbours, and the words of the windows marked so are counted along their places.
    """
    size = F.size(words) - window + 1

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda at, i: F.least(
            F.lit(window), F.coalesce(F.get(places, i + 1) - at, F.lit(window))).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    def marked(pairs: Column) -> Column:
        def twice(pair: Column, i: Column) -> Column:
            return (F.coalesce(F.get(pairs, i - 1)["h"] == pair["h"], F.lit(False))
                    | F.coalesce(F.get(pairs, i + 1)["h"] == pair["h"], F.lit(False)))
        return F.array_sort(F.transform(F.filter(pairs, twice), lambda pair: pair["at"]))

    def counted(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(let(pairs, marked), covered))

    def windows(each: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.xxhash64(*[F.get(each, i + k) for k in range(window)]))

    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(size > 0, let(hashed, counted)).otherwise(F.lit(0).cast("long"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_lettered",
            "n_letters", "n_capitals", "n_shouts", "n_mark_runs")


def measures(text: Column) -> Column:
    """What the rules look at, as one struct of longs.

    n_words, word_chars (their code points), n_symbols, n_dup_lines (lines with a word equal to an earlier one),
    n_repeat_words, n_lines (with a word), n_distinct (words), n_lettered (words with a letter), n_letters, n_capitals,
    n_shouts (exclamation marks), n_mark_runs (two or more characters in a row that are neither letters nor numbers). All
    are 0 for NULL.
    """
    def of(text: Column) -> Column:
        words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))

        def counted(words: Column, lines: Column) -> Column:
            found = {
                "n_words": F.size(words), "word_chars": F.length(without(text, SPACES)),
                "n_symbols": F.length(text) - F.length(without(text, SYMBOLS)),
                "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": repeated_words(words),
                "n_lines": F.size(lines), "n_distinct": F.size(F.array_distinct(words)),
                "n_lettered": F.regexp_count(text, F.lit(rf"\p{{L}}[^{SPACE}]*+")),
                "n_letters": F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", "")),
                "n_capitals": F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", "")),
                "n_shouts": F.length(text) - F.length(without(text, "!")),
                "n_mark_runs": F.regexp_count(text, F.lit(rf"[^\p{{L}}\p{{N}}{SPACE}]{{2,}}+"))}
            return F.struct(*[found[m].cast("long").alias(m) for m in MEASURES])

        return let(words, lambda words: let(lines, lambda lines: counted(words, lines)))

    return let(F.coalesce(text, F.lit("")), of)


@dataclass(frozen=True)
class Rule:
    """Votes by a share of two measures: bad or good where the condition on ``share`` holds, else nothing."""

    name: str
    part: str
    whole: str
    bad: str
    good: str

    def vote(self) -> Column:
        share = f"try_divide(CAST({self.part} AS DOUBLE), {self.whole})"
        bad, good = (re.sub(r"\bshare\b", share, c) for c in (self.bad, self.good))
        return F.expr(f"CASE WHEN {bad} THEN {BAD} WHEN {good} THEN {GOOD} ELSE {NONE} END")


RULES = (
    Rule("length", "n_words", "1", "share < 10", "share >= 30"),
    Rule("word_length", "word_chars", "n_words", "share < 3 OR share > 8", "share BETWEEN 3.5 AND 6.5"),
    Rule("symbols", "n_symbols", "n_words", "share > 0.1", "share <= 0.01"),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", "share > 0.3", "share = 0 AND n_lines > 1"),
    Rule("repeated_words", "n_repeat_words", "n_words", "share > 0.2", "share <= 0.05 AND n_words >= 10"),
    Rule("distinct_words", "n_distinct", "n_words", "share < 0.2 AND n_words < 5000", "share > 0.5 AND n_words >= 10"),
    Rule("lettered_words", "n_lettered", "n_words", "share < 0.8", "share > 0.95"),
    Rule("capitals", "n_capitals", "n_letters", "share > 0.5", "share < 0.2"),
    Rule("shouting", "n_shouts", "n_words", "share > 0.2", "share <= 0.02"),
    Rule("mark_runs", "n_mark_runs", "n_words", "share > 0.2", "share <= 0.02"),
)


@dataclass
class Accuracies:
    """The share of good texts, and how often each rule, if it votes, is right on good and on bad ones."""

    common: float
    on_good: list[float]
    on_bad: list[float]

    def posterior(self, votes: Column) -> Column:
        """Probability that a text with these votes is good."""
        logit = F.lit(math.log(self.common / (1 - self.common)))
        for i, (g, b) in enumerate(zip(self.on_good, self.on_bad)):
            vote = vote_in(votes, i)
            logit = logit + F.when(vote == GOOD, math.log(g / (1 - b))).when(vote == BAD, math.log((1 - g) / b)).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def combined(rules=RULES) -> Column:
    """The votes of all rules as the digits, to base 3, of one number."""
    return reduce(add, ((rule.vote() + 1) * 3 ** i for i, rule in enumerate(rules))).cast("long")


def vote_in(votes: Column, i: int) -> Column:
    return F.floor(votes / 3 ** i) % 3 - 1


def learn_accuracies(counts: DataFrame, rules: int = len(RULES), rounds: int = ROUNDS) -> Accuracies:
    """Expectation-maximisation over (votes, n): how many texts have each combination of votes."""
    model = Accuracies(COMMON, [RIGHT_ON_GOOD] * rules, [RIGHT_ON_BAD] * rules)

    def smooth(right: float | None, all_: float | None, start: float) -> float:
        return ((right or 0.0) + PRIOR * start) / ((all_ or 0.0) + PRIOR)

    good, bad = F.col("n") * F.col("_p"), F.col("n") * (1 - F.col("_p"))
    sums = [F.sum(good).alias("good"), F.sum(bad).alias("bad")]
    for i in range(rules):
        vote = vote_in(F.col("votes"), i)
        sums += [F.sum(F.when(vote == GOOD, good)).alias(f"gg{i}"), F.sum(F.when(vote != NONE, good)).alias(f"g{i}"),
                 F.sum(F.when(vote == BAD, bad)).alias(f"bb{i}"), F.sum(F.when(vote != NONE, bad)).alias(f"b{i}")]
    for _ in range(rounds):
        r = counts.withColumn("_p", model.posterior(F.col("votes"))).agg(*sums).first()
        model = Accuracies(smooth(r.good, (r.good or 0.0) + (r.bad or 0.0), COMMON),
                           [smooth(r[f"gg{i}"], r[f"g{i}"], RIGHT_ON_GOOD) for i in range(rules)],
                           [smooth(r[f"bb{i}"], r[f"b{i}"], RIGHT_ON_BAD) for i in range(rules)])
    return model


def weak_quality(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """The rows with the measures, ``base_failed``, ``p_good`` (posterior probability) and ``kept``.

    ``base_failed``: fewer than `FEW_WORDS` words, or more than `MOST_REPEATED` percent of them repeated. Only ``text``
    is read; other columns stay, columns with the names added are replaced. NULL, empty and blank texts have
    zeros everywhere and fail. Equal texts get equal results, and repeated rows count as often as they are there.
    Very long texts are read whole. An empty table gives an empty result.
    """
    added = [*MEASURES, "base_failed", "p_good", "kept"]
    names = [c for c in docs.columns if c not in added and (keep_text or c != "text")]
    measured = docs.select(*names, measures(F.col("text")).alias("_measured"))
    measured = saved(measured.select(*names, "_measured.*").withColumn("_votes", combined()), "rules-measures")
    counts = saved(measured.groupBy(F.col("_votes").alias("votes")).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "rules-votes")
    model = learn_accuracies(counts)
    failed = (F.col("n_words") < FEW_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    posterior = model.posterior(F.col("_votes"))
    return measured.select(*names, *MEASURES, failed.alias("base_failed"), posterior.alias("p_good"),
                           (~failed & (posterior >= KEEP)).alias("kept"))


def rules_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return weak_quality(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
