"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Strict patterns give the seed entities. Every token with a digit or an ``@`` is an instance, and so is every run
of numbers between single spaces; a pattern is the words beside it together with its shape or, if it may
be an identifier, with its coarse class alone, which also finds those unlike all seeds. Patterns and instances form a graph that is
scored in rounds: a pattern's score is the smoothed share of confident instances of a kind among all its
different instances, and an instance's confidence is that not all of its patterns are wrong. Patterns with
a high score and enough different confident instances then mark the instances they hold, which the strict
patterns may have missed. The graph holds different (pattern, instance) links only, combined before they
are shuffled; nothing of it reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.base import SPACE, saved
from tradeloom.llm.spans import (count_of, digits, found_between, found_where, joined, listed, let, luhn,
                                 marked, no_spans, scan)

KINDS = ("email", "ip", "card", "phone")
LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# The strict patterns, as runs that never backtrack.
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{HOST}++(?:\.{HOST}++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
NUMBER = rf"""[+(]?[0-9][0-9().-]*+(?![^{SPACE},;:!?"'])"""
RUN = rf"(?<![^{SPACE}]){NUMBER}(?:\x20{NUMBER})++"
LEAD = r"^[^\p{L}\p{N}+]+"
EDGE = r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$"

BLOCK = 1024
ROUNDS = 3
MIN_SCORE, MIN_CONFIDENT, SMOOTHING = 0.8, 3, 1.0


def _numbers(parts: Column) -> Column:
    """Whether all parts of an address are at most 255, whatever their length."""
    def small(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+(?=.)", "")
        return (F.length(bare) <= 3) & (F.when(F.length(bare) <= 3, bare).cast("int") <= 255)
    return F.forall(parts, small)


def base_spans(text: Column) -> Column:
    """One array of found spans per kind, in the order of `KINDS`."""
    def sized(spans: Column, least: int, most: int, also=None) -> Column:
        def fits(x: Column) -> Column:
            number = digits(x["m"])
            right = F.length(number).between(least, most)
            return F.when(right, also(number)).otherwise(False) if also else right
        return F.filter(spans, fits)

    number = text.rlike("[0-9]")
    return F.struct(
        found_where(text.contains("@"), text, EMAIL).alias("email"),
        F.filter(found_where(number, text, IP), lambda x: _numbers(F.split(x["m"], r"\."))).alias("ip"),
        sized(found_where(number, text, CARD), 14, 19, luhn).alias("card"),
        sized(found_where(text.contains("+"), text, PHONE), 10, 15).alias("phone"))


def all_marked(base: Column) -> Column:
    return F.concat(*[marked(base[k], k, i) for i, k in enumerate(KINDS)])


def _shape(token: Column) -> Column:
    shape = F.regexp_replace(F.regexp_replace(token, r"\p{L}+", "a"), "[0-9]", "9")
    return F.regexp_replace(shape, "9{5,}", "9+")


def _class(value: Column) -> Column:
    """What an identifier may be by its symbols alone; NULL for what is none (few digits, or more than any kind has)."""
    return (F.when(value.contains("@"), "@").when(value.rlike(r"^[0-9]+(\.[0-9]+){3}$"), "dotted")
            .when(F.length(digits(value)).between(7, 19) & ~value.rlike(r"\p{L}"), "many"))


def _plain(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"[^\p{L}]", ""))


def with_seeds(tokens: Column, seeds: Column) -> Column:
    """The tokens (``s``, ``e``: their bare value's place), in order, with ``seed`` (kind of a strict span that covers
    one, the first of `KINDS` if several do) and ``touched`` (whether a strict span overlaps it).

    Strict spans of a kind do not overlap, so of those that begin before a token only the last of each kind can reach
    it: one pass over tokens and spans in order of their start keeps these ends. A pass back keeps the next start.
    """
    ends = F.struct(*[F.lit(0).alias(k) for k in KINDS])
    marks = F.transform(seeds, lambda k: F.struct(k["s"].alias("s"), F.lit(0).alias("later"), k["e"].alias("e"), k["kind"].alias("kind"),
                                                  F.lit(-1).alias("i")))
    places = F.transform(tokens, lambda x, i: F.struct(x["s"].alias("s"), F.lit(1).alias("later"), x["e"].alias("e"),
                                                       F.lit(None).cast("string").alias("kind"), i.alias("i")))

    def ahead(state: Column, x: Column) -> tuple[Column, Column]:
        after = F.struct(*[F.when(x["kind"] == k, x["e"]).otherwise(state[k]).alias(k) for k in KINDS])
        covering = F.coalesce(*[F.when(state[k] >= x["e"], F.lit(k)) for k in KINDS])
        reached = F.greatest(*[state[k] for k in KINDS]) > x["s"]
        return after, F.struct(x["i"].alias("i"), covering.alias("seed"), reached.alias("touched"))

    def back(state: Column, x: Column) -> tuple[Column, Column]:
        return F.when(x["i"] < 0, x["s"]).otherwise(state), F.struct(x["i"].alias("i"), (state < x["e"]).alias("touched"))

    def of_tokens(found: Column) -> Column:
        return F.array_sort(F.filter(found, lambda x: x["i"] >= 0))

    def joined_up(events: Column) -> Column:
        covered = of_tokens(scan(events, ends, ahead, "struct<i:int,seed:string,touched:boolean>"))
        begun = of_tokens(scan(F.reverse(events), F.lit(2 ** 31 - 1), back, "struct<i:int,touched:boolean>"))
        return F.zip_with(covered, begun, lambda a, b: F.struct(a["seed"].alias("seed"), (a["touched"] | b["touched"]).alias("touched")))

    beside = let(F.array_sort(F.concat(marks, places)), joined_up)
    return F.zip_with(tokens, beside, lambda x, y: F.struct(
        *[x[c].alias(c) for c in ("s", "e", "m", "left", "right", "value")], y["seed"].alias("seed"), y["touched"].alias("touched")))


def instances(rows: DataFrame, text: Column) -> DataFrame:
    """Tokens with a digit or ``@`` and runs of numbers: place, bare value, the seed kind that covers it, and its patterns.

    ``rows`` has the strict spans as ``_found``; the tokens keep the ``key`` of their row.
    """
    def bare(x: Column) -> Column:
        value = F.regexp_replace(x["m"], EDGE, "")
        s = x["s"] + F.length(F.regexp_extract(x["m"], LEAD, 0))
        return F.struct(s.alias("s"), (s + F.length(value)).alias("e"), x["m"].alias("m"), x["left"].alias("left"),
                        x["right"].alias("right"), value.alias("value"))

    def seeded(pattern: str, sound) -> Column:
        tokens = F.filter(F.transform(found_between(text, pattern), bare), lambda x: sound(x["value"]))
        return let(tokens, lambda some: with_seeds(some, all_marked(F.col("_found"))))

    both = F.concat(seeded(TOKEN, lambda v: v != ""), seeded(RUN, lambda v: F.length(digits(v)).between(7, 19)))
    tokens = rows.filter(text.rlike("[0-9@]")).select("key", F.explode(both).alias("x")).select("key", "x.*")

    def word(gap: str, place: Column) -> Column:
        return _plain(F.coalesce(F.get(gap, place), F.lit("#")))

    for side in ("left", "right"):
        tokens = tokens.withColumn(side, F.array_remove(F.split(side, f"[{SPACE}]+"), ""))
    tokens = tokens.withColumns({"one": word("left", F.size("left") - 1), "two": word("left", F.size("left") - 2),
                                 "then": word("right", F.lit(0)), "shape": _shape(F.col("value")),
                                 "class": _class(F.col("value"))})
    exact = F.when(~F.col("value").contains(" "), F.array(F.concat_ws(" ", F.lit("L"), "two", "one", "shape"),
                                                          F.concat_ws(" ", F.lit("M"), "one", "shape", "then")))
    words = F.col("class").isNotNull() & (F.col("one") != "")
    lexical = F.filter(F.array(F.when(words & (F.col("two") != ""), F.concat_ws(" ", F.lit("l"), "two", "one", "class")),
                               F.when(words & (F.col("then") != ""), F.concat_ws(" ", F.lit("m"), "one", "class", "then"))),
                       lambda p: p.isNotNull())
    return tokens.select("key", "s", "e", F.lower("value").alias("value"), "seed", "touched",
                         F.concat(F.coalesce(exact, F.array().cast("array<string>")), lexical).alias("patterns"))


def apart(added: Column) -> Column:
    """Marked spans in order, those that begin inside a longer one or one before left out."""
    ordered = F.array_sort(F.transform(added, lambda x: F.struct(
        x["s"].alias("s"), (-x["e"]).alias("longest"), x["r"].alias("r"), x["e"].alias("e"), x["kind"].alias("kind"))))

    def step(end: Column, x: Column) -> tuple[Column, Column]:
        kept = F.when(x["s"] >= end, F.struct(*[x[c].alias(c) for c in ("s", "r", "e", "kind")]))
        return F.when(x["s"] >= end, x["e"]).otherwise(end), kept

    kept = scan(ordered, F.lit(0), step, "struct<s:int,r:int,e:int,kind:string>")
    return F.filter(kept, lambda x: x.isNotNull())


def score_patterns(edges: DataFrame, rounds: int = ROUNDS, min_score: float = MIN_SCORE,
                   min_confident: int = MIN_CONFIDENT, smoothing: float = SMOOTHING) -> DataFrame:
    """(pattern, kind, score) of the patterns to trust.

    ``edges``: different (pattern, value) with ``seed``, the kind of a value seen in a seed, or NULL.
    """
    # links and seeds are stored: joins on a frequent value then read plain shuffles, which AQE can split
    edges = saved(edges.groupBy("pattern", "value").agg(F.min("seed").alias("seed")), "pii-links")
    links = edges.select("pattern", "value")
    seeded = saved(edges.filter("seed IS NOT NULL").groupBy("value").agg(F.min("seed").alias("kind"))
                   .withColumn("trust", F.lit(1.0)), "pii-seeds")
    trust = seeded
    sizes = links.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    for round_ in range(rounds):
        good = (links.join(trust, "value").groupBy("pattern", "kind")
                .agg(F.sum("trust").alias("sure"), F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") >= min_confident))
        scored = saved(good.join(sizes, "pattern").withColumn("score", F.col("sure") / (F.col("size") + smoothing))
                       .filter(F.col("score") >= min_score).select("pattern", "kind", "score"), "pii-patterns")
        if round_ == rounds - 1:
            return scored
        induced = (links.join(scored, "pattern").groupBy("value", "kind")
                   .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("trust")))
        best = induced.groupBy("value").agg(F.max_by(F.struct("kind", "trust"), F.struct("trust", "kind")).alias("b"))
        trust = saved(seeded.unionByName(
            best.select("value", "b.kind", "b.trust").join(seeded, "value", "left_anti")), "pii-trust")
    raise ValueError("rounds must be positive")


def find_pii(docs: DataFrame, rounds: int = ROUNDS, min_score: float = MIN_SCORE,
             min_confident: int = MIN_CONFIDENT) -> DataFrame:
    """The documents with ``base`` and ``spans``: arrays of (s, r, e, kind), ends exclusive.

    ``base`` holds the strict matches, ``spans`` also what trusted patterns add. All rows and columns stay
    (columns named base or spans are replaced); equal texts get equal spans. NULL and empty texts have none. Spans
    of different kinds may overlap; added ones touch no strict one and no other added one. An empty table gives an empty result.
    """
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.drop("base", "spans", "_found", "_key").withColumn("_found", base_spans(text))
    tokens = saved(instances(rows.select(key.alias("key"), "text", "_found"), text), "pii-tokens")
    edges = tokens.select("value", "seed", F.explode("patterns").alias("pattern"))
    trusted = score_patterns(edges, rounds, min_score, min_confident)
    rank = reduce(lambda acc, k: acc.when(F.col("kind") == k[1], k[0]), enumerate(KINDS[1:], 1),
                  F.when(F.col("kind") == KINDS[0], 0))
    unseen = (tokens.filter("NOT touched").select("key", "s", "e", F.explode("patterns").alias("pattern"))
              .join(trusted, "pattern").groupBy("key", "s", "e")
              .agg(F.max_by("kind", F.struct("score", "kind")).alias("kind")))
    added = unseen.groupBy("key").agg(F.collect_set(F.struct(
        "s", rank.cast("int").alias("r"), "e", "kind")).alias("_added")).select(F.col("key").alias("_key"), apart(F.col("_added")).alias("_added"))
    out = rows.withColumn("_key", key).join(added, "_key", "left")
    out = out.withColumn("base", listed(all_marked(F.col("_found"))))
    out = out.withColumn("spans", listed(F.concat("base", F.coalesce("_added", no_spans()))))
    return out.drop("_key", "_found", "_added")


def blocks_of(text: Column) -> Column:
    """A text in blocks of `BLOCK` characters: to cut a piece out of a long text, Spark walks to it from the start."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")),
                       lambda i: F.substring(text, i * BLOCK + 1, F.lit(BLOCK)))


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from start to end (exclusive) of a text in blocks."""
    first, last = (F.floor(at / BLOCK).cast("int") for at in (start, end))
    within = F.substring(F.get(blocks, first), start % BLOCK + 1, end - start)
    across = F.concat(F.substring(F.get(blocks, first), start % BLOCK + 1, F.lit(BLOCK)),
                      F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                      F.substring(F.get(blocks, last), F.lit(1), end % BLOCK))
    return F.when(first == last, within).otherwise(across)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; columns stay.

    Overlapping spans become one, named by the first. ``n_chars``, if there, is the new length. Texts
    without personal data, NULL ones included, are as they were.
    """
    names = docs.columns
    code = F.col("text")

    def rest(blocks: Column) -> Column:
        def step(at: Column, x: Column) -> tuple[Column, Column]:
            gap = cut(blocks, at, F.greatest(x["s"], at))
            piece = F.when(x["s"] >= at, F.concat(gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")
            return F.greatest(at, x["e"]), piece

        end = F.array_max(F.transform("spans", lambda x: x["e"]))
        return F.concat(F.array_join(scan(F.col("spans"), F.lit(0), step, "string"), ""), cut(blocks, end, F.length(code)))

    some = F.size("spans") > 0
    out = find_pii(docs).withColumn("text", F.when(some, let(blocks_of(code), rest)).otherwise(code))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*names)


def pii_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    out = find_pii(docs)
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))
