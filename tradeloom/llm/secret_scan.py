"""Secrets by a battery of randomness tests, with DataFrame functions only.

Besides the strict patterns, every run of key characters that is long enough to give evidence is a candidate;
an `=` ends a run unless it is padding, so the value of an assignment stands alone. Its encoding is inferred
from the characters it uses (hexadecimal, base 32, lower or upper case with digits, base 62, base 64), and
three tests ask whether it looks like uniform draws from that alphabet: chi-squared on the symbol
counts, Wald-Wolfowitz runs about the middle of the alphabet, and lag-1 serial correlation. A candidate that
fails one of them (Bonferroni over the three) is not random. For the others the chi-squared statistic is
held against what ordinary text of the same length would give; the letter frequencies for that come
from all ordinary long words of the corpus, and the exact mean and variance of the statistic depend on
the length, so short strings need more evidence, and a run of which even different symbols throughout
could not be a discovery is not tested. Runs of digits only are tested from `LONG` characters on: shorter ones
are dates and numbers of all kinds, of which letter frequencies tell nothing. Those p-values pass a Benjamini-Hochberg step over all
candidates, on a fixed grid of p-values rounded up, so it needs one count per grid cell.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.base import saved
from tradeloom.llm.spans import count_of, found_where, joined, listed, marked, no_spans, normal_cdf

KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)""")
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
LONG = 20  # of the ordinary words whose letters are counted
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+(?:=++(?![A-Za-z0-9+/_-]))?"
ORDINARY = r"^[-_/+=]*(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-_/+=]+(?:[A-Z]?[a-z]+|[A-Z]+))*[-_/+=]*$"
SHORT_NUMBER = "^[0-9]{1,%d}=*$" % (LONG - 1)
LETTERS, NUMERALS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Name, pattern and alphabet in code order; the first that fits is the encoding.
ENCODINGS = (
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", NUMERALS + LETTERS[:6]),
    ("base32", "^[A-Z2-7]+=*$", LETTERS + "234567"),
    ("base36", "^(?:[0-9a-z]+|[0-9A-Z]+)$", NUMERALS + LETTERS),
    ("base62", "^[0-9A-Za-z]+$", LETTERS.upper() + LETTERS + NUMERALS),
    ("base64", "^[0-9A-Za-z+/_-]+=*$", LETTERS.upper() + LETTERS + NUMERALS + "+/"),
)
ONE_CASE = 36  # alphabets up to this size are read in lower case
ALPHA, RANDOM_P = 0.01, 0.003
GRID, CELLS = 4, 400  # cells per factor of two of a p-value, and the smallest cell


def base_spans(text: Column) -> Column:
    """One array of found spans for each strict kind."""
    def long(spans: Column, least: int) -> Column:
        return F.filter(spans, lambda x: F.length(x["m"]) >= least)

    assign = found_where(text.rlike("[:=]"), text, ASSIGN)
    return F.struct(
        F.filter(assign, lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 8).alias("assign"),
        long(found_where(text.contains("AKIA"), text, ACCESS), 16).alias("access"),
        found_where(text.rlike("[0-9a-f]{32}"), text, HEX).alias("hex"))


def all_marked(base: Column) -> Column:
    return F.concat(*[marked(base[k], k, i) for i, k in enumerate(KINDS[:3])])


def _encoding(token: Column) -> Column:
    out = F.lit(None).cast("int")
    for i in reversed(range(len(ENCODINGS))):
        out = F.when(token.rlike(ENCODINGS[i][1]), F.lit(i)).otherwise(out)
    return out


def _of_encoding(encoding: Column, values: list) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), encoding + 1)


def statistics(tokens: DataFrame) -> DataFrame:
    """Tokens (``m``) with ``enc``, ``n``, sum of squared symbol counts ``s2`` and the tests' z values."""
    enc = tokens.withColumn("enc", _encoding(F.col("m"))).filter("enc IS NOT NULL")
    size = _of_encoding(F.col("enc"), [len(e[2]) for e in ENCODINGS])
    body = F.regexp_replace("m", "=+$", "")
    body = F.when(size <= ONE_CASE, F.lower(body)).otherwise(F.translate(body, "-_", "+/"))
    enc = (enc.withColumn("size", size).withColumn("body", body)
           .withColumn("alphabet", _of_encoding(F.col("enc"), [e[2] for e in ENCODINGS])))
    symbols = F.transform(F.filter(F.split("body", ""), lambda c: c != ""), lambda c: F.instr(F.col("alphabet"), c))
    enc = enc.withColumn("x", symbols).withColumn("n", F.size("x").cast("double")).filter("n >= 2")
    # squares of the counts: the k-th of equal symbols in sorted order adds 2k - 1
    run = F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("s2"))

    def count(acc: Column, x: Column) -> Column:
        k = F.when(acc["last"] == x, acc["k"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(x.alias("last"), k.alias("k"), (acc["s2"] + 2 * k - 1).alias("s2"))

    zero, none = F.lit(0.0), F.lit(0).cast("long")
    walk = F.struct(zero.alias("last"), none.alias("runs"), none.alias("high"), zero.alias("sum"),
                    zero.alias("squares"), zero.alias("products"))

    def along(acc: Column, x: Column) -> Column:
        value, half = x.cast("double"), F.col("size") / 2
        high, was = value > half, acc["last"] > half
        new = (acc["last"] == 0) | (high != was)
        return F.struct(value.alias("last"), (acc["runs"] + new.cast("long")).alias("runs"),
                        (acc["high"] + high.cast("long")).alias("high"), (acc["sum"] + value).alias("sum"),
                        (acc["squares"] + value * value).alias("squares"),
                        (acc["products"] + acc["last"] * value).alias("products"))

    enc = (enc.withColumn("s2", F.aggregate(F.array_sort("x"), run, count, lambda a: a["s2"]).cast("double"))
           .withColumn("w", F.aggregate("x", walk, along)))
    n, a = F.col("n"), F.col("size").cast("double")
    df = a - 1
    chi = (a * F.col("s2") / n - n)
    # Wilson-Hilferty: the cube root of chi-squared over its degrees is close to normal
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    up, down = F.col("w.high").cast("double"), n - F.col("w.high")
    mean = 2 * up * down / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(spread > 0, (F.col("w.runs") - mean) / F.sqrt(spread)).otherwise(99.0)
    centre = F.col("w.sum") / n
    variance = F.col("w.squares") / n - centre * centre
    first, last = F.get("x", F.lit(0)).cast("double"), F.col("w.last")
    products = F.col("w.products") - centre * (2 * F.col("w.sum") - first - last) + (n - 1) * centre * centre
    z_serial = F.when(variance > 0, (products / n / variance + 1 / n) * F.sqrt(n)).otherwise(99.0)
    return enc.withColumns({"z_chi": z_chi, "z_runs": z_runs, "z_serial": z_serial}).drop("x", "w", "alphabet", "body")


def letter_counts(words: DataFrame) -> DataFrame:
    """One row: the letters of all ordinary long words, in lower case."""
    low = F.lower("m")
    return words.agg(*[F.sum((F.length(low) - F.length(F.translate(low, c, ""))).cast("long")).alias(c)
                       for c in LETTERS])


def letter_moments(letters) -> list[tuple[float, float]]:
    """Sums of squares and cubes of the shares of the corpus's letters in each encoding's alphabet.

    ``letters``: the one row of `letter_counts`.
    """
    moments = []
    for _, _, alphabet in ENCODINGS:
        counts = [letters[c] or 0 for c in LETTERS if c in alphabet]
        total = sum(counts)
        share = [c / total for c in counts] if total else [1 / len(alphabet)] * len(alphabet)
        moments.append((sum(p ** 2 for p in share), sum(p ** 3 for p in share)))
    return moments


def shortest(moments: list[tuple[float, float]], alpha: float) -> list[int]:
    """The least length, for each encoding, at which the most even symbols have a p-value of ``alpha`` or less; at most `LONG`."""
    out = []
    for (q2, q3), (_, _, alphabet) in zip(moments, ENCODINGS):
        for n in range(2, LONG + 1):
            each, more = divmod(n, len(alphabet))
            least = (len(alphabet) - more) * each ** 2 + more * (each + 1) ** 2
            spread = 2 * n * (n - 1) * (q2 - q2 * q2) + 4 * n * (n - 1) * (n - 2) * (q3 - q2 * q2)
            if n == LONG or NormalDist().cdf((least - n - n * (n - 1) * q2) / max(spread, 1e-9) ** 0.5) <= alpha:
                break
        out.append(n)
    return out


def text_p(tokens: DataFrame, moments: list[tuple[float, float]]) -> DataFrame:
    """Adds ``p``: how likely ordinary text has symbols spread as evenly as the token's, or more.

    ``moments``: of `letter_moments`. Exact mean and variance of the sum of squared counts for draws of
    the corpus's letters, restricted to the token's alphabet.
    """
    n = F.col("n")
    q2 = _of_encoding(F.col("enc"), [m[0] for m in moments])
    q3 = _of_encoding(F.col("enc"), [m[1] for m in moments])
    mean = n + n * (n - 1) * q2
    spread = 2 * n * (n - 1) * (q2 - q2 * q2) + 4 * n * (n - 1) * (n - 2) * (q3 - q2 * q2)
    return tokens.withColumn("p", normal_cdf((F.col("s2") - mean) / F.sqrt(F.greatest(spread, F.lit(1e-9)))))


def _cell(p: Column) -> Column:
    """Cell of the grid; its largest p is 2 ** (-cell / GRID)."""
    return F.least(F.floor(-F.log2(F.greatest(p, F.lit(1e-300))) * GRID), F.lit(CELLS)).cast("int")


def discoveries(tested: DataFrame, alpha: float = ALPHA, random_p: float = RANDOM_P) -> DataFrame:
    """Tokens that random strings could be and ordinary text, at this false-discovery rate, could not."""
    worst = F.greatest(F.col("z_chi"), F.abs("z_runs"), F.abs("z_serial"))
    celled = tested.withColumn("cell", _cell(F.col("p")))
    cells = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("c"))  # at most CELLS + 1 rows
    upto = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    from_small = F.sum("c").over(upto)
    total = F.sum("c").over(Window.partitionBy())
    limit = (cells.withColumn("ok", F.pow(F.lit(2.0), -F.col("cell") / GRID) * total <= alpha * from_small)
             .filter("ok").agg(F.min("cell").alias("limit")))
    return (celled.join(F.broadcast(limit), F.col("cell") >= F.col("limit"))  # one row
            .filter((1 - normal_cdf(worst)) * 3 >= random_p).drop("cell", "limit"))


def find_secrets(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The documents with ``base`` and ``spans``: arrays of (s, r, e, kind), ends exclusive.

    ``base`` holds the strict matches, ``spans`` also the random strings that touch none of them. All rows
    and columns stay (columns named base or spans are replaced); equal texts get equal spans. NULL and
    empty texts have none. Without ordinary long words there is nothing to tell text from keys by, and
    no span is added. An empty table gives an empty result.
    """
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.drop("base", "spans", "_found", "_key").withColumn("_found", base_spans(text))
    words = rows.select(F.explode(found_where(F.length(text) >= LONG, text, CANDIDATE % LONG)["m"]).alias("m"))
    moments = letter_moments(letter_counts(words.filter(F.col("m").rlike(ORDINARY))).first())
    lengths = shortest(moments, alpha)
    least = min(lengths)
    near = F.filter(found_where(F.length(text) >= least, text, CANDIDATE % least),
                    lambda x: ~x["m"].rlike(ORDINARY) & ~x["m"].rlike(SHORT_NUMBER))
    strict = all_marked(F.col("_found"))
    free = F.filter(near, lambda x: ~F.exists(strict, lambda k: (k["s"] < x["e"]) & (k["e"] > x["s"])))
    tokens = rows.select(key.alias("key"), F.explode(free).alias("x")).select("key", "x.*")
    enough = F.col("n") >= _of_encoding(F.col("enc"), lengths)
    tested = saved(text_p(statistics(tokens).filter(enough), moments)
                   .select("key", "s", "e", "p", "z_chi", "z_runs", "z_serial"), "secret-tests")
    added = (discoveries(tested, alpha).groupBy("key").agg(F.collect_set(F.struct(
        "s", F.lit(3).alias("r"), "e", F.lit(KINDS[3]).alias("kind"))).alias("_added")))
    out = rows.withColumn("_key", key).join(added.withColumnRenamed("key", "_key"), "_key", "left")
    out = out.withColumn("base", listed(all_marked(F.col("_found"))))
    out = out.withColumn("spans", listed(F.concat("base", F.coalesce("_added", no_spans()))))
    return out.drop("_key", "_found", "_added")


def secrets_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    out = find_secrets(docs)
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))
