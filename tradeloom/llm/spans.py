"""Places of regular-expression matches in a text, with DataFrame functions only.

Patterns are written so that a scan is linear in the text: runs are possessive, and a match may start in
the middle of a run only where the one before it ended (``\\G``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 64
FOUND = "array<struct<s:int,e:int,m:string>>"
MARKED = "array<struct<s:int,r:int,e:int,kind:string>>"


def no_spans() -> Column:
    return F.array().cast(MARKED)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(values: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step(state, value)`` emits, a DDL type ``kind``, for each value in order; it also gives the next state.

    An array that grows by one element per step is copied each time. So the values are taken in chunks, whose results
    are put together once: the cost is that of the values times a chunk, not times all values.
    """
    def start(state: Column, of: str) -> Column:
        return F.struct(state.alias("state"), F.array().cast(of).alias("out"))

    def grown(acc: Column, x: Column) -> Column:
        after, emitted = step(acc["state"], x)
        return F.struct(after.alias("state"), F.concat(acc["out"], F.array(emitted)).alias("out"))

    def along(acc: Column, chunk: Column) -> Column:
        inner = F.aggregate(chunk, start(acc["state"], f"array<{kind}>"), grown)
        return let(inner, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    def chunked(values: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
                             lambda i: F.slice(values, i * CHUNK + 1, F.lit(CHUNK)))
        return F.when(F.size(values) > 0, F.flatten(F.aggregate(
            chunks, start(state, f"array<array<{kind}>>"), along, lambda acc: acc["out"]))).otherwise(F.array().cast(f"array<{kind}>"))

    return let(values, chunked)


def _matches(text: Column, pattern: str) -> Column:
    """The text between matches, from a split by the same pattern, with the match after it (NULL at the end)."""
    return F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))


def _placed(text: Column, pattern: str) -> Column:
    """As `_matches`, with start and end; lengths add up to the places."""
    def step(at: Column, x: Column) -> tuple[Column, Column]:
        s = at + F.length(x["gap"])
        e = s + F.coalesce(F.length(x["m"]), F.lit(0))
        return e, F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"), x["gap"].alias("gap"))

    return scan(_matches(text, pattern), F.lit(0), step, "struct<s:int,e:int,m:string,gap:string>")


def found(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches: start, end (code points, exclusive) and the string."""
    return F.transform(F.filter(_placed(text, pattern), lambda x: x["m"].isNotNull()), lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))


def found_between(text: Column, pattern: str) -> Column:
    """As `found`, with the text before and after each match up to its neighbours (``left``, ``right``)."""
    def paired(placed: Column) -> Column:
        n = F.size(placed) - 1
        return F.zip_with(F.slice(placed, F.lit(1), n), F.slice(placed, F.lit(2), n), lambda a, b: F.struct(
            a["s"].alias("s"), a["e"].alias("e"), a["m"].alias("m"), a["gap"].alias("left"), b["gap"].alias("right")))

    return let(_placed(text, pattern), paired)


def found_where(test: Column, text: Column, pattern: str) -> Column:
    """As `found`; texts that fail a cheap test every match must pass are not scanned."""
    return F.when(test, found(text, pattern)).otherwise(F.array().cast(FOUND))


def marked(spans: Column, kind: str, rank: int) -> Column:
    """Found spans as (start, rank of the kind, end, kind), the order they are listed in."""
    return F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.lit(rank).alias("r"), x["e"].alias("e"), F.lit(kind).alias("kind")))


def listed(spans: Column) -> Column:
    """Marked spans in order."""
    return F.array_sort(spans)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of marked spans in order, comma-joined."""
    return F.array_join(F.transform(listed(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.split(F.reverse(number), "")

    def add(total: Column, x: Column) -> Column:
        return total + x

    worth = F.transform(F.filter(back, lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(worth, F.lit(0), add) % 10 == 0


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function (rational approximation with an error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z > 0, 1 - upper).otherwise(upper)


def count_of(spans: Column, kind: str) -> Column:
    """How many marked spans are of a kind."""
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
