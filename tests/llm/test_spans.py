"""Strict spans against Python's own engine on the plain patterns; what the methods add."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import docs_frame, odd_rows, prose
from pyspark.sql import functions as F

from tradeloom.llm.pii import apart, find_pii, redact
from tradeloom.llm.secret_scan import find_secrets
from tradeloom.llm.spans import MARKED, joined, normal_cdf

PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
       ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
SECRET = (("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
          ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+"))


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def right(kind, m):
    number = re.sub("[^0-9]", "", m[0])
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
            "card": lambda: 14 <= len(number) <= 19 and luhn(number), "phone": lambda: 10 <= len(number) <= 15,
            "assign": lambda: len(m[1]) >= 8, "access": lambda: len(m[0]) >= 16, "hex": lambda: len(m[0]) >= 32}[kind]()


def plain(text, patterns):
    spans = [(m.start(), i, m.end(), kind) for i, (kind, p) in enumerate(patterns)
             for m in re.finditer(p, text or "", re.ASCII) if right(kind, m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


PARTS = ["a@b.co", "x.y@", "1.2.3.4", "256.1.1.1", ".5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (377) 555-0271",
         "+49", " ", "\n", "@", ".", "-", "é", "😀", "token = ", "API_KEY:'", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "=", "_d@e.f",
         "0" * 33, "password", "\"", "secret=abc.def/ghi", "12345678901234567890", "+", "%", "(", "7", "f"]


def check(spark, texts):
    docs = docs_frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    for find, patterns in ((find_pii, PII), (find_secrets, SECRET)):
        for r in find(docs).select("text", joined(F.col("base")).alias("b"), joined(F.col("spans")).alias("s")).collect():
            assert r.b == plain(r.text, patterns), r.text
            assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))


def test_strict_spans(spark):
    pick = random.Random(11)
    check(spark, ["".join(pick.choice(PARTS) for _ in range(pick.randrange(1, 14))) for _ in range(1500)]
          + [r[1] for r in odd_rows() if r[1] is None or len(r[1]) < 1000])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="a1@.+- (:='AKI_é\n9f", max_size=60), min_size=30, max_size=60))
def test_strict_spans_of_any_text(spark, texts):
    check(spark, texts)


def test_very_long_texts(spark):
    rows = odd_rows()
    got = find_pii(docs_frame(spark, rows)).select("text", joined(F.col("base")).alias("b")).collect()
    assert len(got) == len(rows) and all(r.b == plain(r.text, PII) for r in got)
    got = find_secrets(docs_frame(spark, rows)).select("text", joined(F.col("base")).alias("b")).collect()
    assert all(r.b == plain(r.text, SECRET) for r in got)


def test_context_finds_unseen_identifiers(spark):
    """Seeds teach a context; the same context then marks numbers that the strict patterns miss."""
    rows = [(i, f"{prose(i)} please call me at +1 (20{i}) 555-01{i:02d} thanks {prose(99 - i)}", "en", "a") for i in range(10, 40)]
    rows += [(100, "please call me at 1 (207) 555-0177 thanks", "en", "a"), (101, f"room 1 (207) {prose(5)} 77 left", "en", "a")]
    rows += [(200 + i, f"{prose(i)} account number: {4000 + i} is open", "en", "a") for i in range(20)]
    got = {r.doc_id: r.s for r in find_pii(docs_frame(spark, rows)).select("doc_id", joined(F.col("spans")).alias("s")).collect()}
    assert all(got[i].count("phone") == 1 for i in range(10, 40))
    assert got[100] == "phone:18:34" and all(got[i] == "" for i in [101, *range(200, 220)])
    mails = [(i, f"{prose(i)} write to user{i}@mail.example now", "en", "a") for i in range(20)]
    mails += [(50, "write to user77@localhost now", "en", "a"), (51, "write off user77 now", "en", "a"),
              (52, "write to user77 at 12 now, look at user77@localhost then, write to 5551234567 now", "en", "a")]
    got = {r.doc_id: r.s for r in find_pii(docs_frame(spark, mails)).select("doc_id", joined(F.col("spans")).alias("s")).collect()}
    assert got[50] == "email:9:25" and got[51] == got[52] == ""


def test_contexts_with_little_evidence_mark_nothing(spark):
    """The same words before numbers of which half are no personal data; years, sizes and dates stay."""
    rows = [(i, f"{prose(i)} call me at +1 (20{i}) 555-01{i:02d} ok", "en", "a") for i in range(10, 25)]
    rows += [(100 + i, f"{prose(i)} call me at {i} 000 0{i} 11 ok, built at {1900 + i} for {i} 500 000 cars", "en", "a") for i in range(10, 25)]
    got = {r.doc_id: r.s for r in find_pii(docs_frame(spark, rows)).select("doc_id", joined(F.col("spans")).alias("s")).collect()}
    assert all(got[i].count("phone") == 1 for i in range(10, 25)) and not any(got[i] for i in range(110, 125))


def test_added_spans_stay_apart(spark):
    marks = [(0, 1, 3, "ip"), (3, 2, 20, "card"), (3, 0, 9, "email"), (4, 3, 9, "phone"), (9, 1, 30, "ip"), (40, 1, 41, "ip")]
    df = spark.createDataFrame([(marks,), ([],)], f"x {MARKED}")
    got = [[tuple(m) for m in r.x] for r in df.select(apart(F.col("x")).alias("x")).collect()]
    assert sorted(got) == [[], [(0, 1, 3, "ip"), (3, 2, 20, "card"), (40, 1, 41, "ip")]]


def test_learned_pattern_marks_a_strict_miss(spark):
    rows = [(i, f"my card is {n} ok", "en", "a") for i, n in enumerate(
        f"{base:015d}{check}" for base in range(400000000000000, 400000000000040) for check in range(10)
        if luhn(f"{base:015d}{check}"))]
    rows += [(900, "my card is 4000000000000001 ok", "en", "a"), (901, "we saw 4000000000000001 birds", "en", "a")]
    got = {r.doc_id: r.s for r in find_pii(docs_frame(spark, rows)).select("doc_id", joined(F.col("spans")).alias("s")).collect()}
    assert not luhn("4000000000000001") and got[900] == "card:11:27" and got[901] == ""


def test_a_text_of_many_identifiers(spark):
    """Cost follows the matches: a text of 5000 addresses, most of them in one run without words, is cut right."""
    text = " ".join(f"u{i}@m{i % 9}.example +1 (377) 555-{i % 10000:04d}" + (" é😀 and" * 300 if i % 500 == 0 else "") for i in range(2500))
    docs = docs_frame(spark, [(1, text, "en", "a"), (2, "none", "en", "a"), (3, "a@b.co" + "x" * 3000, "en", "a")])
    got = {r.doc_id: r for r in find_pii(docs).select("doc_id", "spans", joined(F.col("base")).alias("b")).collect()}
    assert got[1].b == plain(text, PII)
    cut = {r.doc_id: r.text for r in redact(docs).collect()}
    want, at = [], 0
    for x in got[1].spans:
        if x.s >= at:
            want += [text[at:x.s], f"[{x.kind.upper()}]"]
        at = max(at, x.e)
    assert cut[1] == "".join(want) + text[at:] and cut[1].count("[EMAIL]") == 2500
    assert cut[2] == "none" and cut[3] == "[EMAIL]"


def test_redaction(spark):
    rows = odd_rows() + [(70, "ok a@b.co and 1.2.3.4, bye 😀 c@d.eu", "en", "a")]
    docs = docs_frame(spark, rows)
    out = redact(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = {r.doc_id: r for r in out.filter("doc_id >= 20").collect()}
    assert got[70].text == "ok [EMAIL] and [IP], bye 😀 [EMAIL]" and got[70].n_chars == len(got[70].text)
    assert all(got[r[0]].text == r[1] for r in rows if r[0] is not None and 20 <= r[0] < 70)


def test_random_strings_and_only_they(spark):
    pick = random.Random(2)
    symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = [(i, f"{prose(i)} {''.join(prose(i + 50, 6).split())} {prose(i, 5).replace(' ', '_')}_2", "en", "a") for i in range(300)]
    keys = {1000 + i: "".join(pick.choice(symbols) for _ in range(44)) for i in range(20)}
    rows += [(i, f"{prose(i)} {k} {prose(i)}", "en", "a") for i, k in keys.items()]
    got = {r.doc_id: r.s for r in find_secrets(docs_frame(spark, rows)).select("doc_id", joined(F.col("spans")).alias("s")).collect()}
    assert sum("random" in got[i] for i in keys) >= 18
    assert sum("random" in got[i] for i in range(300)) == 0
    for i, k in keys.items():
        at = len(prose(i)) + 1
        assert got[i] in ("", f"random:{at}:{at + len(k)}")


def test_random_values_of_assignments_and_short_ones(spark):
    """A name and ``=`` are not part of the value; padding is; 18 symbols give evidence, numbers do not."""
    pick = random.Random(4)
    symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(i, f"{prose(i)} {''.join(prose(i + 50, 6).split())} on 20260101120000 or 4000{i:06d}", "en", "a") for i in range(100)]
    want = {}
    for i in range(40):
        size, name, end = (44, "auth=", "") if i < 20 else (42, "sig=", "==") if i < 30 else (18, "pwd=", "")
        value = ("".join(pick.choice(symbols) for _ in range(size)) if size > 18 else "".join(pick.sample(symbols, size))) + end
        rows.append((1000 + i, f"{prose(i)} {name}{value} {prose(i)}", "en", "a"))
        at = len(prose(i)) + 1 + len(name)
        want[1000 + i] = f"random:{at}:{at + len(value)}"
    got = {r.doc_id: r.s for r in find_secrets(docs_frame(spark, rows)).select("doc_id", joined(F.col("spans")).alias("s")).collect()}
    assert sum(got[i] == w for i, w in want.items() if i < 1030) >= 27
    assert sum(got[i] == w for i, w in want.items() if i >= 1030) >= 5
    assert all(got[i] in ("", w) for i, w in want.items()) and not any(got[i] for i in range(100))


def test_empty_tables_and_clashing_columns(spark):
    docs = docs_frame(spark, odd_rows())
    for find in (find_pii, find_secrets):
        assert find(docs.limit(0)).count() == 0
        clash = docs
        for c in ("base", "spans", "key", "s", "e", "kind", "value", "pattern", "p", "n", "m"):
            clash = clash.withColumn(c, F.lit("x"))
        out = find(clash)
        assert out.count() == docs.count() and out.schema["kind"].dataType.simpleString() == "string"


def test_normal_distribution(spark):
    got = spark.range(1).select(normal_cdf(F.lit(-1.959964)), normal_cdf(F.lit(1.959964)), normal_cdf(F.lit(0.0))).first()
    assert [round(x, 5) for x in got] == [0.025, 0.975, 0.5]


def test_digest_of_no_span():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
