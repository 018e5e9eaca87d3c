"""Fill-in-the-middle over frames: places of units, outputs and restored texts against plain slicing."""

import hashlib
import random
import re

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import docs_frame, odd_rows, prose
from pyspark.sql import functions as F

from tradeloom.llm import fill_in_middle as fim

COMPRESS, DECOMPRESS = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def units(text):
    return re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by slicing the list of units."""
    text = text or ""
    u = units(text)
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def more_rows():
    pick = random.Random(3)
    rows = odd_rows() + [(100 + i, "".join(pick.choice("abZ <>PSM\n.é😀1") for _ in range(pick.randrange(60))), "en", "a")
                         for i in range(150)]
    return rows + [(900, "has <P> inside", "en", "a"), (901, prose(1) + "<M>", "en", "a"), (902, "<" * 50 + "P>", "en", "a"),
                   (903, prose(4, 40_000) + "é" * 70_000, "en", "a"), (904, "y" * 200_000 + " z", "en", "a")]


def test_against_slicing(spark):
    rows = more_rows()
    docs = docs_frame(spark, rows).withColumn("n", F.lit("x")).withColumn("frames", F.lit(1)).withColumn("output", F.lit(1))
    for size in (7, fim.FRAME):
        out = fim.fill_in_middle(fim.framed(docs, size))
        texts = fim.with_texts(out).collect()
        assert sorted((repr((r.doc_id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_text))) for r in texts)) == sorted(
            repr((r[0], plain(r[0], r[1]))) for r in rows)
        assert sorted(repr((r.doc_id, r.restored_text)) for r in texts) == sorted(repr((r[0], r[1] or "")) for r in rows)
        digests = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.with_digests(out).collect()}
        assert digests == {(r.doc_id, hashlib.sha256(r.output_text.encode()).hexdigest(),
                            hashlib.sha256(r.restored_text.encode()).hexdigest()) for r in texts}
        assert {"lang", "source", "n_chars", "n", "form"} <= set(out.columns) and out.columns.count("n") == 1
    assert {r.form for r in texts} == {"plain", "psm", "spm"}
    assert fim.with_digests(fim.fill_in_middle(fim.framed(docs.limit(0)))).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ<>PSM é\n😀", max_size=60), st.integers(1, 9), st.data())
def test_places_and_way_back(text, size, data):
    u = units(text)
    a, b = sorted((data.draw(st.integers(0, len(u))), data.draw(st.integers(0, len(u)))))
    seeker = fim.Seeker(*fim.pack(text, COMPRESS, size), DECOMPRESS)
    assert [seeker.chars_before(seeker.place(k)) for k in range(len(u) + 1)] == [len("".join(u[:k])) for k in range(len(u) + 1)]
    if any(m in text for m in fim.MARKS):
        return
    for form in ("psm", "spm"):
        frames, prefix, middle = fim.transformed(seeker, form, a, b, COMPRESS)
        assert (prefix, middle) == (len("".join(u[:a])), len("".join(u[a:b])))
        assert b"".join(fim.restored(frames, form, DECOMPRESS)).decode() == text


def test_only_cut_frames_are_opened():
    text = prose(5, 20_000)
    opened = []

    def counting(data):
        opened.append(data)
        return DECOMPRESS(data)

    data, ends, chars = fim.pack(text, COMPRESS, 1000)
    frames, *_ = fim.transformed(fim.Seeker(data, ends, chars, counting), "psm", ends[-1] // 3, ends[-1] // 2, COMPRESS)
    assert len(data) > 100 and len(opened) == 2 and len(set(frames) & set(data)) >= len(data) - 2
