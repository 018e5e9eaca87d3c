"""Fill-in-the-middle documents from seekable compressed frames.

A text is kept as zstandard frames that can be read alone, with the units and characters up to the end of each.
To find the place of a unit only the frame that holds it is decompressed. The transformed text is again a
list of frames: whole frames move as they are, and only the parts of cut frames and the marks around them are
compressed anew. Digests and the way back read frame after frame, so no step holds more than one frame of a
text in the clear.

Units are runs of the letters A-Z and a-z, and single other characters. A frame may end inside a run, which
then counts where it began; how many units begin in a frame tells whether its first letters belong to the
frame before.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.base import saved

FRAME = 1 << 16  # characters in a frame
LEVEL = 3
MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix, middle
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
_FRAMES = T.ArrayType(T.BinaryType())
_ENDS = T.ArrayType(T.LongType())


def begins(text: str, continued: bool) -> np.ndarray:
    """At which characters a unit begins; ``continued``: the character before the text is a letter."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = (codes | np.uint32(32)) - np.uint32(97) < 26
    return ~(letter & np.r_[continued, letter[:-1]])


def pack(text: str, compress, size: int = FRAME) -> tuple[list[bytes], list[int], list[int]]:
    """Frames of a text, and the units and characters up to the end of each."""
    data, units, chars, total = [], [], [], 0
    for at in range(0, len(text), size):
        part = text[at:at + size]
        before = text[at - 1] if at else " "
        total += int(begins(part, before.isascii() and before.isalpha()).sum())
        data.append(compress(part.encode()))
        units.append(total)
        chars.append(at + len(part))
    return data, units, chars


class Seeker:
    """Places of units in a framed text; the frames that hold asked-for units are decompressed, no others."""

    def __init__(self, data: list[bytes], units: list[int], chars: list[int], decompress):
        self.data, self.units, self.chars, self.decompress = data, units, chars, decompress
        self.opened: dict[int, str] = {}

    def text(self, frame: int) -> str:
        if frame not in self.opened:
            self.opened[frame] = self.decompress(self.data[frame]).decode()
        return self.opened[frame]

    def place(self, unit: int) -> tuple[int, int]:
        """(frame, character in it) at which the unit begins; the end for the number of all units."""
        frame = bisect_right(self.units, unit)
        if frame == len(self.data):
            return frame, 0
        before = self.units[frame - 1] if frame else 0
        starts = np.flatnonzero(begins(self.text(frame), False))
        if len(starts) > self.units[frame] - before:  # its first letters go on with a run of the frame before
            starts = starts[1:]
        return frame, int(starts[unit - before])

    def chars_before(self, place: tuple[int, int]) -> int:
        frame, at = place
        return (self.chars[frame - 1] if frame else 0) + at

    def parts(self, start: tuple[int, int], end: tuple[int, int]) -> Iterator[tuple[bytes, bool]]:
        """What lies between two places: (bytes, whether they are a whole frame, still compressed)."""
        (i, x), (j, y) = start, end
        while i < j:
            yield (self.text(i)[x:].encode(), False) if x else (self.data[i], True)
            i, x = i + 1, 0
        if y > x:
            yield self.text(i)[x:y].encode(), False


def write(parts: Iterator[tuple[bytes, bool]], compress) -> list[bytes]:
    """Frames in order; neighbouring parts in the clear become one frame."""
    out, clear = [], []
    for data, framed in parts:
        if not framed:
            clear.append(data)
            continue
        if clear:
            out.append(compress(b"".join(clear)))
            clear = []
        out.append(data)
    if clear:
        out.append(compress(b"".join(clear)))
    return out


def transformed(text: Seeker, form: str, first: int, second: int, compress) -> tuple[list[bytes], int | None, int | None]:
    """(frames of the output, characters of the prefix, of the middle) for cuts before the given units."""
    if form == "plain":
        return text.data, None, None
    a, b, start, end = text.place(first), text.place(second), (0, 0), (len(text.data), 0)
    sides = {"prefix": (MARKS[0], start, a), "suffix": (MARKS[1], b, end), "middle": (MARKS[2], a, b)}

    def parts():
        for side in ("prefix", "suffix", "middle") if form == "psm" else ("suffix", "prefix", "middle"):
            mark, x, y = sides[side]
            yield mark.encode(), False
            yield from text.parts(x, y)

    prefix = text.chars_before(a)
    return write(parts(), compress), prefix, text.chars_before(b) - prefix


def _slices(frames: list[bytes], ranges: list[tuple[int, int]], ends: list[int], decompress) -> Iterator[bytes]:
    """Byte ranges of the text in the frames, in the order asked for."""
    for start, end in ranges:
        frame = bisect_right(ends, start)
        while start < end:
            base = ends[frame - 1] if frame else 0
            stop = min(end, ends[frame])
            yield decompress(frames[frame])[start - base:stop - base]
            start, frame = stop, frame + 1


def restored(frames: list[bytes], form: str, decompress) -> Iterator[bytes]:
    """The original text in pieces, from the output and its form alone."""
    if form == "plain":
        yield from map(decompress, frames)
        return
    marks, at, ends, size, tail = [m.encode() for m in MARKS], {}, [], 0, b""
    for frame in frames:  # where each mark is; it may lie across frames
        data = decompress(frame)
        window = tail + data
        for mark in marks:
            if mark not in at and (found := window.find(mark)) >= 0:
                at[mark] = size - len(tail) + found
        size += len(data)
        ends.append(size)
        tail = window[-2:]
    places = sorted(at.values())
    stop = {p: q for p, q in zip(places, [*places[1:], size])}
    yield from _slices(frames, [(at[m] + 3, stop[at[m]]) for m in (marks[0], marks[2], marks[1])], ends, decompress)


def _fields(df: DataFrame, *names: str) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in names]


def framed(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """The rows with ``frames``, ``unit_ends``, ``char_ends`` and ``has_marks`` in place of ``text``; others stay.

    NULL is framed like an empty text, without frames. Columns with these names are replaced.
    """
    added = ("frames", "unit_ends", "char_ends", "has_marks")
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(text, F.lit(MARKS[0])) | F.contains(text, F.lit(MARKS[1])) | F.contains(text, F.lit(MARKS[2]))
    docs = docs.drop(*added).withColumns({"text": text, "has_marks": marked})
    place = docs.columns.index("text")
    fields = _fields(docs, "text")

    def work(batches):
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            packed = [pack(t, compress, size) for t in batch.column(place).to_pylist()]
            others = [c for i, c in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array([p[0] for p in packed], pa.list_(pa.binary())),
                 *(pa.array([p[i] for p in packed], pa.list_(pa.int64())) for i in (1, 2))],
                names=[*(f.name for f in fields), "frames", "unit_ends", "char_ends"])

    return docs.mapInArrow(work, T.StructType([*fields, T.StructField("frames", _FRAMES), T.StructField("unit_ends", _ENDS),
                                               T.StructField("char_ends", _ENDS)]))


def draws(doc_id: Column) -> list[Column]:
    """Four numbers below 2^32 from the hash of a doc_id; NULL has the hash of ``null``."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(store: DataFrame, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """The rows of `framed` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` (frames) instead of the frames.

    Two hash-random units, the same for equal doc_id and length, are the cuts. ``form`` is plain for empty texts, for
    texts that hold a mark already and for a hash-random share; else spm for a share, and psm. The counts are
    NULL if plain. Rows with repeated or NULL doc_id are rows like any other; an empty table gives an empty result.
    """
    kept = [f.name for f in _fields(store, "frames", "unit_ends", "char_ends", "has_marks", "n", "form", "prefix_chars",
                                    "middle_chars", "output")]
    h1, h2, h3, h4 = draws(F.col("doc_id"))
    n = F.when(F.size("unit_ends") > 0, F.element_at("unit_ends", -1)).otherwise(F.lit(0).cast("long"))
    plain = (F.size("frames") == 0) | F.col("has_marks") | (h3 % 100 >= plain_from)
    rows = store.select(
        *kept, "frames", "unit_ends", "char_ends", n.alias("n"),
        F.when(plain, "plain").when(h4 % 100 < spm_below, "spm").otherwise("psm").alias("form"),
        F.least(h1 % (n + 1), h2 % (n + 1)).alias("_first"), F.greatest(h1 % (n + 1), h2 % (n + 1)).alias("_second"))
    at = {c: i for i, c in enumerate(rows.columns)}

    def work(batches):
        compress, decompress = zstandard.ZstdCompressor(level=LEVEL).compress, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            asked = [batch.column(at[c]).to_pylist() for c in ("frames", "unit_ends", "char_ends", "form", "_first", "_second")]
            made = [transformed(Seeker(data, units, chars, decompress), form, first, second, compress)
                    for data, units, chars, form, first, second in zip(*asked)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at[c]) for c in (*kept, "n", "form")),
                 pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64()),
                 pa.array([m[0] for m in made], pa.list_(pa.binary()))],
                names=[*kept, "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(work, T.StructType([
        *(store.schema[c] for c in kept), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", _FRAMES)]))


def _from_output(rows: DataFrame, added: list[T.StructField], make) -> DataFrame:
    """The rows without ``output``, with columns made from it and ``form``."""
    fields = _fields(rows, "output", *(f.name for f in added))
    place = {c: i for i, c in enumerate(rows.columns)}

    def work(batches):
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            made = [make(frames, form, decompress) for frames, form in zip(
                batch.column(place["output"]).to_pylist(), batch.column(place["form"]).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(place[f.name]) for f in fields), *(pa.array([m[i] for m in made], pa.string()) for i in range(len(added)))],
                names=[f.name for f in (*fields, *added)])

    return rows.mapInArrow(work, T.StructType([*fields, *added]))


def with_texts(rows: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` with ``output_text`` and ``restored_text`` in place of the frames."""
    def make(frames, form, decompress):
        return b"".join(map(decompress, frames)).decode(), b"".join(restored(frames, form, decompress)).decode()

    return _from_output(rows, [T.StructField("output_text", T.StringType()), T.StructField("restored_text", T.StringType())], make)


def with_digests(rows: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` with ``output_sha256`` and ``restored_sha256``, streamed from the frames, in their place."""
    def make(frames, form, decompress):
        digests = []
        for pieces in (map(decompress, frames), restored(frames, form, decompress)):
            digest = hashlib.sha256()
            for piece in pieces:
                digest.update(piece)
            digests.append(digest.hexdigest())
        return digests

    return _from_output(rows, [T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())], make)


def fim_query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    store = saved(framed(docs), "fim-frames")
    return with_digests(fill_in_middle(store)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


FIM_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
k AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM k),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf
  FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
