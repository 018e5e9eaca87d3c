"""SentencePiece encoding and decoding: Aho-Corasick over the pieces drives a single-pass Viterbi.

The automaton reads a text once; at each position it reports, along its output links, every piece that
ends there, and the best score of that position is relaxed from the position where the piece starts.
Where the vocabulary allows no space inside a piece, texts are cut before runs of spaces, which changes no
result, and the short units that repeat are remembered within a worker (a bounded number of them).
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.pieces import MARK, MODEL, UNKNOWN_PENALTY, Vocabulary, automaton, built, load_vocabulary, share

REMEMBERED, SHORT = 1 << 19, 64
LITERAL = "￾"  # in place of a literal mark character while matching: no piece has it


class Codec:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        scores = vocabulary.scores
        self.find = automaton({p: (len(p), i, scores[i]) for p, i in vocabulary.pieces.items()})
        self.single = frozenset(p for p in vocabulary.pieces if len(p) == 1)
        self.unknown = min(scores[i] for i in vocabulary.pieces.values()) - UNKNOWN_PENALTY
        self.splits = vocabulary.splits
        self.units = re.compile(" +[^ ]*|[^ ]+")
        self.seen: dict[str, dict] = {"": {}, " ": {}}

    def best(self, unit: str) -> tuple[tuple[int, ...], float]:
        """Ids and score of the best segmentation; of equal ones, the longest piece at the end wins.

        Characters without a piece may be spelled as bytes, at a score below any piece's. A literal mark
        character is always spelled so, as pieces read it as a space.
        """
        text = unit.replace(MARK, LITERAL).replace(" ", MARK)
        low = -float("inf")
        best, came = [low] * (len(text) + 1), [None] * (len(text) + 1)
        best[0] = 0.0
        if self.single.issuperset(text):
            for end, (n, i, score) in self.find.iter(text):
                new = best[end + 1 - n] + score
                if new > best[end + 1]:
                    best[end + 1], came[end + 1] = new, (n, i)
        else:
            reach = 0  # positions up to here are final but for pieces
            single, unknown = self.single, self.unknown

            def spell(until: int) -> None:
                for at in range(reach, until):
                    if text[at] not in single:
                        new = best[at] + unknown
                        if new > best[at + 1]:
                            best[at + 1], came[at + 1] = new, (1, -1)

            for end, (n, i, score) in self.find.iter(text):
                if end > reach:
                    spell(end)
                    reach = end
                new = best[end + 1 - n] + score
                if new > best[end + 1]:
                    best[end + 1], came[end + 1] = new, (n, i)
            spell(len(text))
        ids, at = [], len(text)
        while at:
            n, i = came[at]
            ids += [i] if i >= 0 else [self.vocabulary.byte_ids[b] for b in reversed(unit[at - 1].encode())]
            at -= n
        return tuple(reversed(ids)), best[-1]

    def _units(self, units: list[str], space: str) -> list[tuple[tuple[int, ...], float]]:
        """Ids and score of each unit, the space put before it; short ones are remembered."""
        seen = self.seen[space]
        if len(seen) >= REMEMBERED:
            seen.clear()
        new = set(units).difference(seen)
        for unit in new:
            seen[unit] = self.best(space + unit)
        found = list(map(seen.__getitem__, units))
        for unit in new:
            if len(unit) > SHORT:
                del seen[unit]
        return found

    def encode(self, text: str) -> list[tuple[tuple[int, ...], float]]:
        """Ids and score of each unit; a space is put before the text, unless it is empty."""
        if not text:
            return []
        if not self.splits:
            return [self.best(" " + text)]
        if "  " in text or text[0] == " ":  # runs of spaces stay together
            return self._units(self.units.findall(" " + text), "")
        return self._units(text.split(" "), " ")

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the space put before it."""
        return b"".join(map(self.vocabulary.surface.__getitem__, ids)).decode(errors="replace")[1:]


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """The rows with ``ids`` (array of int), ``n_pieces`` and ``piece_score`` for their text.

    All other columns stay; columns with these names are replaced. A NULL text gives NULLs, an empty text no
    ids. Every other text is restored by `decode` exactly, whatever characters it has.
    """
    docs = docs.drop("ids", "n_pieces", "piece_score")
    shared = share(docs.sparkSession, load_vocabulary(path))
    place = docs.columns.index("text")

    def work(batches):
        codec = built(shared, Codec)
        for batch in batches:
            parts, scores = [], []
            for text in batch.column(place).to_pylist():
                units = codec.encode(text) if text else []
                pieces, worth = zip(*units) if units else ((), ())
                parts.append(np.fromiter(chain.from_iterable(pieces), np.int32))
                scores.append(None if text is None else float(sum(worth)))
            none = np.array([s is None for s in scores], dtype=bool)
            sizes = np.array([len(p) for p in parts], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])),
                                           mask=pa.array(none))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, ids, pa.array(sizes, mask=none), pa.array(scores, pa.float64())], names=[*batch.schema.names, "ids", "n_pieces", "piece_score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), T.StructField("piece_score", T.DoubleType())])
    return docs.mapInArrow(work, schema)


def decode(coded: DataFrame, path: str = MODEL) -> DataFrame:
    """The rows with ``decoded``, the text of their ``ids``; NULL for NULL, empty for none."""
    coded = coded.drop("decoded")
    shared = coded.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    place = coded.columns.index("ids")

    def work(batches):
        surface = pa.array(shared.value.surface, pa.large_binary())
        for batch in batches:
            ids = batch.column(place)
            spelled = surface.take(ids.flatten())  # its bytes lie one after the other
            at = np.frombuffer(spelled.buffers()[1], np.int64) if len(spelled) else np.zeros(1, np.int64)
            data = spelled.buffers()[2].to_pybytes() if len(spelled) else b""
            ends = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in ids])])
            texts = [data[at[a]:at[b]].decode(errors="replace")[1:] if x.is_valid else None
                     for x, a, b in zip(ids, ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "decoded"])

    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())])
    return coded.mapInArrow(work, schema)


def codec_query(spark, folder: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return decode(encode(docs)).select(
        "doc_id", "n_pieces", "piece_score", "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("exact"))
