"""A public subword vocabulary, read on the driver, and its automaton in the workers."""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass

import ahocorasick
import sentencepiece

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space in pieces
TINY = 1e-200  # a word less likely than that is computed in logarithms
UNKNOWN_PENALTY = 10.0  # below the lowest score, for characters that only bytes can spell


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id. ``surface`` has the bytes a piece stands for, with spaces as spaces."""

    pieces: dict[str, int]
    scores: list[float]
    byte_ids: list[int]
    surface: list[bytes]

    @property
    def splits(self) -> bool:
        """Whether a space can only begin a piece, so that texts may be cut before spaces."""
        return not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces, scores and byte pieces of a model file; control and unused pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, surface = {}, [-1] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            surface.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            surface.append(b"")
        else:
            pieces[piece] = i
            surface.append(piece.replace(MARK, " ").encode())
    return Vocabulary(pieces, [model.get_score(i) for i in range(model.get_piece_size())], byte_ids, surface)


def automaton(values: dict[str, tuple]) -> ahocorasick.Automaton:
    """Aho-Corasick automaton over pieces with a value each."""
    found = ahocorasick.Automaton()
    for piece, value in values.items():
        found.add_word(piece, value)
    found.make_automaton()
    return found


_BUILT: dict = {}


def share(spark, value):
    """Broadcast a value for `built`, under a token of its own."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, value))


def built(shared, build):
    """``build`` of a value broadcast by `share`, made once in a worker process and kept for its next tasks.

    It is known by the token sent along: a broadcast's address in the worker is used again by later ones.
    """
    token, value = shared.value
    key = (build.__qualname__, token)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = build(value)
    return _BUILT[key]


class Lattice:
    """All segmentations of a word into weighted pieces, by forward recursion in log space.

    ``weights`` are log probabilities by piece id. Characters without a piece of their own may also be
    spelled by their bytes.
    """

    def __init__(self, given: tuple[Vocabulary, list[float]]):
        self.vocabulary, self.weights = given
        weights = self.weights
        self.find = automaton({p: (len(p), i, weights[i], math.exp(weights[i])) for p, i in self.vocabulary.pieces.items()})
        self.single = frozenset(p for p in self.vocabulary.pieces if len(p) == 1)

    def arcs(self, word: str) -> list[tuple[int, int, float, tuple[int, ...]]]:
        """(start, end, weight, pieces) in order of the end."""
        arcs = [(end + 1 - n, end + 1, w, (i,)) for end, (n, i, w, _) in self.find.iter(word)]
        if not self.single.issuperset(word):
            for at, c in enumerate(word):
                if c not in self.single:
                    spelled = tuple(self.vocabulary.byte_ids[b] for b in c.encode())
                    arcs.append((at, at + 1, sum(self.weights[i] for i in spelled), spelled))
            arcs.sort(key=lambda a: a[1])
        return arcs

    def forward(self, word: str, arcs=None) -> list[float]:
        """Log probability of each prefix, over all its segmentations."""
        exp, log1p = math.exp, math.log1p
        total = [-math.inf] * (len(word) + 1)
        total[0] = 0.0
        for start, end, w, _ in self.arcs(word) if arcs is None else arcs:
            new, old = total[start] + w, total[end]
            if old == -math.inf:
                total[end] = new
            elif new != -math.inf:
                total[end] = old + log1p(exp(new - old)) if old > new else new + log1p(exp(old - new))
        return total

    def log_probability(self, word: str) -> float:
        if not self.single.issuperset(word):
            return self.forward(word)[-1]
        chance = [1.0] + [0.0] * len(word)
        for end, (n, _, _, p) in self.find.iter(word):
            chance[end + 1] += chance[end + 1 - n] * p
        if chance[-1] > TINY:
            return math.log(chance[-1])
        # every character is a piece, so each prefix has a segmentation once its last character is reached
        exp, log1p, low = math.exp, math.log1p, -math.inf
        total = [low] * (len(word) + 1)
        total[0] = 0.0
        for end, (n, _, w, _) in self.find.iter(word):
            new, old = total[end + 1 - n] + w, total[end + 1]
            if old == low:
                total[end + 1] = new
            elif old > new:
                total[end + 1] = old + log1p(exp(new - old))
            else:
                total[end + 1] = new + log1p(exp(old - new))
        return total[-1]

    def _expected_of_short(self, word: str, times: float, counts: list[float]) -> bool:
        """`expected` with plain probabilities, for words of pieces only; False, and nothing added, if they get too small."""
        arcs = [(end + 1 - n, end + 1, p, i) for end, (n, i, _, p) in self.find.iter(word)]
        ahead = [1.0] + [0.0] * len(word)
        for start, end, p, _ in arcs:
            ahead[end] += ahead[start] * p
        if not ahead[-1] > TINY:
            return False
        back = [0.0] * len(word) + [times / ahead[-1]]
        for start, end, p, i in reversed(arcs):
            tail = p * back[end]
            counts[i] += ahead[start] * tail
            back[start] += tail
        return True

    def expected(self, word: str, times: float, counts: list[float]) -> None:
        """Add the expected uses of each piece in so many occurrences of the word."""
        exp, log1p, low = math.exp, math.log1p, -math.inf
        spelled = not self.single.issuperset(word)
        if not spelled and self._expected_of_short(word, times, counts):
            return
        arcs = self.arcs(word) if spelled else [(end + 1 - n, end + 1, w, i) for end, (n, i, w, _) in self.find.iter(word)]
        ahead = self.forward(word, arcs)
        whole = ahead[-1]
        back = [low] * (len(word) + 1)
        back[-1] = 0.0
        for start, end, w, pieces in reversed(arcs):
            tail = back[end]
            if tail == low:
                continue
            new, old = w + tail, back[start]
            use = ahead[start] + new - whole  # all arcs from its end on have been seen
            if use > -40:
                use = times * exp(use)
                if spelled:
                    for i in pieces:
                        counts[i] += use
                else:
                    counts[pieces] += use
            if old == low:
                back[start] = new
            elif old > new:
                back[start] = old + log1p(exp(new - old))
            else:
                back[start] = new + log1p(exp(old - new))
