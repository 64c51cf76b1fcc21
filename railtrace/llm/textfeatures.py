"""Hashed character n-grams of a text's distinct words, for the linear classifiers.

A text's features are the character n-grams (with word borders) of its distinct
words, hashed into ``2 ** BITS`` places, so a linear score is a sum of word
scores over the square root of their number.  Word scores are kept per Python worker, up to a
bound; sums are exactly rounded, so neither batches nor order change a score.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

import numpy as np

BITS = 18
LENGTHS = (3, 4, 5)
MAX_CACHED_WORDS = 400_000
SLICE = 50_000  # words that are hashed at once
PART = 1 << 20  # n-grams that a pass over them takes at once
TEXTS = 512  # texts whose words are held at once

_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def hashed_ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, places): the n-gram places of word i are places[starts[i]:starts[i + 1]]."""
    data = [f" {w} ".encode("utf-8", "surrogatepass") for w in words]
    size = np.array([len(d) for d in data], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    text = np.frombuffer(b"".join(data) + bytes(max(LENGTHS)), dtype=np.uint8).astype(np.uint64)
    total = int(start[-1])
    word = np.repeat(np.arange(len(words)), size)
    end = start[1:][word]
    at = np.arange(total)
    rolled = np.zeros(total, dtype=np.uint64)
    owners, places = [], []
    for n in range(1, max(LENGTHS) + 1):
        rolled = rolled * _STEP + text[n - 1:n - 1 + total] + np.uint64(n)
        if n in LENGTHS:
            fits = at + n <= end
            mixed = rolled[fits]
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
            places.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
            owners.append(word[fits])
    owner, place = np.concatenate(owners), np.concatenate(places)
    by = np.argsort(owner, kind="stable")
    return np.searchsorted(owner[by], np.arange(len(words) + 1)), place[by]


class WordScores(dict):
    """Scores of words under a weight vector."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights.astype(np.float64)

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > MAX_CACHED_WORDS:
            self.clear()
            new = list(words)
        for i in range(0, len(new), SLICE):
            part = new[i:i + SLICE]
            starts, places = hashed_ngrams(part)
            self.update(zip(part, np.add.reduceat(self.weights[places], starts[:-1]).tolist()))

    def sums(self, texts: list[str | None], words_of: Callable[[str], set[str]]) -> list[float]:
        """The scaled score of each text; 0 for one without words."""
        out = []
        for i in range(0, len(texts), TEXTS):
            sets = [words_of(t) if t else set() for t in texts[i:i + TEXTS]]
            self.learn(set().union(*sets))
            out += [math.fsum(map(self.__getitem__, s)) / math.sqrt(len(s)) if s else 0.0 for s in sets]
        return out


class Design:
    """The feature matrix of texts, as texts by words and words by n-gram places."""

    def __init__(self, sets: Iterable[set[str]]):
        number: dict[str, int] = {}  # one text's words are held at a time
        rows = [np.array([number.setdefault(w, len(number)) for w in sorted(s)], dtype=np.int32) for s in sets]
        self.n, self.n_words = len(rows), len(number)
        size = np.array([len(r) for r in rows], dtype=np.int64)
        self.text_words = np.concatenate([*rows, np.zeros(0, np.int32)])
        self.text_of = np.repeat(np.arange(self.n, dtype=np.int32), size)
        self.scale = np.where(size > 0, 1 / np.sqrt(np.maximum(1, size)), 0.0)
        words, places, counts = list(number), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        del rows, number
        for i in range(0, self.n_words, SLICE):
            starts, part = hashed_ngrams(words[i:i + SLICE])
            places.append(part)
            counts.append(np.diff(starts))
        self.places = np.concatenate(places)
        self.owner = np.repeat(np.arange(self.n_words, dtype=np.int32), np.concatenate(counts))

    def _parts(self):
        """The n-grams in slices, so that what is computed for each of them stays small."""
        return [slice(i, i + PART) for i in range(0, len(self.places), PART)]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        word = np.zeros(self.n_words)
        for part in self._parts():
            first = self.owner[part.start]
            sums = np.bincount(self.owner[part] - first, weights=weights[self.places[part]])
            word[first:first + len(sums)] += sums
        return np.bincount(self.text_of, weights=word[self.text_words], minlength=self.n) * self.scale

    def gradient(self, slopes: np.ndarray, scaled: bool = True) -> np.ndarray:
        """The sum of the texts' features, each times its slope."""
        slopes = slopes * self.scale if scaled else slopes
        word = np.bincount(self.text_words, weights=slopes[self.text_of], minlength=self.n_words)
        out = np.zeros(1 << BITS)
        for part in self._parts():
            out += np.bincount(self.places[part], weights=word[self.owner[part]], minlength=1 << BITS)
        return out


class Adam:
    """Steps of the Adam rule for one parameter array."""

    def __init__(self, shape, rate: float = 0.05):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, gradient):
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient * gradient
        return self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.99 ** self.t)) + 1e-8)
