"""Cosines between names as sums over their words: the kernel of blocking.tfidf_pairs()."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Bytes of word responses that a task remembers.
REMEMBERED = 1 << 25


def word_grams(word: str) -> list[str]:
    """The 2- to 4-grams of a word, padded with a space at each end."""
    w = f" {word} "
    return [w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1)]


class Neighbours:
    """Targets' names, to be searched for the nearest of a name.

    A gram never spans two words, so a name's vector is the sum of its words' vectors, and a cosine is the sum of the response to each word of the other name.
    Responses of a name to all words of the targets are made once; each target then costs one addition a word. Every target is scored.
    """

    def __init__(self, names: Iterable[str], idf: dict[str, float]):
        """names: in the order that decides between equal cosines; idf: of the grams of the vocabulary, others don't count."""
        self.idf = idf
        self.number = {g: i for i, g in enumerate(idf)}
        words: dict[str, int] = {}
        of = [np.array([words.setdefault(w, len(words)) for w in name.split(" ")], np.int32) for name in names]
        vectors = [self.vector([w]) for w in words]
        size = np.fromiter(map(len, (g for g, _ in vectors)), np.int64, len(vectors))
        at = np.concatenate([g for g, _ in vectors]) if vectors else np.zeros(0, np.int64)
        by_gram = np.argsort(at, kind="stable")
        self.starts = np.searchsorted(at[by_gram], np.arange(len(idf) + 1))
        self.words = np.repeat(np.arange(len(vectors)), size)[by_gram]
        self.weights = (np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0))[by_gram]
        self.n_words = len(words)
        # the longest names come first, so that the n-th words of those that have as many stand together
        n = np.fromiter(map(len, of), np.int64, len(of))
        self.order = np.argsort(-n, kind="stable")
        self.columns = [np.array([of[i][j] for i in self.order[: int((n > j).sum())]], np.int32) for j in range(int(n.max(initial=0)))]
        listed = list(words)
        length = np.array([np.sqrt((self.vector([listed[w] for w in of[i]])[1] ** 2).sum()) for i in self.order])
        self.scale = np.divide(1.0, length, out=np.zeros(len(of)), where=length > 0)
        self.remembered: dict[str, np.ndarray] = {}

    def vector(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the grams of the vocabulary, and count * idf of each."""
        found: dict[int, float] = {}
        for w in words:
            for g in word_grams(w):
                if g in self.number:
                    found[self.number[g]] = found.get(self.number[g], 0.0) + self.idf[g]
        return np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.float64, len(found))

    def response(self, word: str) -> np.ndarray:
        """The dot product of the word with every word of the targets."""
        if word not in self.remembered:
            if (len(self.remembered) + 1) * 8 * self.n_words > REMEMBERED:
                self.remembered.clear()
            out = np.zeros(self.n_words)
            for g, w in zip(*self.vector([word]), strict=True):
                part = slice(self.starts[g], self.starts[g + 1])  # a word stands once in a gram's list
                out[self.words[part]] += w * self.weights[part]
            self.remembered[word] = out
        return self.remembered[word]

    def nearest(self, name: str, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k nearest targets with cosine at least `least`, and the cosines, rounded to 6 digits; of equal ones the first in order. A target without a common gram is no neighbour."""
        words = name.split(" ")
        length = np.sqrt((self.vector(words)[1] ** 2).sum())
        if not length or not self.columns:
            return np.zeros(0, np.int64), np.zeros(0)
        response = sum(self.response(w) for w in words)
        cosine = response[self.columns[0]]
        for column in self.columns[1:]:
            cosine[: len(column)] += response[column]
        cosine *= self.scale / length
        low = least
        if len(cosine) > k:
            low = max(low, np.partition(cosine, len(cosine) - k)[len(cosine) - k])
        near = np.flatnonzero((cosine >= low - 2e-6) & (cosine > 0))
        rounded = np.floor(cosine[near] * 1e6 + 0.5) / 1e6
        near, rounded = near[rounded >= least], rounded[rounded >= least]
        best = np.lexsort((self.order[near], -rounded))[:k]
        return self.order[near[best]], rounded[best]
