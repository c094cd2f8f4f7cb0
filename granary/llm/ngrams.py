"""Interpolated n-gram models over words."""

from __future__ import annotations

import math
from collections import Counter

UNSEEN = 50_000  # words that a model reckons with besides those it has seen
MEMO = 300_000  # trigrams whose surprisal is kept; emptied when full


class NgramModel:
    """Trigrams, bigrams and words interpolated down to a uniform model (Witten-Bell weights)."""

    def __init__(self, sentences=()) -> None:
        self.one: Counter = Counter()
        self.two: Counter = Counter()
        self.three: Counter = Counter()
        for words in sentences:
            first = ["<", *words]
            self.one.update(words)
            self.two.update(zip(first, words))
            self.three.update(zip(["<", *first], first, words))
        self._settle()

    def _settle(self) -> None:
        self.context: Counter = Counter()  # how often something follows a context
        self.after: Counter = Counter()  # how many different words do
        for grams in (self.two, self.three):
            for key, n in grams.items():
                self.context[key[:-1]] += n
                self.after[key[:-1]] += 1
        self.total = sum(self.one.values())
        self.kinds = len(self.one) + 1

    @classmethod
    def of(cls, parts: list[NgramModel]) -> NgramModel:
        """The model of all sentences of ``parts``, from their counts."""
        out = cls()
        for p in parts:
            out.one.update(p.one)
            out.two.update(p.two)
            out.three.update(p.three)
        out._settle()
        return out

    @classmethod
    def counted(cls, three: dict[tuple[str, str, str], int]) -> NgramModel:
        """The model of sentences whose trigrams, begun by "<" twice, are counted."""
        out = cls()
        out.three.update(three)
        for (_, b, c), n in three.items():
            out.two[b, c] += n
            out.one[c] += n
        out._settle()
        return out

    def less(self, part: NgramModel) -> NgramModel:
        """The model of all sentences but those of ``part``."""
        out = NgramModel()
        out.one, out.two, out.three = self.one - part.one, self.two - part.two, self.three - part.three
        out._settle()
        return out

    def surprisal(self, a: str, b: str, c: str) -> float:
        """Bits of word c after words a, b."""
        p = (self.one.get(c, 0) + self.kinds / (self.kinds + UNSEEN)) / (self.total + self.kinds)
        for grams, ctx in ((self.two, (b,)), (self.three, (a, b))):
            n = self.context.get(ctx, 0)
            if n:
                t = self.after[ctx]
                p = (grams.get((*ctx, c), 0) + t * p) / (n + t)
        return -math.log2(p)


class NgramModels:
    """Several models read together: one look-up a trigram gives the surprisal under each."""

    def __init__(self, models: list[NgramModel]) -> None:
        self.models = models
        self.memo: dict[tuple, tuple] = {}

    def __getstate__(self):
        return {**self.__dict__, "memo": {}}

    def trigram(self, key: tuple[str, str, str]) -> tuple[float, ...]:
        if len(self.memo) > MEMO:
            self.memo.clear()
        s = self.memo[key] = tuple(m.surprisal(*key) for m in self.models)
        return s

    def bits(self, words: list[str]) -> list[float]:
        """Bits of a sentence under each model."""
        get, look = self.memo.get, self.trigram
        first = ["<", *words]
        rows = [get(k) or look(k) for k in zip(["<", *first], first, words)]
        return [sum(x) for x in zip(*rows)]
