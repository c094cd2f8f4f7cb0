"""Problem 8: how demanding a document's prose is to read.

For each graded level an interpolated n-gram model is trained; every sentence of a document gets its
surprisal under each. The distribution over all its sentences (mean, deviation, upper tail, and the level that
each sentence speaks for) is weighed into one difficulty score, and isotonic regression maps scores to the graded scale,
monotonically. Both are fitted on documents that the models of their fold have not seen. All graded documents take part: tasks
count and sum, and what comes to the driver are counts of trigrams, sums and steps.
"""

from __future__ import annotations

import math
import re
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.counts import collected, tally
from granary.llm.ngrams import NgramModel, NgramModels
from granary.llm.pairs import prose
from granary.llm.sampling import hash_sample
from granary.session import discard, materialize, table

LEVELS = ("beginner", "intermediate", "advanced")  # fixed values: the scale of level_labels, ascending
GRADED_SAMPLE = 3_000  # graded documents that graded_sample() brings to the driver, in the order of a hash of the id
FOLDS = 4
LONGEST_GRADED = 50_000  # characters of a graded document there
FIGURES = 4  # of a profile
UNIT = 1 << 20  # figures are summed as whole multiples of 1 / UNIT, so that the order of rows can't change a sum
BROADCAST_IDS = 500_000
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+|\n+")
_WORDS = re.compile(r"\w+(?:'\w+)?|[,]")
_MARK = re.compile(r"^\s*(?:#{1,6}\s.*|[-*+•]\s+|\d+[.)]\s+|>\s*)")


def sentences(text: str) -> list[list[str]]:
    """Sentences of the prose of ``text`` as lower-case words; headings, code and lines without words are left out."""
    out = []
    for part in _SENTENCE.split(prose(text)):
        part = _MARK.sub("", part)
        words = ["9" if w.isdigit() else "_" if "_" in w else w for w in _WORDS.findall(part.lower())]
        if len(words) >= 3 and sum(w.isalpha() for w in words) >= 0.6 * len(words):
            out.append(words)
    return out


def profile(text: list[list[str]], models: NgramModels) -> tuple[float, float, float, float] | None:
    """(expected level, mean surprisal, its deviation, its mean in the hardest tenth) of a document; None without prose.

    Surprisal of a sentence is in bits a word under the mixture of the levels' models; its distribution is that over all
    sentences, weighted by their words. The expected level (0 lowest) of a sentence follows from its surprisals under each.
    """
    if not text:
        return None
    b = np.array([models.bits(words) for words in text])
    w = np.array([len(words) for words in text], float)
    low = b.min(axis=1, keepdims=True)
    p = np.exp2(np.maximum(-60.0, low - b))
    total = p.sum(axis=1)
    level = p @ np.arange(b.shape[1]) / total
    bits = (low[:, 0] - np.log2(total / b.shape[1])) / w
    mean = float(np.average(bits, weights=w))
    order = np.argsort(-bits, kind="stable")
    share = np.minimum(w[order], np.maximum(0.1 * w.sum() - (np.cumsum(w[order]) - w[order]), 0))
    return float(np.average(level, weights=w)), mean, float(np.sqrt(np.average((bits - mean) ** 2, weights=w))), float(np.average(bits[order], weights=share))


def pooled(blocks) -> list[list[float]]:
    """Ascending steps of ``blocks`` (sum, count, first x, last x; ascending in x): neighbours out of order become one.

    Steps of parts of the blocks may stand for them: what is one step in a part is one in the whole.
    """
    out: list[list[float]] = []
    for b in blocks:
        out.append(list(b))
        while len(out) > 1 and out[-2][0] / out[-2][1] >= out[-1][0] / out[-1][1]:
            s, n, _, last = out.pop()
            out[-1][0] += s
            out[-1][1] += n
            out[-1][3] = last
    return out


def steps(blocks) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the ascending steps of ``blocks``."""
    found = pooled(blocks)
    return np.array([(b[2] + b[3]) / 2 for b in found]), np.array([b[0] / b[1] for b in found])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending steps (positions, values) closest to ``y`` in squares: pool adjacent violators."""
    order = np.argsort(x, kind="stable")
    same = ((k, [float(v) for _, v in g]) for k, g in groupby(zip(x[order].tolist(), y[order]), lambda p: p[0]))
    return steps((sum(v), float(len(v)), k, k) for k, v in same)


def median(counts: dict[float, int]) -> float:
    """The median of values that come so often."""
    n, before, middle = sum(counts.values()), 0, []
    for v in sorted(counts):
        middle += [v] * sum(before <= k < before + counts[v] for k in ((n - 1) // 2, n // 2))
        before += counts[v]
    return sum(middle) / 2


class Grader:
    """Models by level and the map from profiles to levels, from (text, level number) of graded documents.

    Sentences are counted once, by fold and level; the models of all folds but one are sums of counts. A
    profile's figures are weighed into one score by least squares, and isotonic regression maps scores to levels.
    Both are fitted on profiles under models that haven't seen the document. ``folds``: the fold of each document, by turns unless given.
    """

    def __init__(self, graded: list[tuple[str, float]], folds: list[int] | None = None) -> None:
        texts = [(sentences(t), y) for t, y in graded]
        folds = [f for f, (t, _) in zip(folds, texts) if t] if folds else None
        texts = [(t, y) for t, y in texts if t]
        self._empty()
        if not texts:
            return
        of = lambda fold: texts[fold::FOLDS] if folds is None else [x for f, x in zip(folds, texts) if f == fold]
        counted = [[NgramModel(words for t, y in of(fold) if abs(y - level) < 0.5 for words in t) for level in range(len(LEVELS))] for fold in range(FOLDS)]
        profiles, levels = [], []
        for fold in range(FOLDS):
            models = self._others(counted, fold)
            for t, y in of(fold):
                profiles.append(profile(t, models))
                levels.append(y)
        a = np.column_stack([np.round(np.array(profiles) * UNIT) / UNIT, np.ones(len(profiles))])
        self._weigh(a.T @ a, a.T @ np.array(levels))
        self.x, self.y = isotonic(a @ self.weights, np.array(levels))
        self._settle(counted, float(np.median(levels)))

    @classmethod
    def of(cls, documents: DataFrame, labels: DataFrame) -> Grader:
        """The grader fitted on every graded row of ``documents`` (doc_id, text); ``labels`` (doc_id, level) grades them.

        No text comes to the driver. A document's fold follows from its id. Nothing depends on the order or the partitions of rows.
        """
        votes = _votes(labels)
        few = votes.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
        rows = materialize(documents.select("doc_id", "text").where("text <> ''").join(F.broadcast(votes) if few else votes, "doc_id").select(fold.alias("fold"), "y", "text"), "graded")
        self = cls.__new__(cls)
        self._empty()
        counted = _counted(rows)
        profiles = materialize(_profiles(rows, [cls._others(counted, f) for f in range(FOLDS)]), "profiles")
        levels = {r["y"]: r["count"] for r in profiles.groupBy("y").count().collect()}
        if levels:
            self._weigh(*_products(profiles))
            self.x, self.y = steps(_blocks(profiles, self.weights))
            self._settle(counted, median(levels))
        discard(profiles)
        discard(rows)
        return self

    def _empty(self) -> None:
        self.models: NgramModels | None = None
        self.x, self.y, self.weights = np.zeros(0), np.zeros(0), np.zeros(FIGURES + 1)

    @staticmethod
    def _others(counted: list[list[NgramModel]], fold: int) -> NgramModels:
        return NgramModels([NgramModel.of([counted[f][level] for f in range(FOLDS) if f != fold]) for level in range(len(LEVELS))])

    def _weigh(self, products: np.ndarray, targets: np.ndarray) -> None:
        # a little ridge, so that few documents don't leave the weights open
        self.weights = np.linalg.solve(products + 1e-3 * np.eye(len(products)), targets)

    def _settle(self, counted: list[list[NgramModel]], middle: float) -> None:
        self.models = NgramModels([NgramModel.of([c[level] for c in counted]) for level in range(len(LEVELS))])
        self.usual = LEVELS[int(round(middle))]

    def score(self, figures: tuple[float, float, float, float] | None) -> float | None:
        return None if figures is None else float(np.dot(self.weights, (*figures, 1.0)))

    def grade(self, score: float | None) -> str | None:
        if not len(self.x):
            return None
        if score is None:
            return self.usual
        return LEVELS[min(len(LEVELS) - 1, max(0, math.floor(float(np.interp(score, self.x, self.y)) + 0.5)))]


def _votes(labels: DataFrame) -> DataFrame:
    """Level number ``y`` of each graded ``doc_id``: the median of its raters."""
    number = F.array_position(F.array(*map(F.lit, LEVELS)), F.lower(F.trim("level"))) - 1
    return labels.where("level IS NOT NULL AND doc_id IS NOT NULL").withColumn("y", number).where("y >= 0").groupBy("doc_id").agg(F.median("y").alias("y"))


def _counted(rows: DataFrame) -> list[list[NgramModel]]:
    """Models by fold and level of all sentences of ``rows`` (fold, y, text)."""

    def add(counters, folds, levels, texts):
        for fold, y, text in zip(folds, levels, texts):
            for level in range(len(LEVELS)):
                if abs(y - level) < 0.5:
                    three = counters[fold * len(LEVELS) + level]
                    for words in sentences(text):
                        first = ["<", *words]
                        three.update(zip(["<", *first], first, words))

    found = collected(tally(rows.select("fold", "y", "text"), add, FOLDS * len(LEVELS), " ".join))
    keys = [tuple(r[0].split(" ")) for r in found]
    return [[NgramModel.counted({k: r[1 + at] for k, r in zip(keys, found) if r[1 + at]}) for at in range(f * len(LEVELS), (f + 1) * len(LEVELS))] for f in range(FOLDS)]


def _profiles(rows: DataFrame, models: list[NgramModels]) -> DataFrame:
    """Profiles ``f0``, ... (in multiples of 1 / UNIT) and ``y`` of ``rows`` with prose, each under the models of its fold."""

    def of(fold: int) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(models[fold])

        def run(batches):
            for batch in batches:
                found = [(profile(sentences(t), shared.value), y) for y, t in zip(*(c.to_pylist() for c in batch.columns))]
                figures = [[round(v * UNIT) for v in p] + [y] for p, y in found if p]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in figures], pa.int64() if k < FIGURES else pa.float64()) for k in range(FIGURES + 1)], names=[*names, "y"])

        return rows.where(F.col("fold") == fold).select("y", "text").mapInArrow(run, ", ".join([*(f"{x} BIGINT" for x in names), "y DOUBLE"]))

    names = [f"f{k}" for k in range(FIGURES)]
    out = of(0)
    for fold in range(1, FOLDS):
        out = out.union(of(fold))
    return out


def _products(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all profiles of the products of their figures (and 1), and of these with the level: whole numbers, so exact."""
    whole = lambda c: c.cast("decimal(16,0)")
    x = [*(whole(F.col(f"f{k}")) for k in range(FIGURES)), whole(F.lit(UNIT)), whole(F.col("y") * UNIT)]
    at = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    sums = profiles.agg(*(F.sum(x[i] * x[j]) for i, j in at)).first()
    full = np.zeros((len(x), len(x)))
    for (i, j), v in zip(at, sums):
        full[i, j] = full[j, i] = int(v) / UNIT**2
    return full[:-1, :-1], full[:-1, -1]


def _blocks(profiles: DataFrame, weights: np.ndarray) -> list[tuple]:
    """Steps of each range of scores, ascending; pooled once more they are those of all profiles."""
    score = F.lit(float(weights[-1]))
    for k in range(FIGURES):
        score = score + F.lit(float(weights[k])) * (F.col(f"f{k}") / F.lit(float(UNIT)))
    same = profiles.select(score.alias("x"), "y").groupBy("x").agg(F.sum("y").alias("s"), F.count("*").cast("double").alias("n"))

    def run(batches):
        found = pooled(chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches))
        yield pa.RecordBatch.from_arrays([pa.array([b[k] for b in found], pa.float64()) for k in range(4)], names=["s", "n", "a", "b"])

    return sorted(map(tuple, same.orderBy("x").select("s", "n", "x", F.col("x").alias("b")).mapInArrow(run, "s DOUBLE, n DOUBLE, a DOUBLE, b DOUBLE").collect()), key=lambda b: b[2])


def graded_sample(documents: DataFrame, labels: DataFrame, most: int = GRADED_SAMPLE) -> list[tuple[str, float]]:
    """Text and mean level number of at most ``most`` graded documents, in the order of a hash of the id.

    For fits on the driver; the queries fit on all rows (:meth:`Grader.of`).
    Documents of over ``LONGEST_GRADED`` characters are left out, so that what comes to the driver is bounded.
    """
    chosen = hash_sample(_votes(labels), "doc_id", most).select("doc_id", "y", "_k")
    rows = documents.select("doc_id", "text").where(F.char_length("text") <= LONGEST_GRADED).join(F.broadcast(chosen), "doc_id").orderBy("_k", "text").collect()
    return [(r["text"], float(r["y"])) for r in rows]


def reading_levels(documents: DataFrame, grader: Grader, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score (about 0 easiest to 2), surprisal and surprisal_sd (bits a word), level of every row.

    Texts without prose (null, empty, code alone) have null figures and the usual level of the graded
    documents; without graded documents every level is null. Repeated rows stay repeated. No shuffle. A worker reads the
    grader once, however many tasks it runs.
    """
    shared = documents.sparkSession.sparkContext.broadcast(grader)

    def run(batches):
        grader = shared.value
        for batch in batches:
            rows = [profile(sentences(t), grader.models) if t and grader.models else None for t in batch.column(1).to_pylist()]
            scores = [grader.score(r) for r in rows]
            figures = [pa.array(scores, pa.float64()), *(pa.array([r and r[k] for r in rows], pa.float64()) for k in (1, 2))]
            levels = pa.array([grader.grade(x) for x in scores], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *figures, levels], names=[id_col, "score", "surprisal", "surprisal_sd", "level"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score DOUBLE, surprisal DOUBLE, surprisal_sd DOUBLE, level STRING")


def p8_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "level_labels")
    return reading_levels(documents, Grader.of(documents, labels))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "level_labels")
    wanted = labels.where("level IS NULL").select("doc_id").distinct()
    few = wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ungraded = documents.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
    return reading_levels(ungraded, Grader.of(documents, labels)).select("doc_id", "level")
