"""Counts over whole tables, for models that are fitted on every row."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.ngrams import NgramModel

MOST_KEYS = 200_000  # keys that a task holds before it passes on what it has counted


def tally(rows: DataFrame, add: Callable, fields: int = 1, spell: Callable = str, spread: Callable | None = None) -> DataFrame:
    """``key`` with the sums ``n0``, ``n1``, ... of what ``add`` counts over all rows.

    ``add(counters, *columns)`` gets ``fields`` counters and the values of a batch; ``spell`` writes a key as a text,
    ``spread`` makes of a counter the one that is passed on. Tasks count on their own, only keys with their counts are shuffled.
    """
    names = [f"n{i}" for i in range(fields)]
    schema = pa.schema([("key", pa.string()), *((x, pa.int64()) for x in names)])

    def run(batches):
        counters = [Counter() for _ in names]

        def out():
            found = [spread(c) for c in counters] if spread else counters
            keys = list(dict.fromkeys(k for c in found for k in c))
            part = pa.RecordBatch.from_arrays([pa.array([spell(k) for k in keys], pa.string()), *(pa.array([c.get(k, 0) for k in keys], pa.int64()) for c in found)], schema=schema)
            for c in counters:
                c.clear()
            return part

        for batch in batches:
            add(counters, *(c.to_pylist() for c in batch.columns))
            if sum(map(len, counters)) > MOST_KEYS:
                yield out()
        yield out()

    return rows.mapInArrow(run, ", ".join(["key STRING", *(f"{x} BIGINT" for x in names)])).groupBy("key").agg(*(F.sum(x).alias(x) for x in names))


def collected(sums: DataFrame) -> list[tuple]:
    """Rows (key, n0, ...) of ``sums``."""
    found = sums.toArrow()
    return list(zip(*(c.to_pylist() for c in found.columns)))


def trigram_model(rows: DataFrame, sentences: Callable) -> NgramModel:
    """The model of all sentences of ``rows``: ``sentences(*values of a row)`` gives lists of words, none with white space."""

    def add(counters, *columns):
        three = counters[0]
        for row in zip(*columns):
            for words in sentences(*row):
                first = ["<", *words]
                three.update(zip(["<", *first], first, words))

    return NgramModel.counted({tuple(k.split(" ")): n for k, n in collected(tally(rows, add, spell=" ".join))})
