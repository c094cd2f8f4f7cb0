"""Deduplication with a stated winner, and anti-joins by content or index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X


def mark_first(rows: DataFrame, keys: list[str], order: str, among: Column | None = None) -> DataFrame:
    """``rows`` with ``is_first``: whether the row has the least ``order`` of its ``keys``.

    ``order`` must be unique and not null. ``among`` limits who takes part; others are never first. Winners
    come from one aggregation (combined before its shuffle) and are joined back by ``order``, so a key that a
    third of all rows share costs no more than others, which a window over it would.
    """
    part = rows if among is None else rows.where(among)
    winners = part.groupBy(*keys).agg(F.min(order).alias("_winner")).select("_winner")
    return rows.join(winners, F.col(order) == F.col("_winner"), "left").withColumn("is_first", F.col("_winner").isNotNull()).drop("_winner")


def first_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of least ``order`` of each ``keys``."""
    winners = rows.groupBy(*keys).agg(F.min(order).alias("_winner")).select("_winner")
    return rows.join(winners, F.col(order) == F.col("_winner"), "left_semi")


def ranked_first_wins(rows: DataFrame, keys: list[str], source_rank: Column, row_order: str) -> DataFrame:
    """As :func:`first_wins`, sources of lower rank first, then ``row_order`` (unique over all sources)."""
    ranked = rows.withColumn("_rank", F.struct(source_rank.alias("r"), F.col(row_order).alias("o")))
    winners = ranked.groupBy(*keys).agg(F.min("_rank").alias("_w")).select(F.col("_w.o").alias("_winner"))
    return rows.join(winners, F.col(row_order) == F.col("_winner"), "left_semi")


def without_known(rows: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """Rows whose ``text`` isn't among the texts of ``known``; a null text is never known."""
    seen = known.where(F.col(text).isNotNull()).select(X.digest(F.col(text)).alias("_d")).distinct()
    return rows.withColumn("_d", X.digest(F.col(text))).join(seen, "_d", "left_anti").drop("_d")


def pending(jobs: DataFrame, results: DataFrame, index: str = "_idx", worker: str = "_worker", lost: str = "lost") -> DataFrame:
    """Jobs that have no result yet; results of lost workers don't count."""
    done = results.where(~F.col(worker).eqNullSafe(lost)).select(index).distinct()
    return jobs.join(done, index, "left_anti")


def duplicate_count(rows: DataFrame, text: str) -> DataFrame:
    """rows, different texts, and rows beyond the first of each text (``duplicates``)."""
    by = rows.groupBy(X.digest(X.text_or_empty(F.col(text))).alias("d")).agg(F.count("*").alias("n"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_texts"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
