"""Bounded samples of labelled rows, chosen by a hash of the id, for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANGE = 1 << 40
MARGIN = 4  # times as many rows as wanted pass the first cut, so that enough remain
MOST_GROUPS = 1_000


def hash_sample(rows: DataFrame, id_col: str, n: int, group: str | None = None) -> DataFrame:
    """The ``n`` rows of least hash of the id, of each ``group`` where given, with ``_k``, their rank from 1.

    Groups are counted first, so each task passes on only about ``MARGIN`` times its share of the sample;
    what is ranked doesn't grow with the table. Of more than ``MOST_GROUPS`` groups the most frequent are
    sampled. Rows of null group or id are left out.
    """
    keyed = rows.withColumn("_g", F.col(group).cast("string") if group else F.lit("")).where(F.col("_g").isNotNull() & F.col(id_col).isNotNull()).withColumn("_h", F.pmod(F.xxhash64(id_col), F.lit(RANGE)))
    counts = keyed.groupBy("_g").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "_g").limit(MOST_GROUPS)
    cut = counts.select("_g", F.least(F.lit(float(RANGE)), F.lit(float(RANGE) * MARGIN * n) / F.col("_n")).alias("_cut"))
    few = keyed.join(F.broadcast(cut), "_g").where(F.col("_h") < F.col("_cut"))
    ranked = few.withColumn("_k", F.row_number().over(Window.partitionBy("_g").orderBy("_h", id_col)))
    return ranked.where(F.col("_k") <= n).drop("_g", "_h", "_cut")
