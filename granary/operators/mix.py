"""Layer accounting, reproducible shuffles, samples to token budgets and the mixed set's statistics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions import text as X
from granary.session import discard, materialize

LAYERS = ("code", "doc", "alignment", "devops")  # fixed values: the layers, in order of their union
SEED = 42


def union_layers(*parts: DataFrame) -> DataFrame:
    """All rows of all parts by column name; columns that a part lacks are null."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


def layer_stats(rows: DataFrame, layer: str = "layer", tokens: str = "token_count") -> DataFrame:
    """n, tokens and the share of all tokens, by layer."""
    by = rows.groupBy(layer).agg(F.count("*").alias("n"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"))
    total = F.sum("tokens").over(Window.partitionBy())  # over one row a layer
    return by.withColumn("token_share", F.when(total > 0, F.col("tokens") / total))


def count_ratios(rows: DataFrame, layer: str = "layer", tokens: str = "token_count") -> DataFrame:
    """The old report's figure by layer: rows in percent of all tokens, half to even at one digit."""
    by = rows.groupBy(layer).agg(F.count("*").alias("n"), F.coalesce(F.sum(tokens), F.lit(0)).alias("t"))
    total = F.greatest(F.sum("t").over(Window.partitionBy()), F.lit(1))
    return by.select(layer, F.bround(F.col("n") / total * 100, 1).alias("ratio"))


def language_counts(rows: DataFrame, language: str = "language") -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(language), F.lit("unknown")).alias("language")).agg(F.count("*").alias("n"))


def missing_languages(rows: DataFrame, expected: list[str], language: str = "language") -> DataFrame:
    """Those of ``expected`` that no row has."""
    wanted = rows.sparkSession.createDataFrame([(x,) for x in expected], "language STRING")
    return wanted.join(rows.select(F.col(language).alias("language")).distinct(), "language", "left_anti")


def mean_tokens(rows: DataFrame, tokens: str = "token_count") -> DataFrame:
    """Mean as a whole number, rounded down; 0 of no rows."""
    return rows.agg(F.coalesce(F.floor(F.sum(tokens) / F.count(tokens)), F.lit(0)).cast("bigint").alias("mean_tokens"))


def alignment_budget(rows: DataFrame, share: float, part: str = "alignment", layer: str = "layer", tokens: str = "token_count") -> DataFrame:
    """Tokens that layer ``part`` lacks to have ``share`` of all, never below 0."""
    t, mine = F.col(tokens), F.col(layer) == part
    sums = rows.agg(F.coalesce(F.sum(F.when(mine, t)), F.lit(0)).alias("a"), F.coalesce(F.sum(F.when(~mine, t)), F.lit(0)).alias("o"))
    need = (F.lit(share) * F.col("o") - F.col("a") * (1 - F.lit(share))) / (1 - F.lit(share))
    return sums.select(F.greatest(F.lit(0), need.cast("bigint")).alias("budget"))


def shuffled(rows: DataFrame, *keys: str, seed: int = SEED) -> DataFrame:
    """All rows in an order that depends on ``seed`` and ``keys`` alone, not on partitions."""
    return rows.orderBy(X.hash_order(seed, *map(F.col, keys)), *keys)


def shuffled_head(rows: DataFrame, n: int, *keys: str, seed: int = SEED) -> DataFrame:
    """The first ``n`` rows of that order (top-k, without a full sort)."""
    return shuffled(rows, *keys, seed=seed).limit(n)


def capped(rows: DataFrame, group: str, order: str, cap: int) -> DataFrame:
    """At most ``cap`` rows of each ``group``, in ``order``; Spark drops later ones before the shuffle."""
    w = Window.partitionBy(group).orderBy(order)
    return rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= cap).drop("_k")


RANGE_ROWS = 50_000  # rows of a range of the shuffled order that one window holds, about
FEW_ROWS = 200_000  # candidates from which one task a group fills the rest, in order


def greedy_budget(rows: DataFrame, budget: int, group: str, id_col: str, tokens: str, seed: int = SEED) -> DataFrame:
    """Rows of each ``group`` that a first-fit fill of ``budget`` tokens takes in shuffled order: (group, id, t).

    Each row is taken if it still fits, else skipped. In rounds: the order is cut into ranges, whose sums tell how
    many whole ranges are taken at once, and in which range the first row lies that doesn't fit; only that range is sorted.
    Rows behind it that are no larger than what is left go on. What is left shrinks below the skipped row's size
    each time. Once no more than ``FEW_ROWS`` candidates remain, one task a group takes them one by one. Rows of null or
    negative tokens never fit; a null group is a group.
    """
    rest = rows.where(F.col(tokens) >= 0).select(F.col(group).alias("g"), F.col(id_col).alias("id"), F.col(tokens).cast("bigint").alias("t"), X.hash_order(seed, F.col(id_col)).alias("o"), F.lit(budget).cast("bigint").alias("left"))
    taken, past = [], None
    while True:
        rest = materialize(rest.where("t <= left"), "fill")
        n = rest.count()
        if past is not None:
            discard(past)
        if n <= FEW_ROWS:
            kind = {f.name: f.dataType.simpleString() for f in rest.schema}
            taken.append(rest.groupBy("g").applyInArrow(_first_fit, f"g {kind['g']}, id {kind['id']}, t BIGINT"))
            whole = taken[0]
            for part in taken[1:]:
                whole = whole.union(part)
            return whole.withColumnRenamed("g", group)
        past = rest
        ranges = -(-n // RANGE_ROWS)
        ranged = rest.withColumn("b", F.expr(f"cast(conv(substring(o, 1, 8), 16, 10) as bigint) * {ranges} div 4294967296"))
        order = Window.partitionBy("g").orderBy("b")  # over one row a range
        sums = ranged.groupBy("g", "b").agg(F.sum("t").alias("s"), F.first("left").alias("left")).select("g", "b", "left", F.sum("s").over(order).alias("upto"), "s")
        sums = materialize(sums.where("upto - s <= left").withColumn("whole", F.col("upto") <= F.col("left")), "ranges")  # up to the first that isn't whole
        edge = sums.where("NOT whole").select("g", "b", (F.col("left") - F.col("upto") + F.col("s")).alias("room"))
        inside = _meet(ranged.drop("left"), edge)
        fit = materialize(inside.withColumn("upto", F.sum("t").over(Window.partitionBy("g").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0))), "edges")
        wall = fit.where("upto > room").groupBy("g").agg(F.min(F.struct("o", "id", (F.col("room") - F.col("upto") + F.col("t")).alias("left"))).alias("w"))
        taken.append(materialize(_meet(ranged.drop("left"), sums.where("whole").select("g", "b")).select("g", "id", "t").union(fit.where("upto <= room").select("g", "id", "t")), "taken"))
        rest = _meet(rest.drop("left"), wall, ["g"]).where("o > w.o OR (o = w.o AND id > w.id)").select("g", "id", "t", "o", F.col("w.left").alias("left"))


def _meet(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Inner join on ``keys`` (g and b), nulls equal."""
    keys = keys or ["g", "b"]
    r = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(r, on).drop(*(f"_{k}" for k in keys))


def _first_fit(rows: pa.Table) -> pa.Table:
    """The rows of one group that fit one after the other, in order."""
    rows = rows.sort_by([("o", "ascending"), ("id", "ascending")])
    left, kept = (rows.column("left")[0].as_py() if rows.num_rows else 0), []
    for i, t in enumerate(rows.column("t").to_pylist()):
        if t <= left:
            left -= t
            kept.append(i)
    return rows.take(pa.array(kept, pa.int64())).select(["g", "id", "t"])


def stats_document(rows: DataFrame, layer: str = "layer", language: str = "language", tokens: str = "token_count") -> DataFrame:
    """One row: total_examples, total_tokens, and maps layer_counts, language_counts, token_ratios."""
    as_map = lambda d, k, v: d.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(k, v)))).alias("m"))
    by_layer = rows.groupBy(layer).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total_examples"), F.coalesce(F.sum(tokens), F.lit(0)).alias("total_tokens"))
    parts = (("layer_counts", as_map(by_layer, layer, "n")), ("language_counts", as_map(language_counts(rows, language), "language", "n")), ("token_ratios", as_map(count_ratios(rows, layer, tokens), layer, "ratio")))
    for name, m in parts:  # each has one row
        total = total.join(m.withColumnRenamed("m", name), how="inner", on=F.lit(True))
    return total


def combinations(spark: SparkSession, principles: list[str], languages: list[str], target: int, yield_share: float = 0.4) -> DataFrame:
    """Every principle with every language, as often as needed for ``target`` results: pos, principle, language."""
    pairs = max(1, len(principles) * len(languages))
    repeats = max(1, int(target / (pairs * yield_share)))
    rows = spark.range(repeats * pairs).withColumnRenamed("id", "pos")
    pick = lambda xs, k: F.element_at(F.array(*map(F.lit, xs)), (k + 1).cast("int"))
    within = F.pmod(F.col("pos"), F.lit(pairs))
    return rows.select("pos", pick(principles, F.floor(within / len(languages))).alias("principle"), pick(languages, F.pmod(within, F.lit(len(languages)))).alias("language"))


def paired(rows: DataFrame, choices: list[str], key: str, seed: int = SEED) -> Column:
    """One of ``choices`` for each row, by hash of its ``key``."""
    return X.hash_pick(choices, seed, F.col(key))
