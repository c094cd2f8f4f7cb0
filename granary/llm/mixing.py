"""Problem 7: mixing sources to target weights.

Entropy balancing: of all ways to give each document a rate (expected number of copies) such that each
source has its goal of tokens, the one closest to using every document once tilts the rates
exponentially, rate = min(limit, exp(lambda * tokens)), with one multiplier a source. The dual is convex;
Newton's method, kept inside a bracket, finds the multipliers from sums that Spark gathers. Rates are
then rounded to whole copies systematically, so a source's copies add up to its rates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.encode import token_counts
from granary.session import materialize, table

ROUNDS = 60  # Newton steps at most; about ten suffice
TOLERANCE = 1e-4  # of a source's goal
BUCKET_ROWS = 200_000  # documents of a source that one task rounds
SEED = 17
MOST_TARGETS = 100_000  # rows of targets: a small table that fits on the driver


def source_name(source: Column) -> Column:
    """A source however it is spelled: lower case, runs of other signs as one '_'; '' and null give null."""
    key = F.regexp_replace(F.regexp_replace(F.lower(source), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(key != "", key)


def solve(groups: DataFrame, goals: dict[tuple[str, str], tuple[float, int, float]]) -> dict[tuple[str, str], float]:
    """Multiplier of each (mix, source): rates min(limit, exp(multiplier * t / mean)) sum to the goal of tokens.

    ``groups``: source, t (tokens of a document), n (documents). ``goals``: goal of tokens, limit, mean t.
    Each round is one aggregation over ``groups``; only one row for each open (mix, source) comes back.
    """
    spark = groups.sparkSession
    state = {k: [0.0, None, None] for k in goals}  # multiplier, bracket
    open_ = set(goals)
    for _ in range(ROUNDS):
        if not open_:
            break
        rows = [(m, s, state[m, s][0], float(goals[m, s][1]), goals[m, s][2]) for m, s in sorted(open_)]
        now = spark.createDataFrame(rows, "mix_id STRING, source STRING, lam DOUBLE, most DOUBLE, mean DOUBLE")
        z = F.col("t") / F.col("mean")
        raw = F.exp(F.least(F.col("lam") * z, F.lit(600.0)))
        mass = F.col("n") * F.col("t")
        sums = groups.join(F.broadcast(now), "source").groupBy("mix_id", "source").agg(F.sum(mass * F.least(raw, F.col("most"))).alias("g"), F.sum(F.when(raw < F.col("most"), mass * z * raw).otherwise(0.0)).alias("h"))
        for r in sums.collect():
            k = (r["mix_id"], r["source"])
            goal = goals[k][0]
            gap = r["g"] - goal
            lam, low, high = state[k]
            if abs(gap) <= TOLERANCE * goal:
                open_.discard(k)
                continue
            if gap < 0:
                low = lam
            else:
                high = lam
            step = lam - gap / r["h"] if r["h"] > 0 else math.nan
            # Newton on log of the sum where rates are far too high, else plain; outside the bracket, halve it
            if not math.isfinite(step) or (low is not None and step <= low) or (high is not None and step >= high):
                step = (low + high) / 2 if low is not None and high is not None else (lam * 2 + 1 if high is None else lam * 2 - 1)
            state[k] = [step, low, high]
            if low is not None and high is not None and high - low < 1e-12 * max(1, abs(high)):
                open_.discard(k)
    return {k: v[0] for k, v in state.items()}


def mix_sources(documents: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", total_tokens: int | str | None = None, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) of each mix.

    copies: mix_id, source (as targets write it), ``id_col``, n_tokens, copies (1 and more). shares: mix_id,
    source, target_share, max_repeats, n_docs (available), available_tokens, goal_tokens, tokens,
    actual_share, limited (its repeat limit keeps it below its share), exact_total (the largest size of the mix at
    which no source that has documents is limited, so that all of them get their shares exactly).

    The size of a mix is ``total_tokens`` (a number, or 'exact' for each mix's exact_total), or the tokens that its sources
    of share above 0 have; a source's goal is its share of that, or its tokens times its limit if that is less. Null, empty and other texts without tokens, and rows without
    a source, are never taken; repeated rows count each. A source without documents and one of
    share 0 give none. Targets with null in share or limit count as 0 and 1.
    """
    spark = documents.sparkSession
    counted = token_counts(documents.select(F.struct(F.col(id_col).alias("id"), source_name(F.col(source_col)).alias("source")).alias("k"), F.col(text_col).alias("_text")), "k", "_text", tokenizer)
    docs = materialize(counted.select(F.col("k.id").alias("id"), F.col("k.source").alias("source"), "n_tokens").where("source IS NOT NULL AND n_tokens > 0"), "tokens")
    wanted = targets.select("mix_id", F.col("source").alias("name"), source_name(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(1)).alias("most")).limit(MOST_TARGETS + 1).collect()
    if len(wanted) > MOST_TARGETS:
        raise ValueError("mix targets are expected to be a small table")
    groups = materialize(docs.groupBy("source", F.col("n_tokens").alias("t")).agg(F.count("*").alias("n")), "groups")
    have = {r["source"]: (r["d"], r["n"]) for r in groups.groupBy("source").agg(F.sum("n").alias("d"), F.sum(F.col("n") * F.col("t")).alias("n")).join(F.broadcast(spark.createDataFrame([(s,) for s in sorted({r["source"] or "" for r in wanted})] or [("",)], "source STRING")), "source").collect()}
    size: dict[str, int] = {}
    for r in wanted:
        size[r["mix_id"]] = size.get(r["mix_id"], 0) + (have.get(r["source"], (0, 0))[1] if r["share"] > 0 else 0)
    exact: dict[str, int] = {}
    for r in wanted:
        tokens = have.get(r["source"], (0, 0))[1]
        if r["share"] > 0 and tokens:
            exact[r["mix_id"]] = min(exact.get(r["mix_id"], 1 << 62), int(r["most"] * tokens / r["share"]))
    if total_tokens is not None:
        size = {m: exact.get(m, 0) if total_tokens == "exact" else total_tokens for m in size}
    goals, plan = {}, []
    for r in wanted:
        d, n = have.get(r["source"], (0, 0))
        want = r["share"] * size[r["mix_id"]]
        goal = min(want, float(r["most"]) * n)
        plan.append([r["mix_id"], r["name"], r["source"], r["share"], r["most"], d, n, goal, want > goal + 0.5])
        if n and 0 < goal < float(r["most"]) * n * (1 - 1e-9):
            goals[r["mix_id"], r["source"]] = (goal, r["most"], n / d)
    found = solve(groups, goals)
    rates = []
    for m, name, s, _, most, d, n, goal, _ in plan:
        if n and goal > 0:
            rates.append((m, name, s, found.get((m, s), math.inf), float(most), n / d))
    known = spark.createDataFrame(rates, "mix_id STRING, name STRING, source STRING, lam DOUBLE, most DOUBLE, mean DOUBLE")
    buckets = max(1, -(-max([d for d, _ in have.values()] or [0]) // BUCKET_ROWS))
    order = F.xxhash64("id", F.lit(SEED))
    rate = F.when(F.col("lam") == F.lit(math.inf), F.col("most")).otherwise(F.least(F.col("most"), F.exp(F.least(F.col("lam") * F.col("n_tokens") / F.col("mean"), F.lit(600.0)))))
    rated = docs.join(F.broadcast(known), "source").select("mix_id", "name", "id", "n_tokens", rate.alias("rate"), order.alias("o"), F.pmod(order, F.lit(buckets)).alias("b"))
    ahead = rated.groupBy("mix_id", "name", "b").agg(F.sum("rate").alias("r")).withColumn("ahead", F.coalesce(F.sum("r").over(Window.partitionBy("mix_id", "name").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).drop("r")
    place = Window.partitionBy("mix_id", "name", "b").orderBy("n_tokens", "o", "id")  # by length, so that copies carry the tokens of their rates
    upto = F.col("ahead") + F.sum("rate").over(place.rowsBetween(Window.unboundedPreceding, 0)) + 0.5
    rounded = rated.join(ahead, ["mix_id", "name", "b"]).withColumn("upto", upto).withColumn("copies", (F.floor(F.col("upto") + 1e-9) - F.floor(F.col("upto") - F.col("rate") + 1e-9)).cast("int"))
    copies = rounded.where("copies > 0").select("mix_id", F.col("name").alias("source"), F.col("id").alias(id_col), "n_tokens", "copies")
    goal_rows = spark.createDataFrame([(p[0], p[1], float(p[3]), int(p[4]), int(p[5]), int(p[6]), float(p[7]), bool(p[8]), exact.get(p[0], 0)) for p in plan], "mix_id STRING, source STRING, target_share DOUBLE, max_repeats INT, n_docs BIGINT, available_tokens BIGINT, goal_tokens DOUBLE, limited BOOLEAN, exact_total BIGINT")
    got = copies.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"))
    joined = goal_rows.join(got, ["mix_id", "source"], "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    total = F.sum("tokens").over(Window.partitionBy("mix_id"))
    shares = joined.withColumn("actual_share", F.when(total > 0, F.col("tokens") / total)).select("mix_id", "source", "target_share", "max_repeats", "n_docs", "available_tokens", "goal_tokens", "tokens", "actual_share", "limited", "exact_total")
    return copies, shares


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p7_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p7_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source is off its target: at the usual size, and at the size at which no source is limited.

    ``possible_share``: the target, of a mix of only those sources that have documents (null for the others).
    """
    documents, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    usual, exact = mix_sources(documents, targets)[1], mix_sources(documents, targets, total_tokens="exact")[1]
    there = F.sum(F.when(F.col("n_docs") > 0, F.col("target_share"))).over(Window.partitionBy("mix_id"))
    gaps = exact.withColumn("possible_share", F.when(F.col("n_docs") > 0, F.col("target_share") / there))
    gaps = gaps.select("mix_id", "source", "possible_share", "exact_total", F.col("actual_share").alias("exact_share"), F.abs(F.col("actual_share") - F.col("possible_share")).alias("exact_gap"))
    return usual.select("mix_id", "source", "target_share", "limited", "actual_share", F.abs(F.col("actual_share") - F.col("target_share")).alias("gap")).join(gaps, ["mix_id", "source"])
