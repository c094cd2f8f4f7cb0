"""Checks of a finished data set, gathered by aggregations and judged at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators.mix import LAYERS

MIN_LINES = 100
TARGETS = {"code": 0.50, "doc": 0.25, "alignment": 0.15, "devops": 0.10}  # fixed values: shares of tokens
TOLERANCE = 0.03


def validation_report(rows: DataFrame, expected_languages: list[str], least: int = MIN_LINES) -> DataFrame:
    """One row per check: ``name``, ``value``, ``ok``, ``fatal``.

    ``rows``: instruction, output, layer, language, token_count. Fatal: fewer rows than ``least``; rows that
    lack instruction or output. Warnings: share of a layer off its target (a missing layer counts as code, an
    unknown one isn't counted, missing tokens are estimated); languages absent; outputs repeated.
    """
    whole = F.concat(X.text_or_empty(F.col("instruction")), F.lit(" "), X.text_or_empty(F.col("output")))
    t = F.coalesce("token_count", X.token_estimate(whole))
    layer = F.coalesce("layer", F.lit("code"))
    bad = F.col("instruction").isNull() | F.col("output").isNull()
    one = rows.agg(
        F.count("*").alias("lines"),
        F.count_if(bad).alias("structure_errors"),
        *(F.coalesce(F.sum(F.when(layer == x, t)), F.lit(0)).alias(f"tokens_{x}") for x in LAYERS),
        *(F.count_if(F.col("language").eqNullSafe(x)).alias(f"language_{i}") for i, x in enumerate(expected_languages)),
    )
    copies = rows.groupBy(X.digest(X.text_or_empty(F.col("output"))).alias("d")).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    facts = one.join(copies, on=F.lit(True))
    total = sum((F.col(f"tokens_{x}") for x in LAYERS), F.lit(0))
    check = lambda name, value, ok, fatal: F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), ok.alias("ok"), F.lit(fatal).alias("fatal"))
    share = lambda x: F.when(total > 0, F.col(f"tokens_{x}") / total).otherwise(0.0)
    missing = sum((F.when(F.col(f"language_{i}") == 0, 1).otherwise(0) for i in range(len(expected_languages))), F.lit(0))
    checks = F.array(
        check("lines", F.col("lines"), F.col("lines") >= least, True),
        check("structure_errors", F.col("structure_errors"), F.col("structure_errors") == 0, True),
        *(check(f"share_{x}", share(x), F.abs(share(x) - TARGETS[x]) <= TOLERANCE, False) for x in LAYERS),
        check("missing_languages", missing, missing == 0, False),
        check("duplicate_outputs", F.col("duplicates"), F.col("duplicates") == 0, False),
    )
    return facts.select(F.explode(checks).alias("c")).select("c.*")


def passes(report: DataFrame) -> bool:
    """Whether no fatal check failed."""
    return not report.where("fatal AND NOT ok").limit(1).count()


def structure_errors(lines: DataFrame, line_col: str = "value", order: str = "line_no", most: int = 3) -> DataFrame:
    """The first ``most`` lines (a report, so limited) that aren't JSON objects with instruction and output: order and reason."""
    parsed = F.try_parse_json(F.col(line_col))
    field = lambda k: F.try_variant_get(parsed, f"$.{k}", "string")
    reason = F.when(parsed.isNull(), "bad JSON").when(field("instruction").isNull(), "no instruction").when(field("output").isNull(), "no output")
    kept = lines.where(X.strip(F.col(line_col)) != "").select(order, reason.alias("reason"))
    return kept.where("reason IS NOT NULL").orderBy(order).limit(most)


def present(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows``, failing at run time where one of ``columns`` is null."""
    for c in columns:
        rows = rows.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is null"))).otherwise(F.col(c)))
    return rows


def enough_files(files: DataFrame, repo: str = "repo", path: str = "path", least: int = 6) -> DataFrame:
    """Repositories with their number of different files, and whether they have at least ``least``: fewer tell a broken checkout."""
    return files.groupBy(repo).agg(F.count_distinct(path).alias("n_files")).withColumn("ok", F.col("n_files") >= least)
