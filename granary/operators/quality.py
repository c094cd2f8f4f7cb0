"""The ordered quality filter and the check of generated instructions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions import text as X
from granary.operators.dedup import mark_first

# Bounds and refusals that decide results.
MIN_TOKENS, MAX_TOKENS, MIN_INSTRUCTION = 8, 2048, 5
REFUSAL_RE = r"^(i cannot|i'm unable|i am unable|sorry)"
ECHO_WORDS, ECHO_LEAST, ECHO_SHARE = 20, 5, 0.8
KEPT = "kept"


def with_tokens(rows: DataFrame, counter=X.token_estimate) -> DataFrame:
    """``token_count`` of instruction, a blank and output; the input isn't counted."""
    return rows.withColumn("token_count", counter(F.concat(F.col("instruction"), F.lit(" "), F.col("output"))))


def waterfall(rows: DataFrame, counter=X.token_estimate) -> DataFrame:
    """``rows`` (pos, layer, instruction, output) with token_count and the ``reason`` of each: the first that holds of

    too_few_tokens, too_many_tokens, duplicate (an earlier row of the layer within the token bounds has the
    same output, whatever became of it), short_instruction, non_ascii; else 'kept'. Null texts count as ''.
    ``pos`` must be unique. All that looks at texts comes before the join that finds duplicates, so a report
    carries no text through it.
    """
    clean = rows.withColumns({c: X.text_or_empty(F.col(c)) for c in ("instruction", "output")})
    n, said = F.col("token_count"), F.col("instruction")
    sized = with_tokens(clean, counter).withColumns(
        {
            "_size": F.when(n < MIN_TOKENS, "too_few_tokens").when(n > MAX_TOKENS, "too_many_tokens"),
            "_said": F.when(F.char_length(said) < MIN_INSTRUCTION, "short_instruction").when(~X.is_ascii(said), "non_ascii").otherwise(KEPT),
            "_digest": X.digest(F.col("output")),
        }
    )
    marked = mark_first(sized, ["layer", "_digest"], "pos", among=F.col("_size").isNull())
    reason = F.coalesce("_size", F.when(~F.col("is_first"), "duplicate").otherwise(F.col("_said")))
    return marked.withColumn("reason", reason).drop("_size", "_said", "_digest", "is_first")


def drop_report(judged: DataFrame) -> DataFrame:
    """Rows and tokens by layer and reason."""
    return judged.groupBy("layer", "reason").agg(F.count("*").alias("n"), F.sum("token_count").alias("tokens"))


def ranked_report(report: DataFrame) -> DataFrame:
    """A drop report with the ``rank`` of each reason within its layer, the most frequent first."""
    return report.withColumn("rank", F.row_number().over(Window.partitionBy("layer").orderBy(F.desc("n"), "reason")))  # over one row a reason


def echo_overlap(instruction: Column, code: Column) -> tuple[Column, Column]:
    """(words in common, different words) of the first 20 words of the code and those of the instruction."""
    head = F.array_distinct(F.slice(X.words(F.lower(code)), 1, ECHO_WORDS))
    return F.size(F.array_intersect(head, X.words(F.lower(instruction)))), F.size(head)


def instruction_defect(instruction: Column, code: Column) -> Column:
    """Why a generated instruction can't be used ('empty', 'short', 'refusal', 'echo'), null if it can."""
    common, n = echo_overlap(instruction, X.text_or_empty(code))
    stripped = X.strip(X.text_or_empty(instruction))
    return (
        F.when(stripped == "", "empty")
        .when(F.char_length(stripped) < MIN_INSTRUCTION, "short")
        .when(F.lower(stripped).rlike(REFUSAL_RE), "refusal")
        .when((n > ECHO_LEAST) & (common > ECHO_SHARE * n), "echo")
    )


def source_file_ok(path: Column, lines: Column, extensions: list[str], excluded: list[str], most: int = 5000) -> Column:
    """A source file to read: its extension (case counts), no excluded folder on its way, not too long."""
    return X.file_suffix(path).isin(*extensions) & ~F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, excluded))) & (lines <= most)


def config_file_ok(path: Column, lines: Column, extensions: list[str], most: int = 5000) -> Column:
    """A configuration file to read: by name or extension (case doesn't count), no dotted part, 1 line to ``most``."""
    name = F.lower(X.file_name(path))
    named = (name == "makefile") | F.startswith(name, F.lit("makefile.")) | F.startswith(name, F.lit("dockerfile")) | F.lower(X.file_suffix(path)).isin(*extensions)
    dotted = F.exists(F.split(path, "/"), lambda p: F.startswith(p, F.lit(".")))
    return named & ~dotted & ~F.endswith(name, F.lit(".md")) & lines.between(1, most)
