"""The canonical record (instruction, input, output, metadata) and the mappers that make it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import text as X

META_KEYS = ("layer", "language", "repo", "chunk_name", "source", "topic", "license", "category", "principle", "file")
META = T.StructType([T.StructField(k, T.StringType()) for k in META_KEYS])
RECORD = T.StructType([T.StructField("instruction", T.StringType()), T.StructField("input", T.StringType()), T.StructField("output", T.StringType()), T.StructField("token_count", T.LongType()), T.StructField("metadata", META)])
CHUNK = T.StructType([*(T.StructField(k, T.StringType()) for k in ("repo", "language", "file_path", "chunk_type", "name")), T.StructField("start_line", T.LongType()), T.StructField("end_line", T.LongType()), T.StructField("code", T.StringType()), T.StructField("signature", T.StringType())])
JOB = T.StructType([T.StructField("_idx", T.LongType()), T.StructField("prompt", T.StringType()), T.StructField("max_tokens", T.IntegerType()), T.StructField("temperature", T.DoubleType()), T.StructField("top_p", T.DoubleType()), T.StructField("stop", T.ArrayType(T.StringType()))])
HUMAN, MODEL = ("human", "user"), ("gpt", "assistant")


def metadata(**known: Column | str | None) -> Column:
    """The metadata struct; keys not given are null."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(*(value(known.get(k)).cast("string").alias(k) for k in META_KEYS))


def record(instruction: Column, output: Column, input_: Column | None = None, **meta: Column | str | None) -> list[Column]:
    return [instruction.alias("instruction"), (F.lit("") if input_ is None else input_).alias("input"), output.alias("output"), F.lit(None).cast("bigint").alias("token_count"), metadata(**meta).alias("metadata")]


def map_rows(rows: DataFrame, instruction: str, output: str, input_: str | None = None, keep: tuple[str, ...] = (), **meta: Column | str | None) -> DataFrame:
    """Canonical records of instruction rows: fields stripped, null as '', rows without instruction or output dropped.

    ``keep``: key columns carried along. Values of ``meta`` are columns or constants; an empty one counts as absent.
    """
    clean = lambda c: X.strip(X.text_or_empty(F.col(c)))
    mapped = rows.select(*keep, *record(clean(instruction), clean(output), clean(input_) if input_ else None, **{k: F.nullif(v, F.lit("")) if isinstance(v, Column) else v for k, v in meta.items()}))
    return mapped.where((F.col("instruction") != "") & (F.col("output") != ""))


def chat_pairs(turns: DataFrame, conversation: str, turn: str, role: str, content: str) -> DataFrame:
    """Each conversation's first non-empty human and model turn (``conversation``, instruction, output).

    Roles are compared in lower case; conversations that lack either are dropped. One aggregation, combined
    before the shuffle.
    """
    r, t = F.lower(F.col(role)), X.strip(X.text_or_empty(F.col(content)))
    first = lambda roles: F.min(F.when(r.isin(*roles) & (t != ""), F.struct(F.col(turn).alias("k"), t.alias("t"))))
    got = turns.groupBy(conversation).agg(first(HUMAN).alias("h"), first(MODEL).alias("m"))
    return got.where("h IS NOT NULL AND m IS NOT NULL").select(conversation, F.col("h.t").alias("instruction"), F.col("m.t").alias("output"))


def chat_pairs_nested(rows: DataFrame, conversations: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same from one row a conversation: an array of turns, or its JSON text (broken JSON gives no row).

    A turn's role is ``from`` or else ``role``, its text ``value`` or else ``content``.
    """
    turn = "array<struct<from:string,role:string,value:string,content:string>>"
    c = F.col(conversations)
    if isinstance(rows.schema[conversations].dataType, T.StringType):
        c = F.from_json(c, turn)
    role = lambda x: F.lower(F.coalesce(x["from"], x["role"]))
    body = lambda x: X.strip(F.coalesce(F.nullif(x["value"], F.lit("")), x["content"], F.lit("")))
    first = lambda roles: F.try_element_at(F.filter(F.transform(F.filter("_c", lambda x: role(x).isin(*roles)), body), lambda t: t != ""), F.lit(1))
    got = rows.withColumn("_c", c).select(*keep, first(HUMAN).alias("instruction"), first(MODEL).alias("output"))
    return got.where("instruction IS NOT NULL AND output IS NOT NULL")


def chunk_record(chunks: DataFrame, instruction: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records that ask for a code chunk."""
    return chunks.select(*keep, *record(instruction, F.col("code"), layer="code", language=F.col("language"), repo=F.col("repo"), chunk_name=F.col("name")))


def question_pairs(train: DataFrame, nulls: bool = False) -> DataFrame:
    """Answer rows of a chat table with the question before them: pos, layer, language, instruction, output.

    ``pos`` (the answer's id) is unique and gives the order in which first-wins rules look at rows. Null texts count as ''
    unless ``nulls`` keeps them.
    """
    text = (lambda c: c) if nulls else X.text_or_empty
    role = F.lower("role")
    a = train.where(role.isin(*MODEL)).select(F.col("msg_id").alias("pos"), "example_id", (F.col("turn") - 1).alias("turn"), text(F.col("content")).alias("output"), F.coalesce("metadata.layer", F.lit("code")).alias("layer"), F.coalesce("metadata.language", F.lit("unknown")).alias("language"), F.col("metadata.source").alias("source"))
    q = train.where(role.isin(*HUMAN)).select("example_id", "turn", text(F.col("content")).alias("instruction"))
    return a.join(q, ["example_id", "turn"]).drop("turn", "example_id")


def seed_record(language: Column, principle: Column, bad: Column, thought: Column, good: Column, source: str = "seed") -> list[Column]:
    """A refactoring example: the thought in its tags, then the better code."""
    return record(F.format_string("Refactor this %s code to follow %s.", language, principle), F.concat(F.lit("<thought>"), thought, F.lit("</thought>\n\n"), good), bad, layer="alignment", language=language, principle=principle, source=source)
