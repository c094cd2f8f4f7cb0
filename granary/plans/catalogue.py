"""Registered queries of the core over the test tables, each beside the same in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import chunking, dag, dedup, infer, mix, pages, quality, records, retrieval, validate
from granary.session import fresh_path, table
from granary.sources import files, paged, seeds
from granary.streaming import streams

_QUERIES: dict = {}
_SQL: dict[str, str] = {}

SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
PAIRS = """pairs AS (
  SELECT a.msg_id AS pos, coalesce(a.content, '') AS output, coalesce(a.metadata.layer, 'code') AS layer,
         coalesce(a.metadata.language, 'unknown') AS language, a.metadata.source AS source, coalesce(q.content, '') AS instruction
  FROM train a JOIN train q ON q.example_id = a.example_id AND q.turn = a.turn - 1
  WHERE lower(a.role) IN ('gpt', 'assistant') AND lower(q.role) IN ('human', 'user'))"""
SIZED = PAIRS + """,
sized AS (SELECT *, greatest(1, length(instruction || ' ' || output) // 4) AS token_count FROM pairs)"""
JUDGED = SIZED + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY layer, sha256(output), token_count BETWEEN 8 AND 2048 ORDER BY pos) AS rn FROM sized),
judged AS (SELECT *, CASE WHEN token_count < 8 THEN 'too_few_tokens' WHEN token_count > 2048 THEN 'too_many_tokens' WHEN rn > 1 THEN 'duplicate'
  WHEN length(instruction) < 5 THEN 'short_instruction' WHEN strlen(instruction) <> length(instruction) THEN 'non_ascii' ELSE 'kept' END AS reason FROM ranked)"""


def query(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{SPACE}+', ''), '{SPACE}+\\z', '')"


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return records.question_pairs(table(spark, d, "train"))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return quality.with_tokens(_pairs(spark, d))


# --- filter, token accounts, mixing ---


@query("q_filter_waterfall", f"WITH {JUDGED} SELECT layer, reason, count(*) AS n, sum(token_count)::BIGINT AS tokens FROM judged GROUP BY ALL")
def _(spark, d):
    return quality.drop_report(quality.waterfall(_pairs(spark, d)))


@query("q_waterfall_rows", f"WITH {JUDGED} SELECT pos, layer, token_count, reason FROM judged")
def _(spark, d):
    return quality.waterfall(_pairs(spark, d)).select("pos", "layer", "token_count", "reason")


@query("q_reasons_by_count", f"WITH {JUDGED}, r AS (SELECT layer, reason, count(*) AS n, sum(token_count)::BIGINT AS tokens FROM judged GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY layer ORDER BY n DESC, reason)::INT AS rank FROM r")
def _(spark, d):
    return quality.ranked_report(quality.drop_report(quality.waterfall(_pairs(spark, d))))


@query("q_token_count", "SELECT doc_id, greatest(1, length(coalesce(text, '')) // 4)::BIGINT AS token_count FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", X.token_estimate(X.text_or_empty(F.col("text"))).alias("token_count"))


@query("q_token_bounds", f"WITH {SIZED} SELECT CASE WHEN token_count < 8 THEN 'too_few_tokens' WHEN token_count > 2048 THEN 'too_many_tokens' ELSE 'within' END AS bound, count(*) AS n FROM sized GROUP BY ALL")
def _(spark, d):
    t = F.col("token_count")
    return _sized(spark, d).groupBy(F.when(t < quality.MIN_TOKENS, "too_few_tokens").when(t > quality.MAX_TOKENS, "too_many_tokens").otherwise("within").alias("bound")).agg(F.count("*").alias("n"))


@query("q_dedup_first_wins", "SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL GROUP BY sha256(text)")
def _(spark, d):
    docs = table(spark, d, "documents").where("text IS NOT NULL").withColumn("digest", X.digest(F.col("text")))
    return dedup.first_wins(docs, ["digest"], "doc_id").select("doc_id", "digest")


@query("q_dedup_cross_source", """SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY sha256(text) ORDER BY CASE WHEN starts_with(source, 'hf:') THEN 0 ELSE 1 END, doc_id) AS rn FROM documents WHERE text IS NOT NULL) WHERE rn = 1""")
def _(spark, d):
    docs = table(spark, d, "documents").where("text IS NOT NULL").withColumn("_d", X.digest(F.col("text")))
    rank = F.when(F.startswith("source", F.lit("hf:")), 0).otherwise(1)
    return dedup.ranked_first_wins(docs, ["_d"], rank, "doc_id").select("doc_id", "source")


@query("q_source_cap", "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 20")
def _(spark, d):
    return mix.capped(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 20)


@query("q_union_layers", f"""WITH {PAIRS} SELECT layer, language, count(*) AS n FROM (
  SELECT layer, language FROM pairs UNION ALL SELECT layer, NULL FROM documents UNION ALL SELECT 'code', language FROM code_chunks_raw) GROUP BY ALL""")
def _(spark, d):
    parts = (_pairs(spark, d).select("layer", "language"), table(spark, d, "documents").select("layer"), table(spark, d, "code_chunks_raw").select(F.lit("code").alias("layer"), "language"))
    return mix.union_layers(*parts).groupBy("layer", "language").agg(F.count("*").alias("n"))


@query("q_layer_stats", f"WITH {SIZED} SELECT layer, count(*) AS n, sum(token_count)::BIGINT AS tokens, sum(token_count)::DOUBLE / (SELECT sum(token_count) FROM sized) AS token_share FROM sized GROUP BY layer")
def _(spark, d):
    return mix.layer_stats(_sized(spark, d))


@query("q_language_counts", "SELECT coalesce(metadata.language, 'unknown') AS language, count(*) AS n FROM train GROUP BY ALL")
def _(spark, d):
    return mix.language_counts(table(spark, d, "train").select("metadata.language"))


@query("q_token_ratios_legacy", f"WITH {SIZED} SELECT layer, round_even(count(*)::DOUBLE / (SELECT greatest(sum(token_count), 1) FROM sized) * 100, 1) AS ratio FROM sized GROUP BY layer")
def _(spark, d):
    return mix.count_ratios(_sized(spark, d))


@query("q_language_gap", "SELECT language FROM (VALUES ('python'), ('c'), ('javascript'), ('html'), ('css'), ('rust')) t(language) EXCEPT SELECT language FROM code_chunks_raw")
def _(spark, d):
    return mix.missing_languages(table(spark, d, "code_chunks_raw"), ["python", "c", "javascript", "html", "css", "rust"])


@query("q_duplicate_outputs", f"WITH {PAIRS}, g AS (SELECT sha256(output) AS h, count(*) AS n FROM pairs GROUP BY 1) SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_texts, sum(n - 1)::BIGINT AS duplicates FROM g")
def _(spark, d):
    return dedup.duplicate_count(_pairs(spark, d), "output")


@query("q_validation_report", f"""WITH {SIZED}, t AS (SELECT sum(token_count) FILTER (layer IN ('code', 'doc', 'alignment', 'devops')) AS total FROM sized),
s AS (SELECT l.layer, l.target, coalesce(sum(z.token_count), 0)::DOUBLE / (SELECT total FROM t) AS share FROM (VALUES ('code', 0.5), ('doc', 0.25), ('alignment', 0.15), ('devops', 0.1)) l(layer, target) LEFT JOIN sized z ON z.layer = l.layer GROUP BY ALL)
SELECT 'lines' AS name, count(*)::DOUBLE AS value, count(*) >= 100 AS ok, true AS fatal FROM sized
UNION ALL SELECT 'structure_errors', count(*), count(*) = 0, true FROM train a JOIN train q ON q.example_id = a.example_id AND q.turn = a.turn - 1 WHERE lower(a.role) IN ('gpt', 'assistant') AND lower(q.role) IN ('human', 'user') AND (a.content IS NULL OR q.content IS NULL)
UNION ALL SELECT 'share_' || layer, share, abs(share - target::DOUBLE) <= 0.03, false FROM s
UNION ALL SELECT 'missing_languages', count(*)::DOUBLE, count(*) = 0, false FROM (SELECT l FROM (VALUES ('python'), ('c'), ('javascript'), ('html'), ('css')) x(l) EXCEPT SELECT language FROM sized)
UNION ALL SELECT 'duplicate_outputs', (count(*) - count(DISTINCT sha256(output)))::DOUBLE, count(*) = count(DISTINCT sha256(output)), false FROM sized""")
def _(spark, d):
    rows = records.question_pairs(table(spark, d, "train"), nulls=True).withColumn("token_count", F.lit(None).cast("bigint"))
    return validate.validation_report(rows, list(seeds.LANGUAGES))


@query("q_structure_errors", """SELECT line_no, CASE WHEN instruction IS NULL THEN 'no instruction' ELSE 'no output' END AS reason FROM (SELECT a.msg_id AS line_no, q.content AS instruction, a.content AS output FROM train a JOIN train q ON q.example_id = a.example_id AND q.turn = a.turn - 1 WHERE lower(a.role) IN ('gpt', 'assistant') AND lower(q.role) IN ('human', 'user'))
WHERE instruction IS NULL OR output IS NULL ORDER BY line_no LIMIT 3""")
def _(spark, d):
    rows = records.question_pairs(table(spark, d, "train"), nulls=True)
    return validate.structure_errors(rows.select(F.col("pos").alias("line_no"), F.to_json(F.struct("instruction", "output")).alias("value")))


@query("q_shuffle_head", "SELECT doc_id, n_chars FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50")
def _(spark, d):
    return mix.shuffled_head(table(spark, d, "documents").select("doc_id", "n_chars"), 50, "doc_id")


@query("q_alignment_budget", f"""WITH {SIZED}, s AS (SELECT coalesce(sum(token_count) FILTER (layer = 'alignment'), 0)::DOUBLE AS a, coalesce(sum(token_count) FILTER (layer <> 'alignment'), 0)::DOUBLE AS o FROM sized)
SELECT greatest(0, trunc((0.3::DOUBLE * o - a * (1 - 0.3::DOUBLE)) / (1 - 0.3::DOUBLE)))::BIGINT AS budget FROM s""")
def _(spark, d):
    return mix.alignment_budget(_sized(spark, d), 0.3)


@query("q_mean_tokens", f"WITH {SIZED} SELECT (sum(token_count) // count(*))::BIGINT AS mean_tokens FROM sized")
def _(spark, d):
    return mix.mean_tokens(_sized(spark, d))


@query("q_greedy_budget", """WITH RECURSIVE d AS (SELECT coalesce(layer, 'none') AS layer, doc_id, greatest(1, length(coalesce(text, '')) // 4)::BIGINT AS t, row_number() OVER (PARTITION BY coalesce(layer, 'none') ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents),
f AS (SELECT layer, 0::BIGINT AS rn, 20000::BIGINT AS room, NULL::BIGINT AS doc_id, 0::BIGINT AS t, false AS taken FROM (SELECT DISTINCT layer FROM d)
 UNION ALL SELECT d.layer, d.rn, CASE WHEN d.t <= f.room THEN f.room - d.t ELSE f.room END, d.doc_id, d.t, d.t <= f.room FROM f JOIN d ON d.layer = f.layer AND d.rn = f.rn + 1)
SELECT layer, doc_id, t AS tokens FROM f WHERE taken""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("layer", F.lit("none")).alias("layer"), X.token_estimate(X.text_or_empty(F.col("text"))).alias("tokens"))
    return mix.greedy_budget(docs, 20_000, "layer", "doc_id", "tokens").select("layer", F.col("id").alias("doc_id"), F.col("t").alias("tokens"))


@query("q_stats_document", f"""WITH {SIZED} SELECT 'total_examples' AS part, '' AS key, count(*)::DOUBLE AS value FROM sized UNION ALL SELECT 'total_tokens', '', sum(token_count)::DOUBLE FROM sized
UNION ALL SELECT 'layer_counts', layer, count(*)::DOUBLE FROM sized GROUP BY layer UNION ALL SELECT 'language_counts', language, count(*)::DOUBLE FROM sized GROUP BY language
UNION ALL SELECT 'token_ratios', layer, round_even(count(*)::DOUBLE / (SELECT greatest(sum(token_count), 1) FROM sized) * 100, 1) FROM sized GROUP BY layer""")
def _(spark, d):
    maps = lambda c: F.transform(F.map_entries(c), lambda x: F.struct(F.lit(c).alias("part"), x["key"].alias("key"), x["value"].cast("double").alias("value")))
    one = lambda c: F.array(F.struct(F.lit(c).alias("part"), F.lit("").alias("key"), F.col(c).cast("double").alias("value")))
    whole = F.concat(one("total_examples"), one("total_tokens"), *map(maps, ("layer_counts", "language_counts", "token_ratios")))
    return mix.stats_document(_sized(spark, d)).select(F.inline(whole))


# --- joins ---


@query("q_seed_anti_join", f"WITH {PAIRS} SELECT pos FROM pairs WHERE sha256(output) NOT IN (SELECT sha256(text) FROM documents WHERE text IS NOT NULL)")
def _(spark, d):
    return dedup.without_known(_pairs(spark, d), table(spark, d, "documents").select(F.col("text").alias("output")), "output").select("pos")


@query("q_resume_anti_join", "SELECT _idx, max_tokens FROM jobs WHERE _idx NOT IN (SELECT _idx FROM job_results WHERE _idx IS NOT NULL AND coalesce(_worker, '') <> 'lost')")
def _(spark, d):
    return dedup.pending(table(spark, d, "jobs"), table(spark, d, "job_results")).select("_idx", "max_tokens")


@query("q_best_results", "SELECT result_id, _idx, _worker, _len FROM (SELECT *, row_number() OVER (PARTITION BY _idx ORDER BY result_id) AS rn FROM job_results WHERE _idx >= 0 AND _idx < (SELECT max(_idx) + 1 FROM jobs) AND coalesce(_worker, '') <> 'lost') WHERE rn = 1")
def _(spark, d):
    total = table(spark, d, "jobs").agg(F.max("_idx") + 1).first()[0]
    return infer.best_results(table(spark, d, "job_results"), "result_id", total).select("result_id", "_idx", "_worker", "_len")


@query("q_merged_results", """WITH t AS (SELECT max(_idx) + 1 AS total FROM jobs), v AS (SELECT *, CASE WHEN result_id % 2 = 0 THEN 0 ELSE 1 END AS f FROM job_results, t WHERE _idx >= 0 AND _idx < total AND coalesce(_worker, '') <> 'lost')
SELECT _idx, _worker, _text, _len FROM (SELECT *, row_number() OVER (PARTITION BY _idx ORDER BY f, _text IS NULL, _worker NULLS FIRST, _text NULLS FIRST, _len NULLS FIRST) AS rn FROM v) WHERE rn = 1 ORDER BY _idx""")
def _(spark, d):
    r = table(spark, d, "job_results").select("result_id", "_idx", "_worker", "_text", "_len")
    total = table(spark, d, "jobs").agg(F.max("_idx") + 1).first()[0]
    return infer.merged_results(r.where("result_id % 2 <> 0").drop("result_id"), r.where("result_id % 2 = 0").drop("result_id"), total)


@query("q_result_left_join", "SELECT j._idx, j.max_tokens, r._text, r._worker FROM jobs j LEFT JOIN job_results r USING (_idx)")
def _(spark, d):
    return infer.join_results(table(spark, d, "jobs").select("_idx", "max_tokens"), table(spark, d, "job_results"))


@query("q_positional_zip", """WITH l AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents), r AS (SELECT _len AS reply_len, row_number() OVER (ORDER BY result_id) - 1 AS pos FROM job_results)
SELECT l.pos, l.doc_id, r.reply_len FROM l LEFT JOIN r USING (pos)""")
def _(spark, d):
    left, right = table(spark, d, "documents").select("doc_id"), table(spark, d, "job_results").select("result_id", F.col("_len").alias("reply_len"))
    return infer.positional_zip(left, right, "doc_id", "result_id", "reply_len").select("pos", "doc_id", "reply_len")


@query("q_combo_cross_join", """WITH p AS (SELECT row_number() OVER () - 1 AS i, p FROM (VALUES ('early return'), ('clear names'), ('single purpose'), ('explicit errors'), ('bounded loops'), ('no hidden state')) t(p)),
l AS (SELECT row_number() OVER () - 1 AS k, l FROM (VALUES ('python'), ('c'), ('javascript'), ('html'), ('css')) t(l)), n AS (SELECT range AS r FROM range(16))
SELECT (r * 30 + i * 5 + k)::BIGINT AS pos, p AS principle, l AS language FROM n, p, l""")
def _(spark, d):
    return mix.combinations(spark, list(seeds.PRINCIPLES), list(seeds.LANGUAGES), 200)


@query("q_hash_pairing", """SELECT chunk_id, ['early return', 'clear names', 'single purpose', 'explicit errors', 'bounded loops', 'no hidden state'][(('0x' || substr(md5('42:' || chunk_id), 1, 8))::BIGINT % 6 + 1)::INT] AS principle FROM code_chunks_raw""")
def _(spark, d):
    return table(spark, d, "code_chunks_raw").select("chunk_id", mix.paired(None, list(seeds.PRINCIPLES), "chunk_id").alias("principle"))


@query("q_hint_lookup", f"""WITH h(principle, hint) AS (VALUES {', '.join(f"('{p}', '{h}')" for p, h in seeds.PRINCIPLES.items())})
SELECT t.msg_id, coalesce(h.hint, t.metadata.principle) AS hint FROM train t LEFT JOIN h ON h.principle = t.metadata.principle""")
def _(spark, d):
    return infer.with_hints(table(spark, d, "train").select("msg_id", F.col("metadata.principle").alias("principle")), seeds.PRINCIPLES).select("msg_id", "hint")


@query("q_not_language", "SELECT chunk_id, language FROM code_chunks_raw WHERE language IS DISTINCT FROM 'css'")
def _(spark, d):
    return infer.not_language(table(spark, d, "code_chunks_raw"), "css").select("chunk_id", "language")


# --- mappers and text functions ---


@query("q_map_doc", f"""SELECT * FROM (SELECT doc_id, {_strip("coalesce(topic, '')")} AS instruction, {_strip("coalesce(text, '')")} AS output, 'doc' AS layer, source, license FROM documents) WHERE instruction <> '' AND output <> ''""")
def _(spark, d):
    m = records.map_rows(table(spark, d, "documents"), "topic", "text", keep=("doc_id",), layer="doc", source=F.col("source"), license=F.col("license"))
    return m.select("doc_id", "instruction", "output", "metadata.layer", "metadata.source", "metadata.license")


@query("q_map_code", f"""SELECT * FROM (SELECT chunk_id, {_strip("coalesce(name, '')")} AS instruction, {_strip("coalesce(code, '')")} AS output, {_strip("coalesce(signature, '')")} AS input, language FROM code_chunks_raw) WHERE instruction <> '' AND output <> ''""")
def _(spark, d):
    m = records.map_rows(table(spark, d, "code_chunks_raw"), "name", "code", "signature", keep=("chunk_id",), layer="code", language=F.col("language"))
    return m.select("chunk_id", "instruction", "output", "input", "metadata.language")


@query("q_map_alignment", f"""SELECT * FROM (SELECT msg_id, {_strip("coalesce(metadata.topic, '')")} AS instruction, {_strip("coalesce(content, '')")} AS output, nullif(metadata.language, '') AS language, nullif(metadata.principle, '') AS principle, 'alignment' AS layer FROM train) WHERE instruction <> '' AND output <> ''""")
def _(spark, d):
    rows = table(spark, d, "train").withColumn("topic", F.col("metadata.topic"))
    m = records.map_rows(rows, "topic", "content", keep=("msg_id",), layer="alignment", language=F.col("metadata.language"), principle=F.col("metadata.principle"))
    return m.select("msg_id", "instruction", "output", "metadata.language", "metadata.principle", "metadata.layer")


@query("q_seed_record", """SELECT chunk_id, 'Refactor this ' || coalesce(language, 'unknown') || ' code to follow ' || p || '.' AS instruction, coalesce(code, '') AS input, '<thought>' || coalesce(name, '') || '</thought>' || chr(10) || chr(10) || coalesce(signature, '') AS output, p AS principle
FROM (SELECT *, ['early return', 'clear names', 'single purpose', 'explicit errors', 'bounded loops', 'no hidden state'][(('0x' || substr(md5('42:' || chunk_id), 1, 8))::BIGINT % 6 + 1)::INT] AS p FROM code_chunks_raw)""")
def _(spark, d):
    text = lambda c: F.coalesce(c, F.lit(""))
    rows = table(spark, d, "code_chunks_raw").withColumn("p", mix.paired(None, list(seeds.PRINCIPLES), "chunk_id"))
    r = rows.select("chunk_id", *records.seed_record(F.coalesce("language", F.lit("unknown")), F.col("p"), text("code"), text("name"), text("signature")))
    return r.select("chunk_id", "instruction", "input", "output", "metadata.principle")


@query("q_seeds", f"SELECT * FROM (VALUES ('alignment', 'seed', {len(seeds._ALIGNMENT)}::BIGINT), ('devops', 'seed', {len(seeds._OPERATIONS)}::BIGINT), ('alignment', 'whitepaper', {len(seeds._PAPERS)}::BIGINT)) t(layer, source, n)")
def _(spark, d):
    whole = mix.union_layers(seeds.alignment_seeds(spark), seeds.operations_seeds(spark), seeds.paper_rows(spark))
    return whole.groupBy("metadata.layer", "metadata.source").agg(F.count("*").alias("n"))


@query("q_chat_pairs", f"""WITH t AS (SELECT example_id, turn, lower(role) AS role, {_strip("coalesce(content, '')")} AS c FROM train),
g AS (SELECT example_id, arg_min(c, turn) FILTER (role IN ('human', 'user') AND c <> '') AS instruction, arg_min(c, turn) FILTER (role IN ('gpt', 'assistant') AND c <> '') AS output FROM t GROUP BY example_id)
SELECT * FROM g WHERE instruction IS NOT NULL AND output IS NOT NULL""")
def _(spark, d):
    return records.chat_pairs(table(spark, d, "train"), "example_id", "turn", "role", "content")


@query("q_chat_pairs_nested", _SQL["q_chat_pairs"])
def _(spark, d):
    turns = table(spark, d, "train").groupBy("example_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "content"))), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("t"))
    return records.chat_pairs_nested(turns.select("example_id", F.to_json("t").alias("conversations")), "conversations", ("example_id",))


@query("q_chunk_record", "SELECT chunk_id, 'Write ' || coalesce(name, 'this code') AS instruction, code AS output, repo, name AS chunk_name FROM code_chunks_raw")
def _(spark, d):
    r = records.chunk_record(table(spark, d, "code_chunks_raw"), F.concat(F.lit("Write "), F.coalesce("name", F.lit("this code"))), ("chunk_id",))
    return r.select("chunk_id", "instruction", "output", "metadata.repo", "metadata.chunk_name")


@query("q_prompt_build", "SELECT chunk_id, 'Read this ' || coalesce(language, 'null') || ' code and state in one sentence the task it solves.' || chr(10) || chr(10) || substr(coalesce(code, 'null'), 1, 2000) || chr(10) || chr(10) || 'Task:' AS prompt FROM code_chunks_raw")
def _(spark, d):
    return table(spark, d, "code_chunks_raw").select("chunk_id", infer.instruction_prompt(F.coalesce("language", F.lit("null")), F.coalesce("code", F.lit("null"))).alias("prompt"))


@query("q_instruction_validation", f"""WITH j AS (SELECT r.result_id, {_strip("coalesce(r._text, '')")} AS t, coalesce(j.prompt, '') AS code FROM job_results r JOIN jobs j USING (_idx)),
w AS (SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(code), '{SPACE}+'), lambda x: x <> '')[1:20]) AS head, list_filter(regexp_split_to_array(lower(t), '{SPACE}+'), lambda x: x <> '') AS mine FROM j)
SELECT result_id, CASE WHEN t = '' THEN 'empty' WHEN length(t) < 5 THEN 'short' WHEN regexp_matches(lower(t), '^(i cannot|i''m unable|i am unable|sorry)') THEN 'refusal'
 WHEN len(head) > 5 AND len(list_intersect(head, mine)) > 0.8 * len(head) THEN 'echo' END AS defect FROM w""")
def _(spark, d):
    j = table(spark, d, "job_results").join(table(spark, d, "jobs").select("_idx", "prompt"), "_idx")
    return j.select("result_id", quality.instruction_defect(F.col("_text"), F.col("prompt")).alias("defect"))


@query("q_echo_overlap", f"""WITH w AS (SELECT r.result_id, list_distinct(list_filter(regexp_split_to_array(lower(j.prompt), '{SPACE}+'), lambda x: x <> '')[1:20]) AS head, list_filter(regexp_split_to_array(lower(r._text), '{SPACE}+'), lambda x: x <> '') AS mine FROM job_results r JOIN jobs j USING (_idx) WHERE r._text IS NOT NULL AND j.prompt IS NOT NULL)
SELECT result_id, len(list_intersect(head, mine))::INT AS common, len(head)::INT AS n_words FROM w""")
def _(spark, d):
    j = table(spark, d, "job_results").where("_text IS NOT NULL").join(table(spark, d, "jobs").where("prompt IS NOT NULL").select("_idx", "prompt"), "_idx")
    common, n = quality.echo_overlap(F.col("_text"), F.col("prompt"))
    return j.select("result_id", common.alias("common"), n.alias("n_words"))


@query("q_safe_filename", """WITH n AS (SELECT chunk_id, coalesce(repo, '') || '/' || file_path || '#' || coalesce(signature, '') AS u FROM code_chunks_raw),
c AS (SELECT *, regexp_replace(u, '[^a-zA-Z0-9_-]', '_', 'g') AS s FROM n)
SELECT chunk_id, CASE WHEN length(s) <= 64 THEN s ELSE substr(s, 1, 55) || '_' || substr(sha1(u), 1, 8) END AS file_name FROM c""")
def _(spark, d):
    u = F.concat(F.coalesce("repo", F.lit("")), F.lit("/"), F.col("file_path"), F.lit("#"), F.coalesce("signature", F.lit("")))
    return table(spark, d, "code_chunks_raw").select("chunk_id", X.safe_filename(u).alias("file_name"))


@query("q_fence_strip", rf"""WITH t AS (SELECT msg_id, {_strip("content")} AS s FROM train WHERE content IS NOT NULL),
l AS (SELECT msg_id, CASE WHEN s = '' THEN [] ELSE regexp_split_to_array(s, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]') END AS l FROM t),
h AS (SELECT msg_id, CASE WHEN len(l) > 0 AND starts_with({_strip("l[1]")}, '```') THEN l[2:] ELSE l END AS l FROM l),
e AS (SELECT msg_id, CASE WHEN len(l) > 0 AND starts_with({_strip("l[-1]")}, '```') THEN l[:-2] ELSE l END AS l FROM h)
SELECT msg_id, {_strip("coalesce(array_to_string(l, chr(10)), '')")} AS code FROM e""")
def _(spark, d):
    return table(spark, d, "train").where("content IS NOT NULL").select("msg_id", X.strip_fences(F.col("content")).alias("code"))


@query("q_generated_code", rf"""WITH t AS (SELECT result_id, {_strip("coalesce(_text, '')")} AS s FROM job_results),
l AS (SELECT result_id, CASE WHEN s = '' THEN [] ELSE regexp_split_to_array(s, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]') END AS l FROM t),
h AS (SELECT result_id, CASE WHEN len(l) > 0 AND starts_with({_strip("l[1]")}, '```') THEN l[2:] ELSE l END AS l FROM l),
e AS (SELECT result_id, CASE WHEN len(l) > 0 AND starts_with({_strip("l[-1]")}, '```') THEN l[:-2] ELSE l END AS l FROM h)
SELECT * FROM (SELECT result_id, {_strip("coalesce(array_to_string(l, chr(10)), '')")} AS code FROM e) WHERE length(code) >= 10""")
def _(spark, d):
    return table(spark, d, "job_results").select("result_id", infer.generated_code(F.col("_text")).alias("code")).where("code IS NOT NULL")


@query("q_chunk_name", f"""WITH f AS (SELECT chunk_id, {_strip("string_split(code, chr(10))[1]")} AS l FROM code_chunks_raw WHERE code IS NOT NULL),
b AS (SELECT *, list_filter(regexp_split_to_array(string_split(l, '(')[1], '{SPACE}+'), lambda x: x <> '') AS w FROM f)
SELECT chunk_id, CASE WHEN contains(l, '(') AND len(w) > 0 THEN w[-1] ELSE substr(l, 1, 64) END AS name, substr(l, 1, 256) AS signature FROM b""")
def _(spark, d):
    line = X.first_line(F.col("code"))
    return table(spark, d, "code_chunks_raw").where("code IS NOT NULL").select("chunk_id", X.chunk_name(line).alias("name"), X.chunk_signature(line).alias("signature"))


@query("q_line_filter", """WITH f AS (SELECT chunk_id, file_path, CASE WHEN code = '' THEN 0 ELSE length(code) - length(replace(code, chr(10), '')) + CASE WHEN ends_with(code, chr(10)) THEN 0 ELSE 1 END END AS n_lines FROM code_chunks_raw WHERE code IS NOT NULL)
SELECT chunk_id, n_lines::BIGINT AS n_lines FROM f WHERE n_lines <= 5000 AND regexp_matches(file_path, '[^/](\\.py|\\.js|\\.c|\\.h)$') AND NOT list_has_any(string_split(file_path, '/'), ['vendor', 'build_tools', '3rdparty', 'bundled'])""".replace("\\\\", "\\"))
def _(spark, d):
    rows = table(spark, d, "code_chunks_raw").where("code IS NOT NULL").withColumn("n_lines", X.file_lines(F.col("code")))
    return rows.where(quality.source_file_ok(F.col("file_path"), F.col("n_lines"), [".py", ".js", ".c", ".h"], ["vendor", "build_tools", "3rdparty", "bundled"])).select("chunk_id", "n_lines")


@query("q_config_files", r"""SELECT doc_id FROM (SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), '')) + CASE WHEN ends_with(text, chr(10)) THEN 0 ELSE 1 END END AS n, source || '/' || coalesce(topic, 'makefile') || CASE WHEN layer = 'devops' THEN '.YAML' ELSE '' END AS p FROM documents WHERE text IS NOT NULL)
WHERE n BETWEEN 1 AND 5000 AND p IS NOT NULL AND (regexp_matches(lower(p), '(^|/)makefile(\..*)?$') OR regexp_matches(lower(p), '(^|/)dockerfile[^/]*$') OR regexp_matches(lower(p), '[^/]\.(yaml|yml)$'))""")
def _(spark, d):
    path = F.concat("source", F.lit("/"), F.coalesce("topic", F.lit("makefile")), F.when(F.col("layer") == "devops", ".YAML").otherwise(""))
    rows = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", path.alias("path"), X.file_lines(F.col("text")).alias("n"))
    return rows.where(quality.config_file_ok(F.col("path"), F.col("n"), [".yaml", ".yml"])).select("doc_id")


@query("q_squeeze", f"""SELECT doc_id, {_strip(f"regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g')")} AS text FROM documents""")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", X.squeeze(X.text_or_empty(F.col("text"))).alias("text"))


@query("q_decode", "SELECT doc_id, text || chr(65533) || '!' AS text FROM documents WHERE text IS NOT NULL")
def _(spark, d):
    """Texts as bytes with a malformed one before the end, decoded."""
    content = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF21")))
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", X.decode_text(content).alias("text"))


@query("q_duration", "WITH s AS (SELECT result_id, greatest(coalesce(_len, 0), 0) * 37 AS s FROM job_results) SELECT result_id, CASE WHEN s >= 3600 THEN (s // 3600)::VARCHAR || 'h ' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || 'm' WHEN s >= 60 THEN (s // 60)::VARCHAR || 'm ' || lpad((s % 60)::VARCHAR, 2, '0') || 's' ELSE s::VARCHAR || 's' END AS eta FROM s")
def _(spark, d):
    return table(spark, d, "job_results").select("result_id", X.duration(F.coalesce("_len", F.lit(0)) * 37).alias("eta"))


# --- chunks ---

_LINES = r"""ls AS (SELECT doc_id, CASE WHEN text = '' THEN [] ELSE regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') END AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, CASE WHEN len(l) > 0 AND l[-1] = '' THEN l[:-2] ELSE l END AS l FROM ls)"""
_YAML = rf"""x AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS ln, unnest(l) AS line FROM lines),
k AS (SELECT *, CASE WHEN regexp_matches(regexp_replace(line, '{SPACE}+\z', ''), '^[A-Za-z0-9_.][A-Za-z0-9_.\-]*:\s*(.*)$') AND NOT starts_with(line, '---') THEN 1 ELSE 0 END AS opens FROM x),
s AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY ln) AS seg FROM k),
b AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, seg ORDER BY ln) - 1) // 200 AS blk FROM s),
g AS (SELECT doc_id, seg, blk, count(*) AS n, list(line ORDER BY ln) AS l FROM b GROUP BY ALL),
m AS (SELECT *, coalesce(sum((n >= 3)::INT) OVER (PARTITION BY doc_id ORDER BY seg, blk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM g),
cut AS (SELECT doc_id, chunk::INT AS chunk, sum(n)::BIGINT AS n_lines, array_to_string(flatten(list(l ORDER BY seg, blk)), chr(10)) AS text FROM m GROUP BY doc_id, chunk)"""


@query("q_block_chunks", f"""WITH {_LINES}, b AS (SELECT doc_id, l, unnest(range(0, (len(l) + 39) // 40)) AS block FROM lines)
SELECT doc_id, block::INT AS block, len(l[block * 40 + 1 : block * 40 + 40])::INT AS n_lines, array_to_string(l[block * 40 + 1 : block * 40 + 40], chr(10)) AS text FROM b""")
def _(spark, d):
    return chunking.line_blocks(table(spark, d, "documents"), "doc_id", "text", 40).select("doc_id", "block", "n_lines", "text")


@query("q_yaml_split", f"WITH {_LINES}, {_YAML} SELECT * FROM cut")
def _(spark, d):
    return chunking.yaml_chunks(table(spark, d, "documents"), "doc_id", "text")


def _config_files(spark, d):
    kinds = F.array(*map(F.lit, ("conf/app.yaml", "stack/docker-compose.yml", "Makefile", "makefile", "dockerfile.dev", "unit/x.service", "main.tf", "etc/x.ini")))
    return table(spark, d, "documents").select(F.concat_ws("/", "doc_id", F.element_at(kinds, (F.pmod("doc_id", F.lit(8)) + 1).cast("int"))).alias("path"), "text")


_CONFIG_PATH = "doc_id || '/' || ['conf/app.yaml', 'stack/docker-compose.yml', 'Makefile', 'makefile', 'dockerfile.dev', 'unit/x.service', 'main.tf', 'etc/x.ini'][doc_id % 8 + 1]"


def _task(source: str) -> str:
    """SQL: the rows of ``source`` (path, text, ...) with their instruction."""
    return rf"""n AS (SELECT *, string_split(path, '/')[-1] AS name, regexp_extract(text, '(?m)^kind:\s*([A-Za-z]+)', 1) AS kind, regexp_extract(text, 'metadata:\s*\n\s+name:\s*([^\s]+)', 1) AS obj, regexp_extract(text, '(?m)^  ([a-zA-Z0-9_-]+):', 1) AS svc, regexp_extract_all(text, '(?m)^([A-Za-z0-9_-]+):', 1)[1:4] AS rules FROM {source}),
task AS (SELECT *, CASE WHEN regexp_matches(path, '\.ya?ml$') THEN CASE WHEN contains(path, 'compose') THEN 'Write the docker-compose service definition for `' || CASE WHEN svc = '' THEN 'app' ELSE svc END || '` as shown.'
  WHEN kind <> '' AND obj <> '' THEN 'Write the Kubernetes ' || kind || ' manifest for `' || obj || '`.' WHEN kind <> '' THEN 'Write the Kubernetes ' || kind || ' manifest shown here.'
  WHEN contains(text, '---') THEN 'Provide the Kubernetes configuration defined in ' || name || '.' ELSE 'Provide the YAML configuration defined in ' || name || '.' END
 WHEN starts_with(name, 'dockerfile') THEN 'Write the ' || name || ' multi-stage build shown here.' WHEN name = 'makefile' THEN 'Write the Makefile target(s) for: ' || coalesce(array_to_string(rules, ', '), '') || '.'
 WHEN ends_with(path, '.service') THEN 'Write the systemd service unit defined in ' || name || '.' WHEN ends_with(path, '.tf') THEN 'Write the Terraform configuration defined in ' || name || '.'
 ELSE 'Provide the DevOps configuration defined in ' || name || '.' END AS instruction FROM n)"""


@query("q_config_instruction", f"WITH f AS (SELECT {_CONFIG_PATH} AS path, text FROM documents WHERE text IS NOT NULL), {_task('f')} SELECT path, instruction FROM task")
def _(spark, d):
    return _config_files(spark, d).where("text IS NOT NULL").select("path", chunking.config_instruction(F.col("path"), F.col("text")).alias("instruction"))


_COUNT = r"""len(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]')) - CASE WHEN regexp_matches(text, '[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]\z') THEN 1 ELSE 0 END"""


@query("q_config_chunks", f"""WITH {_LINES}, {_YAML}, live AS (SELECT doc_id, {_CONFIG_PATH} AS path, text FROM documents WHERE {_strip("coalesce(text, '')")} <> ''),
c AS (SELECT path, chunk, cut.text FROM cut JOIN live USING (doc_id) WHERE doc_id % 8 < 2 UNION ALL SELECT path, 0, text FROM live WHERE doc_id % 8 >= 2),
ok AS (SELECT *, {_COUNT} AS n FROM c WHERE text <> '' AND {_COUNT} >= 3),
bl AS (SELECT path, chunk, regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]')[1:n] AS l, n, unnest(range(0, (n + 199) // 200)) AS part FROM ok WHERE length(text) > 16384),
parts AS (SELECT path, chunk, 0 AS part, text FROM ok WHERE length(text) <= 16384 UNION ALL SELECT path, chunk, part, array_to_string(l[part * 200 + 1 : part * 200 + 200], chr(10)) FROM bl WHERE least(n - part * 200, 200) >= 3), {_task('parts')}
SELECT path, chunk::INT AS chunk, part::INT AS part, instruction, text AS output FROM task""")
def _(spark, d):
    return chunking.config_chunks(_config_files(spark, d))


@query("q_source_chunks")
def _(spark, d):
    return chunking.source_chunks(table(spark, d, "code_chunks_raw"), text="code")


_HTML = lambda c: F.replace(F.replace(X.text_or_empty(F.col(c)), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _join(*parts: str) -> str:
    """SQL: the parts that aren't empty, a blank line between them."""
    return "array_to_string(list_filter([" + ", ".join(parts) + "], lambda x: x <> ''), chr(10) || chr(10))"


@query("q_html_reference", f"""WITH p AS (SELECT doc_id, {_strip("coalesce(topic, 'untitled')")} AS topic, {_strip("coalesce(source, '')")} AS syntax, substr({_strip("coalesce(text, '')")}, 1, 1000) AS p FROM documents)
SELECT 'docs/' || doc_id AS key, 'What is the MDN reference for ' || topic || '?' AS instruction, {_join('syntax', 'p')} AS output, topic FROM p""")
def _(spark, d):
    h = F.format_string("<html><body><main><h1>%s</h1><p>%s</p><div class='syntax'><pre>%s</pre></div></main></body></html>", F.coalesce("topic", F.lit("untitled")), _HTML("text"), _HTML("source"))
    return pages.page_records(table(spark, d, "documents").select(F.concat(F.lit("docs/"), "doc_id").alias("key"), h.alias("html")), "web", "key")


@query("q_c_reference", f"""WITH p AS (SELECT chunk_id, {_strip("coalesce(name, '')")} AS name, {_strip("coalesce(signature, '')")} AS signature, {_strip("coalesce(file_path, '')")} AS p, {_strip("coalesce(code, '')")} AS code FROM code_chunks_raw)
SELECT chunk_id::VARCHAR AS key, 'What is the signature and purpose of C''s ' || name || '?' AS instruction, {_join('signature', 'p', 'code')} AS output, name AS topic FROM p WHERE signature <> '' OR p <> ''""")
def _(spark, d):
    h = F.format_string("<body><h1>%s</h1><code>x</code><code class='t-cpp'>%s</code><p>%s</p><div class='example'><pre>%s</pre></div></body>", *map(_HTML, ("name", "signature", "file_path", "code")))
    return pages.page_records(table(spark, d, "code_chunks_raw").select("chunk_id", h.alias("html")), "c", "chunk_id")


@query("q_python_reference", f"""WITH p AS (SELECT chunk_id::VARCHAR AS key, {_strip(f"regexp_replace(coalesce(signature, ''), '{SPACE}+', ' ', 'g')")} AS s, substr({_strip("coalesce(code, '')")}, 1, 1000) AS dd FROM code_chunks_raw),
q AS (SELECT *, key || '.' || string_split({_strip("string_split(s, '(')[1]")}, '.')[-1] AS name FROM p WHERE contains(s, '('))
SELECT key, 'What is the Python ' || name || ' function signature and behavior?' AS instruction, {_join('s', 'dd')} AS output, name AS topic FROM q""")
def _(spark, d):
    h = F.format_string("<body><dl><dt class='sig'>%s<a>¶</a></dt><dd>%s</dd></dl></body>", _HTML("signature"), _HTML("code"))
    return pages.page_records(table(spark, d, "code_chunks_raw").select("chunk_id", h.alias("html")), "python", "chunk_id")


# --- runs of completions ---


def _echo(prompt: str) -> str:
    """SQL: what the offline backend completes."""
    return f"'Write code for task ' || substr(sha256({prompt}), 1, 12) || '.'"


_RULES = "h(principle, hint) AS (VALUES " + ", ".join(f"('{p}', '{h}')" for p, h in seeds.PRINCIPLES.items()) + ")"
_COMPLETED = f"""r AS (SELECT _idx, coalesce(max_tokens, 128)::INT AS max_tokens, coalesce(temperature, 0.7)::DOUBLE AS temperature, top_p, CASE WHEN contains(coalesce(prompt, ''), 'FAIL') THEN NULL ELSE {_echo("coalesce(prompt, '')")} END AS t, CASE WHEN stop IS NULL OR len(stop) = 0 THEN [chr(10) || chr(10)] ELSE stop END AS stop FROM jobs),
c AS (SELECT *, list_min(list_filter(list_transform(stop, lambda s: CASE WHEN s <> '' THEN instr(t, s) END), lambda x: x > 0)) AS stop_at FROM r),
e AS (SELECT *, {_strip("CASE WHEN stop_at IS NULL THEN t ELSE substr(t, 1, stop_at - 1) END")} AS _text FROM c),
done AS (SELECT _idx, max_tokens, temperature, top_p, 'echo0' AS _worker, _text, coalesce(length(_text), 0)::BIGINT AS _len FROM e)"""


@query("q_completions", f"WITH {_COMPLETED} SELECT * FROM done WHERE _idx NOT IN (SELECT _idx FROM job_results WHERE _idx IS NOT NULL AND _len > 0 AND coalesce(_worker, '') <> 'lost')")
def _(spark, d):
    return infer.run_completions(table(spark, d, "jobs"), done=table(spark, d, "job_results").where("_len > 0"))


@query("q_requests", "SELECT _idx, prompt, coalesce(max_tokens, 128)::INT AS max_tokens, coalesce(temperature, 0.7)::DOUBLE AS temperature, top_p, stop FROM jobs")
def _(spark, d):
    return infer.requests(table(spark, d, "jobs"), infer.WorkerSpec("cpu", "cpu0"))


@query("q_completion_stream", f"WITH {_COMPLETED} SELECT * FROM done")
def _(spark, d):
    """Jobs that come as files, completed batch by batch into folders of their own."""
    jobs, out = table(spark, d, "jobs"), fresh_path(spark, "stream")
    jobs.write.parquet(f"{out}/jobs")
    streams.resumable_results(spark, f"{out}/jobs", jobs.schema, f"{out}/results", f"{out}/checkpoint", infer.run_completions).awaitTermination()
    return spark.read.parquet(f"{out}/results").drop("batch")


@query("q_completion_run", f"WITH {_COMPLETED} SELECT * FROM done ORDER BY _idx")
def _(spark, d):
    """A run that is interrupted halfway and goes on: its output, in the order of the jobs."""
    folder, jobs = fresh_path(spark, "run"), table(spark, d, "jobs")
    infer.run_completions(jobs.where("_idx % 2 = 0")).write.parquet(f"{folder}/partial")
    infer.run_to_folder(spark, jobs, folder)
    return spark.read.schema(infer.RESULT).parquet(f"{folder}/results").orderBy("_idx")


@query("q_run_plan", "SELECT count(*) AS jobs, (count(*) + 1) // 2 AS resumed, 'echo0' AS worker FROM jobs")
def _(spark, d):
    """What plan.json says of such a run."""
    folder, jobs = fresh_path(spark, "run"), table(spark, d, "jobs")
    infer.run_completions(jobs.where("_idx % 2 = 0")).write.parquet(f"{folder}/partial")
    infer.run_to_folder(spark, jobs, folder)
    plan = spark.read.option("multiLine", "true").json(f"{folder}/plan.json")
    return plan.select("jobs", "resumed", F.get(F.map_keys(F.from_json(F.to_json("workers"), "map<string,bigint>")), F.lit(0)).alias("worker"))


@query("q_run_stats", """WITH f AS (SELECT _idx, max((coalesce(length(_text), 0) > 0)::INT) AS ok FROM job_results WHERE _idx IS NOT NULL GROUP BY 1), j AS (SELECT count(*) AS jobs, sum(coalesce(ok, 0))::BIGINT AS ok FROM jobs LEFT JOIN f USING (_idx))
SELECT jobs, ok, jobs - ok AS failed, 0::BIGINT AS resumed, 600.0::DOUBLE AS elapsed_s, round_even(ok::DOUBLE / jobs * 100, 1) AS ok_pct, round_even(jobs / 600.0::DOUBLE, 3) AS jobs_per_s FROM j""")
def _(spark, d):
    return infer.run_stats(table(spark, d, "jobs"), table(spark, d, "job_results"), 600.0)


@query("q_worker_rates", """WITH w AS (SELECT _worker, count(*) AS jobs, coalesce(sum(_len), 0)::BIGINT AS chars, (epoch_us(max(recorded_at)) - epoch_us(min(recorded_at))) / 1e6::DOUBLE AS seconds FROM job_results GROUP BY 1)
SELECT *, CASE WHEN seconds > 0 THEN jobs / seconds END AS jobs_per_s, CASE WHEN seconds > 0 THEN chars / seconds END AS chars_per_s FROM w""")
def _(spark, d):
    return infer.worker_rates(table(spark, d, "job_results"))


@query("q_metric_avg", "SELECT coalesce(round_even(avg(value) FILTER (event_type = 'click'), 1), 0) AS avg_gpu, coalesce(round_even(avg(value), 1), 0) AS avg_cpu FROM events")
def _(spark, d):
    return files.metric_averages(table(spark, d, "events").select(F.when(F.col("event_type") == "click", F.col("value")).alias("gpu_util_pct"), F.col("value").alias("cpu_pct")))


_EXPANDED = f"""{_RULES}, p AS (SELECT row_number() OVER () - 1 AS i, principle, hint FROM h), l AS (SELECT row_number() OVER () - 1 AS k, l FROM (VALUES ('python'), ('c'), ('javascript'), ('html'), ('css')) t(l)),
b AS (SELECT (i * 5 + k)::BIGINT AS pos, principle, l AS language, hint, {_echo("'Write a short ' || l || ' function that breaks this rule: ' || hint || '. Code only.'")} AS bad FROM p, l),
x AS (SELECT pos, principle, language, bad, {_echo("'Here is ' || language || ' code:' || chr(10) || chr(10) || bad || chr(10) || chr(10) || 'Rewrite it so that it keeps the rule: ' || hint || '. Code only.'")} AS good FROM b)"""


@query("q_alignment_expansion", f"WITH {_EXPANDED} SELECT * FROM x")
def _(spark, d):
    return infer.expand_alignment(mix.combinations(spark, list(seeds.PRINCIPLES), list(seeds.LANGUAGES), 200), seeds.PRINCIPLES)


@query("q_alignment_target", f"WITH {_EXPANDED} SELECT * FROM x ORDER BY md5('42:' || pos), pos LIMIT 12")
def _(spark, d):
    return infer.expand_alignment(mix.combinations(spark, list(seeds.PRINCIPLES), list(seeds.LANGUAGES), 200), seeds.PRINCIPLES, target=12)


@query("q_alignment_layer", f"WITH {_EXPANDED} SELECT 'seed' AS source, {len(seeds._ALIGNMENT)}::BIGINT AS n UNION ALL SELECT 'expansion', count(DISTINCT good) FROM x")
def _(spark, d):
    made = infer.expand_alignment(mix.combinations(spark, list(seeds.PRINCIPLES), list(seeds.LANGUAGES), 200), seeds.PRINCIPLES)
    both = mix.union_layers(seeds.alignment_seeds(spark), made.select(*records.seed_record(F.col("language"), F.col("principle"), F.col("bad"), F.col("principle"), F.col("good"), "expansion")))
    return both.groupBy("metadata.source").agg(F.count("*").alias("n"))


@query("q_alignment_rounds", f"WITH {_EXPANDED} SELECT * FROM x WHERE good NOT IN (SELECT text FROM documents WHERE text IS NOT NULL) ORDER BY pos LIMIT 20")
def _(spark, d):
    known = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("text").alias("good"))
    return infer.expand_in_rounds(spark, list(seeds.PRINCIPLES), list(seeds.LANGUAGES), seeds.PRINCIPLES, 20, known=known)


@query("q_align_code", f"""WITH {_RULES}, c AS (SELECT chunk_id AS pos, language, code, ['early return', 'clear names', 'single purpose', 'explicit errors', 'bounded loops', 'no hidden state'][(('0x' || substr(md5('42:' || chunk_id), 1, 8))::BIGINT % 6 + 1)::INT] AS principle FROM code_chunks_raw WHERE code IS NOT NULL AND language IS DISTINCT FROM 'css' ORDER BY md5('42:' || chunk_id), chunk_id LIMIT 4000),
f AS (SELECT *, coalesce(language, 'unknown') AS l, {_echo("'Here is ' || coalesce(language, 'unknown') || ' code:' || chr(10) || chr(10) || code || chr(10) || chr(10) || 'Rewrite it so that it keeps the rule: ' || hint || '. Code only.'")} AS fix FROM c JOIN h USING (principle)),
o AS (SELECT pos, language, principle, code AS input, 'Refactor this ' || l || ' code to follow ' || principle || '.' AS instruction, '<thought>' || hint || '</thought>' || chr(10) || chr(10) || fix AS output FROM f),
w AS (SELECT *, row_number() OVER (PARTITION BY sha256(output) ORDER BY pos) AS rn FROM o)
SELECT pos, language, principle, input, instruction, output, (greatest(1, length(input) // 4) + greatest(1, length(output) // 4))::BIGINT AS token_count FROM w WHERE rn = 1 AND output NOT IN (SELECT text FROM documents WHERE text IS NOT NULL)""")
def _(spark, d):
    code = table(spark, d, "code_chunks_raw").where("code IS NOT NULL").select(F.col("chunk_id").alias("pos"), "language", F.coalesce("name", F.lit("")).alias("instruction"), F.col("code").alias("output"))
    return infer.expand_from_code(code, table(spark, d, "documents").select(F.col("text").alias("output")), seeds.PRINCIPLES)


@query("q_progress", """WITH w AS (SELECT time_bucket(INTERVAL '1 hour', recorded_at) AS s, count(*) AS n FROM job_results GROUP BY 1), c AS (SELECT s + INTERVAL '1 hour' AS window_end, sum(n) OVER (ORDER BY s)::BIGINT AS done, epoch(s + INTERVAL '1 hour' - min(s) OVER (ORDER BY s)) AS sec FROM w WHERE s IS NOT NULL), j AS (SELECT count(*) AS jobs FROM jobs),
e AS (SELECT *, floor(greatest(jobs - done, 0) / (done / sec))::BIGINT AS left_s FROM c, j)
SELECT window_end, done, round_even(least(done::DOUBLE / jobs * 100, 100), 1) AS pct, round_even(done / sec, 6) AS per_s,
 CASE WHEN left_s >= 3600 THEN (left_s // 3600)::VARCHAR || 'h ' || lpad((left_s % 3600 // 60)::VARCHAR, 2, '0') || 'm' WHEN left_s >= 60 THEN (left_s // 60)::VARCHAR || 'm ' || lpad((left_s % 60)::VARCHAR, 2, '0') || 's' ELSE left_s::VARCHAR || 's' END AS eta FROM e""")
def _(spark, d):
    p = infer.progress(table(spark, d, "jobs").count(), table(spark, d, "job_results").where("recorded_at IS NOT NULL"), "1 hour")
    return p.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@query("q_best_plan", "WITH r AS (SELECT _worker AS plan, rank() OVER (ORDER BY _worker) AS ord, count(*) AS rate FROM job_results WHERE _worker IS NOT NULL GROUP BY 1) SELECT plan, rate FROM r WHERE rate > 0 ORDER BY rate DESC, ord LIMIT 1")
def _(spark, d):
    by = table(spark, d, "job_results").where("_worker IS NOT NULL").groupBy(F.col("_worker").alias("plan")).agg(F.count("*").alias("rate"))
    names = [r["plan"] for r in by.select("plan").orderBy("plan").collect()]  # one row a worker
    return infer.best_plan(by.withColumn("ord", F.array_position(F.array(*map(F.lit, names or [""])), F.col("plan"))))


@query("q_newest_version", r"""WITH n AS (SELECT 'tool-' || p_size || '.' || p_partkey % 10 || '.' || p_partkey % 7 AS name FROM part)
SELECT name FROM n ORDER BY list_transform(string_split(regexp_extract(name, '(\d+(?:\.\d+)*)', 1), '.'), lambda x: x::BIGINT) DESC, name DESC LIMIT 1""")
def _(spark, d):
    name = F.concat(F.lit("tool-"), "p_size", F.lit("."), F.pmod("p_partkey", F.lit(10)), F.lit("."), F.pmod("p_partkey", F.lit(7)))
    return X.newest(table(spark, d, "part").select(name.alias("name")), "name")


@query("q_source_rows_all", """WITH r AS (SELECT doc_id, source, topic AS instruction, row_number() OVER (PARTITION BY source, sha256(text) ORDER BY doc_id) AS rn FROM documents WHERE topic IS NOT NULL AND text IS NOT NULL) SELECT doc_id, source, instruction FROM r WHERE rn = 1""")
def _(spark, d):
    mapped = lambda r: r.where("topic IS NOT NULL AND text IS NOT NULL").select("doc_id", "source", F.col("topic").alias("instruction"), F.col("text").alias("output"))
    return paged.source_rows(table(spark, d, "documents"), mapped, "doc_id", source="source").select("doc_id", "source", "instruction")


@query("q_enough_files", "SELECT repo, count(DISTINCT file_path) AS n_files, count(DISTINCT file_path) >= 6 AS ok FROM code_chunks_raw GROUP BY repo")
def _(spark, d):
    return validate.enough_files(table(spark, d, "code_chunks_raw"), path="file_path")


@query("q_files_by_path", "SELECT file_path, row_number() OVER (ORDER BY file_path) - 1 AS pos FROM (SELECT DISTINCT file_path FROM code_chunks_raw WHERE file_path IS NOT NULL)")
def _(spark, d):
    return infer.numbered(table(spark, d, "code_chunks_raw").where("file_path IS NOT NULL").select("file_path").distinct(), "file_path").select("file_path", "pos")


# --- sinks and streams: written to the shared folder and read back ---


@query("q_jsonl_roundtrip", "SELECT doc_id, text, lang, n_chars FROM documents")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    path = fresh_path(spark, "jsonl")
    files.write_jsonl(docs, path)
    return files.read_jsonl(spark, path, docs.schema)


@query("q_jsonl_append", "SELECT doc_id, text FROM documents")
def _(spark, d):
    docs, path = table(spark, d, "documents").select("doc_id", "text"), fresh_path(spark, "append")
    files.write_jsonl(docs.where("doc_id % 2 = 0"), path)
    files.write_jsonl(docs.where("doc_id % 2 <> 0"), path, "append")
    return files.read_jsonl(spark, path, docs.schema)


@query("q_blank_lines", "SELECT doc_id FROM documents")
def _(spark, d):
    docs, path = table(spark, d, "documents").select("doc_id"), fresh_path(spark, "blank")
    docs.select(F.explode(F.array(F.to_json(F.struct("doc_id")), F.lit(""))).alias("value")).write.text(path)
    return files.read_jsonl(spark, path, docs.schema)


@query("q_bad_lines", "SELECT '{bad ' || doc_id AS line FROM documents WHERE doc_id % 10 = 3")
def _(spark, d):
    path = fresh_path(spark, "bad")
    line = F.when(F.pmod("doc_id", F.lit(10)) == 3, F.concat(F.lit("{bad "), "doc_id")).otherwise(F.to_json(F.struct("doc_id", "text")))
    table(spark, d, "documents").select(line.alias("value")).write.text(path)
    return files.bad_lines(spark, path).select("line")


@query("q_metrics_csv", "SELECT coalesce(round_even(avg(CASE WHEN event_type = 'click' THEN value END), 1), 0) AS avg_gpu, coalesce(round_even(avg(value), 1), 0) AS avg_cpu FROM events")
def _(spark, d):
    """A monitor's CSV, blank where there is no GPU, read back."""
    path = fresh_path(spark, "metrics")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in files.METRICS}
    rows = blank | {"t": F.col("event_id").cast("double"), "cpu_pct": F.col("value"), "gpu_util_pct": F.when(F.col("event_type") == "click", F.col("value"))}
    table(spark, d, "events").select(*(c.alias(k) for k, c in rows.items())).write.option("header", "true").csv(path)
    return files.metric_averages(files.read_metrics(spark, path))


@query("q_pipeline", f"""WITH {PAIRS}, placed AS (SELECT layer, instruction, output, row_number() OVER (ORDER BY sha256(layer || chr(31) || instruction || chr(31) || output)) AS pos FROM pairs WHERE layer IN ('code', 'doc', 'alignment', 'devops')),
sized AS (SELECT *, greatest(1, length(instruction || ' ' || output) // 4) AS token_count FROM placed), ranked AS (SELECT *, row_number() OVER (PARTITION BY layer, sha256(output), token_count BETWEEN 8 AND 2048 ORDER BY pos) AS rn FROM sized)
SELECT layer, instruction, output, token_count FROM ranked WHERE token_count BETWEEN 8 AND 2048 AND rn = 1 AND length(instruction) >= 5 AND strlen(instruction) = length(instruction)""")
def _(spark, d):
    """Layers as files through the phases filter, mix and validate: the set they end in."""
    from granary.plans import pipeline

    data, rows = fresh_path(spark, "data"), _pairs(spark, d)
    for layer in mix.LAYERS:
        files.write_jsonl(rows.where(F.col("layer") == layer).select(*records.record(F.col("instruction"), F.col("output"), layer=layer)), f"{data}/layers/{layer}")
    pipeline.run_phases(spark, ["filter", "mix", "validate"], data, pipeline.parse(["--data", data]))
    return files.read_jsonl(spark, f"{data}/train").select("metadata.layer", "instruction", "output", "token_count")


@query("q_layer_files", f"WITH {SIZED} SELECT pos, token_count FROM sized WHERE layer = 'devops'")
def _(spark, d):
    path = fresh_path(spark, "layers")
    files.write_layers(_sized(spark, d).select("pos", "token_count", "layer"), path)
    return spark.read.parquet(path).where("layer = 'devops'").select("pos", "token_count")


@query("q_stream_metrics", """WITH w AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_type, count(*) AS n, max(value) AS max_value FROM events GROUP BY ALL)
SELECT * FROM w WHERE window_start + INTERVAL '1 day' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)""")
def _(spark, d):
    out = fresh_path(spark, "windows")
    streams.drain(streams.tumbling(files.stream_table(spark, d, "events")), out, fresh_path(spark, "progress"))
    return spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "max_value")


@query("q_stream_progress", "SELECT count(*) AS n FROM events")
def _(spark, d):
    batches = streams.drain(streams.tumbling(files.stream_table(spark, d, "events")), fresh_path(spark, "windows"), fresh_path(spark, "progress"))
    return spark.createDataFrame(batches, "batch BIGINT, n BIGINT").agg(F.sum("n").alias("n"))


@query("q_stream_once", "SELECT sha256(coalesce(content, '')) AS digest FROM train WHERE added_at IS NOT NULL GROUP BY 1")
def _(spark, d):
    out = fresh_path(spark, "once")
    rows = files.stream_table(spark, d, "train").where("added_at IS NOT NULL")
    streams.drain(streams.arrivals_once(rows, "content", "added_at", "3650 days"), out, fresh_path(spark, "progress"))
    return spark.read.parquet(out).select(X.digest(X.text_or_empty(F.col("content"))).alias("digest"))


# --- extensions: events, retrieval, plans ---


@query("q_tumbling_metrics", "SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_type, count(*) AS n, avg(value) AS mean_value, max(value) AS max_value FROM events GROUP BY ALL")
def _(spark, d):
    return streams.tumbling(table(spark, d, "events")).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("q_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '1 hour' THEN 0 ELSE 1 END AS starts FROM events), s AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events FROM s GROUP BY user_id, k""")
def _(spark, d):
    return streams.sessions(table(spark, d, "events")).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("q_pressure_spans", """WITH f AS (SELECT user_id, epoch(ts) AS t, value > 80 AS hot FROM events), i AS (SELECT *, sum(CASE WHEN coalesce(hot, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY t) AS k FROM f)
SELECT user_id::VARCHAR AS host, min(t) AS start_s, max(t) AS end_s, 'cpu' AS kind FROM i WHERE hot GROUP BY user_id, k HAVING max(t) - min(t) > 5""")
def _(spark, d):
    ev = table(spark, d, "events").select(F.col("user_id").cast("string").alias("host"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"), F.col("value").alias("cpu_pct"), F.lit(None).cast("bigint").alias("ram_avail_mb"))
    return dag.pressure_spans(ev)


@query("q_bm25_search", r"""WITH q AS (SELECT doc_id AS query_id, coalesce(text, '') AS query FROM documents WHERE doc_id % 100 = 0),
a AS (SELECT DISTINCT query_id, unnest(list_filter(regexp_split_to_array(lower(query), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM q),
d AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM documents),
c AS (SELECT count(*) AS n, avg(len(t)) AS avg_dl FROM d), p AS (SELECT id, len(t) AS dl, unnest(t) AS term FROM d),
tf AS (SELECT id, dl, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM a) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
s AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_dl))), 6) AS score FROM tf JOIN df USING (term) JOIN a USING (term), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM s) SELECT query_id, id, score, rank FROM r WHERE rank <= 10""")
def _(spark, d):
    docs = table(spark, d, "documents")
    return retrieval.bm25(docs, docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), 10)


@query("q_cosine_search", """WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings), q AS (SELECT * FROM v WHERE id % 100 = 0),
s AS (SELECT q.id AS query_id, v.id, round(list_sum(list_transform(list_zip(v.e, q.e), lambda x: x[1] * x[2])) / (sqrt(list_sum(list_transform(v.e, lambda x: x * x))) * sqrt(list_sum(list_transform(q.e, lambda x: x * x)))), 6) AS score FROM v, q WHERE v.id <> q.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM s) SELECT query_id, id, score, rank FROM r WHERE rank <= 10""")
def _(spark, d):
    v = table(spark, d, "embeddings")
    return retrieval.nearest(v, v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), 10)


@query("q_quantized_vectors", "WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) AS m FROM embeddings) SELECT vec_id, list_transform(e, lambda x: round(x / m * 127)::TINYINT) AS q FROM v")
def _(spark, d):
    return table(spark, d, "embeddings").select("vec_id", retrieval.quantized(F.col("embedding").cast("array<double>")).alias("q"))


@query("q_token_slices", f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}+'), lambda x: x <> '') AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(0, (len(w) + 255) // 256)) AS k FROM w WHERE len(w) > 0)
SELECT doc_id, k::INT AS slice, array_to_string(w[k * 256 + 1 : k * 256 + 256], ' ') AS text FROM s""")
def _(spark, d):
    return retrieval.token_slices(table(spark, d, "documents"), "doc_id", "text")


@query("q_top_sentences", rf"""WITH s AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])[ \t\n\r\f\x0b]+', '\1' || chr(10), 'g'), '\n+'), lambda x: {_strip("x")} <> '') AS l FROM documents),
e AS (SELECT id, unnest(range(len(l)))::INT AS place, unnest(l) AS sentence FROM s), t AS (SELECT id, place, unnest(list_filter(regexp_split_to_array(lower(sentence), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM e),
tf AS (SELECT id, term, count(*) AS tf FROM t GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), w AS (SELECT id, term, tf * ln(1 + (SELECT count(*) FROM documents)::DOUBLE / df) AS w FROM tf JOIN df USING (term)),
c AS (SELECT id, place, round(avg(w), 6) AS score FROM t JOIN w USING (id, term) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, place) AS k FROM c)
SELECT id, place, sentence, score FROM r JOIN e USING (id, place) WHERE k <= 5""")
def _(spark, d):
    return retrieval.top_sentences(table(spark, d, "documents"))


@query("q_route", """WITH q AS (SELECT c_custkey AS query_id FROM customer), c AS (SELECT o_custkey AS query_id, max(o_orderkey)::VARCHAR AS answer FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
s AS (SELECT o_custkey AS query_id, max(o_orderpriority) AS answer, max(o_totalprice) AS score FROM orders GROUP BY 1), n AS (SELECT o_custkey AS query_id, min(o_orderpriority) AS answer FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
w AS (SELECT query_id, c.answer AS c, s.answer AS s, n.answer AS n, CASE WHEN c.answer IS NOT NULL THEN 'cache' WHEN score >= 400000 THEN 'sparse' WHEN n.answer IS NOT NULL THEN 'dense' ELSE 'online' END AS way FROM q LEFT JOIN c USING (query_id) LEFT JOIN s USING (query_id) LEFT JOIN n USING (query_id))
SELECT query_id, way, CASE way WHEN 'cache' THEN c WHEN 'sparse' THEN s WHEN 'dense' THEN n END AS answer FROM w""")
def _(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "query_id")
    cache = orders.where("o_orderstatus = 'P'").groupBy("query_id").agg(F.max("o_orderkey").cast("string").alias("answer"))
    sparse = orders.groupBy("query_id").agg(F.max("o_orderpriority").alias("answer"), F.max("o_totalprice").alias("score"))
    dense = orders.where("o_orderkey % 2 = 0").groupBy("query_id").agg(F.min("o_orderpriority").alias("answer"))
    return retrieval.route(table(spark, d, "customer").select(F.col("c_custkey").alias("query_id")), cache, sparse, dense, 400_000.0)


@query("q_brief", """WITH e AS (SELECT o_custkey AS query_id, o_orderstatus AS source, o_orderkey::VARCHAR AS sentence, o_totalprice AS score FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, source, sentence) AS k FROM e)
SELECT query_id, string_agg('[' || k || '] ' || sentence || ' (' || source || ')', chr(10) ORDER BY k) AS brief, round(avg(score), 6) AS confidence FROM r WHERE k <= 5 GROUP BY query_id""")
def _(spark, d):
    return retrieval.brief(table(spark, d, "orders").select(F.col("o_custkey").alias("query_id"), F.col("o_orderstatus").alias("source"), F.col("o_orderkey").cast("string").alias("sentence"), F.col("o_totalprice").alias("score")))


@query("q_grounded", r"""WITH c AS (SELECT msg_id AS claim_id, example_id AS query_id, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(content, '')), '[^a-z0-9]+'), lambda x: x <> '')) AS t FROM train WHERE lower(role) IN ('gpt', 'assistant')),
e AS (SELECT example_id AS query_id, list_filter(regexp_split_to_array(lower(coalesce(content, '')), '[^a-z0-9]+'), lambda x: x <> '') AS e FROM train WHERE lower(role) IN ('human', 'user')),
b AS (SELECT claim_id, round(max(len(list_intersect(t, e))::DOUBLE / greatest(len(t), 1)), 6) AS support FROM c JOIN e USING (query_id) GROUP BY 1)
SELECT claim_id, coalesce(support, 0)::DOUBLE AS support, coalesce(support, 0) >= 0.5 AS grounded FROM c LEFT JOIN b USING (claim_id)""")
def _(spark, d):
    t, role = table(spark, d, "train"), F.lower("role")
    claims = t.where(role.isin(*records.MODEL)).select(F.col("msg_id").alias("claim_id"), F.col("example_id").alias("query_id"), F.col("content").alias("claim"))
    return retrieval.grounded(claims, t.where(role.isin(*records.HUMAN)).select(F.col("example_id").alias("query_id"), F.col("content").alias("sentence")))


@query("q_answer_document", """SELECT o_orderkey, '{"query_id":"' || o_custkey || '","answer":"' || o_orderpriority || '","sources":["' || o_orderstatus || '"],"confidence":' || o_orderkey % 100 || '}' AS answer FROM orders""")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", retrieval.answer_document(F.col("o_custkey").cast("string"), F.col("o_orderpriority"), F.array("o_orderstatus"), F.pmod("o_orderkey", F.lit(100))).alias("answer"))


#: Plans out of lineitem: an order is a plan, a line a node that depends on the line before; some nodes are misnamed or doubled.
_NODES_SQL = """p AS (SELECT l_orderkey AS query_id, CASE WHEN l_partkey % 97 = 0 THEN 'X1' ELSE 'N' || lpad((l_linenumber + l_partkey % 2)::VARCHAR, 2, '0') END AS id, ['N' || lpad(l_linenumber::VARCHAR, 2, '0')] AS dependencies FROM lineitem)"""


@query("q_dag_invalid", f"""WITH {_NODES_SQL}, e AS (SELECT query_id, id, unnest(list_distinct(dependencies)) AS dep FROM p), i AS (SELECT DISTINCT query_id, id FROM p)
SELECT query_id, id, 'bad_id' AS error FROM p WHERE NOT regexp_matches(id, '^N[0-9][0-9]$') UNION ALL SELECT query_id, id, 'duplicate_id' FROM p GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT query_id, id, 'self_dependency' FROM e WHERE dep = id UNION ALL SELECT query_id, id, 'missing_dependency' FROM e WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.query_id = e.query_id AND i.id = e.dep)
UNION ALL SELECT DISTINCT query_id, id, 'forward_dependency' FROM e WHERE dep > id AND EXISTS (SELECT 1 FROM i WHERE i.query_id = e.query_id AND i.id = e.dep)
UNION ALL SELECT query_id, NULL, 'too_many_nodes' FROM p GROUP BY query_id HAVING count(*) > 24""")
def _(spark, d):
    line = lambda c: F.concat(F.lit("N"), F.lpad(c.cast("string"), 2, "0"))
    n = F.col("l_linenumber")
    node = F.when(F.pmod("l_partkey", F.lit(97)) == 0, "X1").otherwise(line(n + F.pmod("l_partkey", F.lit(2))))
    return dag.plan_errors(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("query_id"), node.alias("id"), F.array(line(n)).alias("dependencies")))


@query("q_ready_nodes", """WITH n AS (SELECT l_orderkey AS query_id, 'N' || lpad(l_linenumber::VARCHAR, 2, '0') AS id, l_linenumber AS k, CASE max(l_returnflag) WHEN 'R' THEN 'DONE' WHEN 'A' THEN 'RUNNING' ELSE NULL END AS status FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT a.query_id, a.id FROM n a LEFT JOIN n b ON b.query_id = a.query_id AND b.k = a.k - 1 WHERE a.status IS NULL AND (a.k = 1 OR b.status = 'DONE')""")
def _(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").alias("k")).agg(F.max("l_returnflag").alias("l_returnflag"))
    line = lambda c: F.concat(F.lit("N"), F.lpad(c.cast("string"), 2, "0"))
    nodes = lines.select("query_id", line(F.col("k")).alias("id"), F.when(F.col("k") > 1, F.array(line(F.col("k") - 1))).otherwise(F.array().cast("array<string>")).alias("dependencies"))
    state = lines.where("l_returnflag <> 'N'").select("query_id", line(F.col("k")).alias("node_id"), F.when(F.col("l_returnflag") == "R", "DONE").otherwise("RUNNING").alias("status"))
    return dag.ready_nodes(nodes, state)


@query("q_explosions", """WITH s AS (SELECT o_custkey AS query_id, o_orderkey % 5 AS depth, o_orderkey % 3 AS children FROM orders), g AS (SELECT query_id, (count(*) + sum(children))::BIGINT AS nodes, max(depth) AS depth, max(children) AS children, count(*) FILTER (children > 0) AS splits FROM s GROUP BY 1)
SELECT *, 'PLAN_EXPLOSION' AS verdict FROM g WHERE nodes > 24 OR depth > 3 OR children > 2 OR splits > 5""")
def _(spark, d):
    return dag.explosions(table(spark, d, "orders").select(F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("node_id"), F.pmod("o_orderkey", F.lit(5)).alias("depth"), F.pmod("o_orderkey", F.lit(3)).alias("children")))


_STATE_EVENTS = "['node.ready', 'node.attempt.start', 'sandbox.start', 'sandbox.timeout', 'node.test.failed', 'node.failed', 'node.done', 'no.such.event'][event_id % 8 + 1]"


def _node_events(spark, d):
    kinds = F.array(*map(F.lit, ("node.ready", "node.attempt.start", "sandbox.start", "sandbox.timeout", "node.test.failed", "node.failed", "node.done", "no.such.event")))
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("query_id"), F.col("event_type").alias("node_id"), F.element_at(kinds, (F.pmod("event_id", F.lit(8)) + 1).cast("int")).alias("event_type"), F.col("ts").alias("created_at"))


@query("q_node_states", f"""WITH e AS (SELECT event_id, user_id AS query_id, event_type AS node_id, {_STATE_EVENTS} AS k, ts FROM events), m AS (SELECT *, CASE k WHEN 'node.ready' THEN 'READY' WHEN 'node.attempt.start' THEN 'RUNNING' WHEN 'sandbox.timeout' THEN 'TIMEOUT' WHEN 'node.test.failed' THEN 'TEST_FAILED' WHEN 'node.failed' THEN 'FAILED' WHEN 'node.done' THEN 'DONE' END AS s FROM e)
SELECT query_id, node_id, coalesce(arg_max(s, (ts, event_id)) FILTER (s IS NOT NULL), 'PENDING') AS status, count(*) FILTER (k = 'node.attempt.start') AS attempt FROM m GROUP BY 1, 2""")
def _(spark, d):
    return dag.node_states(_node_events(spark, d))


@query("q_unknown_events", f"SELECT {_STATE_EVENTS} AS event_type, count(*) AS n FROM events WHERE event_id % 8 = 7 GROUP BY 1")
def _(spark, d):
    return dag.unknown_events(_node_events(spark, d))


@query("q_retry_decisions", """SELECT user_id::VARCHAR AS query_id, event_type AS node_id, count(*) FILTER (value < 20) AS attempts,
 CASE WHEN count(*) FILTER (value > 95) > 0 THEN 'done' WHEN count(*) FILTER (value BETWEEN 94 AND 95) > 0 THEN 'fail' WHEN count(*) FILTER (value < 20) >= 3 THEN 'fail' ELSE 'retry' END AS decision FROM events GROUP BY 1, 2""")
def _(spark, d):
    v = F.col("value")
    ev = table(spark, d, "events").select(F.col("user_id").cast("string").alias("query_id"), F.col("event_type").alias("node_id"), F.when(v < 20, "NODE_FAILED").when(v > 95, "NODE_DONE").when(v.between(94, 95), "SANDBOX_VIOLATION").alias("event_type"))
    return dag.retry_decisions(ev)


@query("q_last_summaries", "SELECT o_custkey AS query_id, o_orderdate AS at, o_orderkey::VARCHAR AS summary FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey::VARCHAR) AS rn FROM orders) WHERE rn <= 2")
def _(spark, d):
    return dag.last_summaries(table(spark, d, "orders").select(F.col("o_custkey").alias("query_id"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").cast("string").alias("summary")))


@query("q_event_metrics", "SELECT user_id AS query_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, d):
    return dag.event_metrics(table(spark, d, "events").select(F.col("user_id").alias("query_id"), "event_type"))


_SECTIONED = "['policy', 'node', 'topology', 'brief', 'contracts', 'summaries', 'error_tail'][o_orderkey % 7 + 1]"


@query("q_compiled_context", f"""WITH s AS (SELECT o_custkey AS query_id, {_SECTIONED} AS section, o_orderkey AS age, floor(o_totalprice / 1000)::BIGINT AS tokens, [180, 350, 250, 350, 600, 650, 250][o_orderkey % 7 + 1] AS most FROM orders),
c AS (SELECT *, greatest(0, least(tokens, most - (sum(tokens) OVER (PARTITION BY query_id, section ORDER BY age ROWS UNBOUNDED PRECEDING) - tokens)))::BIGINT AS cut, CASE section WHEN 'summaries' THEN 3 WHEN 'brief' THEN 2 WHEN 'topology' THEN 1 ELSE 0 END AS rank FROM s),
u AS (SELECT *, sum(cut) OVER (PARTITION BY query_id ORDER BY rank, age, section ROWS UNBOUNDED PRECEDING) AS upto FROM c WHERE cut > 0 OR rank = 0)
SELECT query_id, section, age, tokens, cut FROM u WHERE rank = 0 OR upto <= 1500 - 442""")
def _(spark, d):
    kinds = F.array(*map(F.lit, dag.SECTIONS))
    s = table(spark, d, "orders").select(F.col("o_custkey").alias("query_id"), F.element_at(kinds, (F.pmod("o_orderkey", F.lit(7)) + 1).cast("int")).alias("section"), F.col("o_orderkey").alias("age"), F.floor(F.col("o_totalprice") / 1000).alias("tokens"))
    return dag.compiled_context(s, 1500)


@query("q_fit_context", """WITH s AS (SELECT o_custkey::VARCHAR AS query_id, o_orderkey::VARCHAR AS section, o_orderkey AS priority, floor(o_totalprice / 100)::BIGINT AS tokens FROM orders),
w AS (SELECT *, sum(tokens) OVER (PARTITION BY query_id ORDER BY priority, section ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM s) SELECT * FROM w WHERE upto <= 3072""")
def _(spark, d):
    s = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("query_id"), F.col("o_orderkey").cast("string").alias("section"), F.col("o_orderkey").alias("priority"), F.floor(F.col("o_totalprice") / 100).alias("tokens"))
    return dag.fit_context(s)
