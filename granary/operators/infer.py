"""Batch text generation: jobs in, results out, by a pluggable completion backend.

A backend is built once per Python worker process, which runs many tasks, and completes batches. Prompts are shortened
to the spec's context, or to the backend's own ``context`` if it has one (None: no limit, prompts stay whole). Failed requests are tried again up to
``attempts`` times and then give a null text. Results are keyed by ``_idx``; finished ones are skipped
by an anti-join, so a run resumes where the last one ended.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions import text as X
from granary.operators.backends import EchoBackend
from granary.operators.dedup import first_wins, pending, without_known
from granary.operators.mix import combinations
from granary.operators.quality import instruction_defect
from granary.session import discard, exists, materialize, remove, write_text

# How much of a prompt fits, how often a run goes on asking, and (in WorkerSpec) a worker's fields and defaults.
MOST_ROUNDS = 60
CHARS_PER_TOKEN_LIMIT, CONTEXT_SLACK = 6, 16
PROMPT_CODE_CHARS = 2000
MIN_GENERATED = 10
RESULT = "_idx BIGINT, max_tokens INT, temperature DOUBLE, top_p DOUBLE, _worker STRING, _text STRING, _len BIGINT"


@dataclass
class WorkerSpec:
    """One worker of a plan."""

    # The fields and their defaults.
    kind: str
    name: str
    n_threads: int = 0
    n_parallel: int = 1
    ctx_per_seq: int = 1536
    max_tokens: int = 128
    temperature: float = 0.7
    top_p: float = 0.95
    stop: list[str] = field(default_factory=lambda: ["\n\n"])
    attempts: int = 3
    seed: int = 0

    def as_dict(self) -> dict:
        return asdict(self)


def fit_prompt(prompt: str, context: int, max_tokens: int, tokens: Callable[[str], list[str]] | None = None) -> str:
    """The part of a prompt that leaves room for the answer: its last characters, then its last ``tokens``."""
    budget = max(1, context - max_tokens - CONTEXT_SLACK)
    end = prompt[-CHARS_PER_TOKEN_LIMIT * budget :]
    return end if tokens is None else "".join(tokens(end)[-budget:])


def cut_at_stop(text: str, stop: Iterable[str]) -> str:
    """``text`` before the first stop string, stripped."""
    ends = [i for s in stop if s and (i := text.find(s)) >= 0]
    return text[: min(ends)].strip() if ends else text.strip()


def complete_with_retries(backend, requests: list[dict], attempts: int, n_parallel: int) -> list[str | None]:
    """Texts in order of ``requests``: waves of ``n_parallel``; failed ones go again to the end of the queue."""
    texts: list[str | None] = [None] * len(requests)
    queue = [(i, attempts) for i in range(len(requests))]
    while queue:
        wave, queue = queue[:n_parallel], queue[n_parallel:]
        try:
            got = backend.complete([requests[i] for i, _ in wave])
        except Exception:  # a failing wave counts as failed requests
            got = [None] * len(wave)
        for (i, left), t in zip(wave, [*got, *[None] * (len(wave) - len(got))]):
            if t is not None:
                texts[i] = t
            elif left > 1:
                queue.append((i, left - 1))
    return texts


def requests(jobs: DataFrame, spec: WorkerSpec) -> DataFrame:
    """What is asked for each job (_idx, prompt, max_tokens, temperature, top_p, stop): its own settings, else the spec's.

    ``top_p`` and ``stop`` stay as the job has them, null included, because results repeat them; the spec's hold when asking.
    """
    return jobs.select("_idx", "prompt", F.coalesce("max_tokens", F.lit(spec.max_tokens)).alias("max_tokens"), F.coalesce("temperature", F.lit(spec.temperature)).alias("temperature"), "top_p", "stop")


def run_completions(jobs: DataFrame, backend: Callable[[], object] = EchoBackend, spec: WorkerSpec | None = None, done: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Results (``RESULT``) of the jobs that ``done`` lacks.

    Requests' own settings hold where given, the spec's elsewhere. Null prompts count as ''. A request's seed is its
    ``_idx`` plus the spec's seed. More ``partitions`` than workers let the scheduler balance the load.
    """
    spec = spec or WorkerSpec("cpu", "cpu0")
    packed = cloudpickle.dumps(backend)
    key = hashlib.sha256(packed).hexdigest()
    todo = requests(pending(jobs, done) if done is not None else jobs, spec)
    if partitions:
        todo = todo.repartition(partitions, "_idx")

    def run(batches):
        worker = _built(key, packed)
        name = getattr(worker, "name", spec.name)
        context, tokens = getattr(worker, "context", spec.ctx_per_seq), getattr(worker, "tokens", None)
        for batch in batches:
            asked = batch.to_pylist()
            for r in asked:
                r["prompt"] = r["prompt"] or ""
                if context is not None:
                    r["prompt"] = fit_prompt(r["prompt"], context, r["max_tokens"], tokens)
                r["stop"] = r["stop"] or spec.stop
                r["seed"] = spec.seed + (r["_idx"] or 0)
                r["top_p"] = spec.top_p if r["top_p"] is None else r["top_p"]
            texts = complete_with_retries(worker, asked, spec.attempts, max(1, spec.n_parallel))
            texts = [t if t is None else cut_at_stop(t, r["stop"]) for t, r in zip(texts, asked)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array([name] * len(texts), pa.string()), pa.array(texts, pa.string()), pa.array([len(t or "") for t in texts], pa.int64())],
                names=["_idx", "max_tokens", "temperature", "top_p", "_worker", "_text", "_len"],
            )

    return todo.mapInArrow(run, RESULT)


_workers: dict[str, object] = {}


def _built(key: str, packed: bytes):
    """The backend of this process, built when it is first asked for."""
    if key not in _workers:
        _workers[key] = cloudpickle.loads(packed)()
    return _workers[key]


def best_results(results: DataFrame, order: str, total: int | None = None, least: int = 0) -> DataFrame:
    """The first result of each job in ``order`` (unique); lost workers' and those of no job (below ``least``, from ``total`` on) are left out."""
    index = F.col("_idx")
    valid = results.where((index >= least) & ~F.col("_worker").eqNullSafe("lost"))
    return first_wins(valid if total is None else valid.where(index < total), ["_idx"], order)


def merged_results(partial: DataFrame, final: DataFrame, total: int) -> DataFrame:
    """One result for each job of 0 to ``total``: those of an interrupted run's log and of its output, in the order of ``_idx``.

    The output's goes before the log's; of several within one, a text goes before none, then the least worker and text.
    """
    both = final.withColumn("_from", F.lit(0)).unionByName(partial.withColumn("_from", F.lit(1)))
    rank = F.struct("_from", F.col("_text").isNull().alias("no"), "_worker", "_text", *(c for c in final.columns if c not in ("_idx", "_worker", "_text")))
    valid = both.where((F.col("_idx") >= 0) & (F.col("_idx") < total) & ~F.col("_worker").eqNullSafe("lost"))
    first = valid.groupBy("_idx").agg(F.min(rank).alias("r"))
    return first.select(*(F.col("_idx") if c == "_idx" else F.col(f"r.{c}") for c in final.columns)).orderBy("_idx")


def run_to_folder(spark: SparkSession, jobs: DataFrame, folder: str, backend: Callable[[], object] = EchoBackend, spec: WorkerSpec | None = None, partitions: int | None = None, plan: list[WorkerSpec] | None = None) -> dict:
    """Complete ``jobs`` (``_idx`` from 0 on) into ``folder``: results in order of ``_idx``, and plan.json with the run's figures.

    New results go to a log (``partial``) first. A run that was interrupted goes on from its log and its output: only jobs
    that neither has are completed. ``plan``: the workers to report, where there is more than ``spec``. Returns the figures.
    """
    spec = spec or WorkerSpec("cpu", "cpu0")
    log, out = f"{folder}/partial", f"{folder}/results"
    old = lambda p: spark.read.schema(RESULT).parquet(p) if exists(spark, p) else spark.createDataFrame([], RESULT)
    total = int(jobs.agg(F.coalesce(F.max("_idx") + 1, F.lit(0))).first()[0])
    before = merged_results(old(log), old(out), total)
    known = before.count()
    began = time.time()
    run_completions(jobs, backend, spec, done=before, partitions=partitions).write.mode("append").parquet(log)
    whole = materialize(merged_results(old(log), old(out), total), "results")
    whole.orderBy("_idx").write.mode("overwrite").parquet(out)
    stats = run_stats(jobs, whole, round(time.time() - began, 3), known).first().asDict()
    stats |= {"workers": {r["_worker"]: r["n"] for r in whole.groupBy("_worker").agg(F.count("*").alias("n")).collect()}, "plan": [w.as_dict() for w in plan or [spec]]}
    remove(spark, log)
    discard(whole)
    write_text(spark, f"{folder}/plan.json", json.dumps(stats, indent=2, default=str))
    return stats


def join_results(items: DataFrame, results: DataFrame) -> DataFrame:
    """Every item with its result's text (null where it has none)."""
    return items.join(results.select("_idx", "_text", "_worker"), "_idx", "left")


def positional_zip(left: DataFrame, right: DataFrame, order_left: str, order_right: str, value: str) -> DataFrame:
    """Rows of ``left`` with ``value`` of the row of ``right`` at the same position; null where right is shorter.

    Positions come from a distributed sort: numbers within each range of the order, plus the sizes of
    the ranges before it, so no task holds all rows.
    """
    return numbered(left, order_left).join(numbered(right, order_right).select("pos", value), "pos", "left")


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``pos``, their rank (from 0) by ``order``.

    The sorted rows are written once, so that both the sizes and the numbers see the same ranges.
    """
    sorted_ = materialize(rows.orderBy(order).withColumn("_p", F.monotonically_increasing_id()), "sorted")
    split = sorted_.withColumn("_part", F.shiftright("_p", 33)).withColumn("_row", F.col("_p") - F.shiftleft(F.col("_part"), 33))
    sizes = split.groupBy("_part").agg(F.count("*").alias("_n"))
    ahead = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return split.join(F.broadcast(ahead), "_part").withColumn("pos", F.col("_before") + F.col("_row")).drop("_p", "_part", "_row", "_before")


def instruction_prompt(language: Column, code: Column) -> Column:
    """A prompt that asks for the task a piece of code answers; the code is cut to ``PROMPT_CODE_CHARS``."""
    return F.format_string("Read this %s code and state in one sentence the task it solves.\n\n%s\n\nTask:", language, F.substring(code, 1, PROMPT_CODE_CHARS))


def bad_code_prompt(language: Column, hint: Column) -> Column:
    return F.format_string("Write a short %s function that breaks this rule: %s. Code only.", language, hint)


def good_code_prompt(language: Column, hint: Column, bad: Column) -> Column:
    """A prompt that asks for better code; it has the whole code, and the request last, where :func:`fit_prompt` keeps it."""
    return F.format_string("Here is %s code:\n\n%s\n\nRewrite it so that it keeps the rule: %s. Code only.", language, bad, hint)


def generated_code(text: Column) -> Column:
    """Code of a completion without its fences; null if it is too short to use."""
    code = X.strip_fences(X.text_or_empty(text))
    return F.when(F.char_length(code) >= MIN_GENERATED, code)


def usable_instructions(items: DataFrame, results: DataFrame) -> DataFrame:
    """Items (with ``code``) joined with their results: ``defect`` of the text, 'missing' where there is none."""
    joined = join_results(items, results)
    return joined.withColumn("defect", F.when(F.col("_text").isNull(), "missing").otherwise(instruction_defect(F.col("_text"), F.col("code"))))


def run_stats(jobs: DataFrame, results: DataFrame, elapsed_s: float, resumed: int = 0) -> DataFrame:
    """One row: jobs, ok (a text that isn't empty), failed, resumed, ok_pct, jobs_per_s."""
    first = results.where(F.col("_idx").isNotNull()).groupBy("_idx").agg(F.max(F.coalesce(F.char_length("_text"), F.lit(0)) > 0).alias("ok"))
    joined = jobs.select("_idx").join(first, "_idx", "left").agg(F.count("*").alias("jobs"), F.count_if(F.coalesce("ok", F.lit(False))).alias("ok"))
    return joined.select("jobs", "ok", (F.col("jobs") - F.col("ok")).alias("failed"), F.lit(resumed).cast("bigint").alias("resumed"), F.lit(float(elapsed_s)).alias("elapsed_s"), F.bround(F.when(F.col("jobs") > 0, F.col("ok") / F.col("jobs") * 100).otherwise(0.0), 1).alias("ok_pct"), F.when(F.lit(elapsed_s) > 0, F.bround(F.col("jobs") / F.lit(float(elapsed_s)), 3)).otherwise(0.0).alias("jobs_per_s"))


def worker_rates(results: DataFrame, time_col: str = "recorded_at") -> DataFrame:
    """By worker: jobs, chars, seconds from its first to its last result, and rates over these (null for 0 s)."""
    span = F.max(F.unix_micros(F.col(time_col).cast("timestamp"))) - F.min(F.unix_micros(F.col(time_col).cast("timestamp")))
    by = results.groupBy("_worker").agg(F.count("*").alias("jobs"), F.coalesce(F.sum("_len"), F.lit(0)).alias("chars"), (span / 1e6).alias("seconds"))
    return by.withColumn("jobs_per_s", F.when(F.col("seconds") > 0, F.col("jobs") / F.col("seconds"))).withColumn("chars_per_s", F.when(F.col("seconds") > 0, F.col("chars") / F.col("seconds")))


def with_hints(rows: DataFrame, hints: dict[str, str], principle: str = "principle") -> DataFrame:
    """``rows`` with the ``hint`` of their principle; a principle without one is its own hint. No join: hints are few."""
    known = F.create_map(*[F.lit(x) for kv in hints.items() for x in kv]) if hints else F.lit(None).cast("map<string,string>")
    return rows.withColumn("hint", F.coalesce(F.try_element_at(known, F.col(principle)), F.col(principle)))


def not_language(rows: DataFrame, language: str, column: str = "language") -> DataFrame:
    """Rows of another language; a missing one is another."""
    return rows.where(~F.col(column).eqNullSafe(language))


def expand_alignment(combos: DataFrame, hints: dict[str, str], backend=EchoBackend, spec: WorkerSpec | None = None, target: int | None = None, seed: int = 42) -> DataFrame:
    """Refactoring pairs in two passes: bad code for each combination, then better code for each usable one.

    ``combos``: pos, principle, language. A principle without a hint is its own hint. Equal outputs are
    kept once (least pos); ``target`` limits the result in shuffled order.
    """
    rows = with_hints(combos, hints)
    settings = (F.lit(None).cast("int").alias("max_tokens"), F.lit(None).cast("double").alias("temperature"), F.lit(None).cast("double").alias("top_p"), F.lit(None).cast("array<string>").alias("stop"))
    ask = lambda d, prompt: run_completions(d.select(F.col("pos").alias("_idx"), prompt.alias("prompt"), *settings), backend, spec)
    bad = rows.join(ask(rows, bad_code_prompt(F.col("language"), F.col("hint"))).select(F.col("_idx").alias("pos"), generated_code(F.col("_text")).alias("bad")), "pos").where("bad IS NOT NULL")
    good = bad.join(ask(bad, good_code_prompt(F.col("language"), F.col("hint"), F.col("bad"))).select(F.col("_idx").alias("pos"), generated_code(F.col("_text")).alias("good")), "pos").where("good IS NOT NULL")
    unique = first_wins(good.withColumn("_d", X.digest(F.col("good"))), ["_d"], "pos").drop("_d", "hint")
    return unique if target is None else unique.orderBy(X.hash_order(seed, F.col("pos")), "pos").limit(target)


def expand_in_rounds(spark: SparkSession, principles: list[str], languages: list[str], hints: dict[str, str], target: int, backend=EchoBackend, spec: WorkerSpec | None = None, rounds: int = MOST_ROUNDS, known: DataFrame | None = None) -> DataFrame:
    """Refactoring pairs (pos, principle, language, bad, good), asked for in rounds until there are ``target`` of them.

    Each round asks once for every principle with every language; positions, and so the requests' seeds, go on from the
    last round. Outputs that an earlier round or ``known`` (column good) has are dropped. It ends early after a round that
    adds nothing, and after ``rounds``. The first ``target`` by position are given.
    """
    every = max(1, len(principles) * len(languages))
    found = None
    for k in range(rounds):
        combos = combinations(spark, principles, languages, 1).withColumn("pos", F.col("pos") + k * every)
        made = expand_alignment(combos, hints, backend, spec)
        for seen in (known, found):
            if seen is not None:
                made = without_known(made, seen, "good")
        before = found.count() if found is not None else 0
        now = materialize(made if found is None else found.unionByName(made), "rounds")
        if found is not None:
            discard(found)
        found = now
        n = found.count()
        if n >= target or n == before:
            break
    return found.orderBy("pos").limit(target)


def expand_from_code(code: DataFrame, known: DataFrame, principles: dict[str, str], backend=EchoBackend, spec: WorkerSpec | None = None, most: int = 4000, seed: int = 42) -> DataFrame:
    """Alignment records from code records (pos, language, instruction, output): a principle each, its fix by completion.

    CSS is left out (a missing language isn't); at most ``most`` rows in shuffled order take part (the
    operator's budget of completions). Fixes that are too short, repeat an earlier one (least pos) or stand in
    ``known`` (output) are dropped. Input is the code, token_count that of code and output together.
    """
    chosen = not_language(code, "css").orderBy(X.hash_order(seed, F.col("pos")), "pos").limit(most).withColumn("principle", X.hash_pick(list(principles), seed, F.col("pos")))
    rows = with_hints(chosen, principles)
    jobs = rows.select(F.col("pos").alias("_idx"), good_code_prompt(F.coalesce("language", F.lit("unknown")), F.col("hint"), F.col("output")).alias("prompt"), F.lit(None).cast("int").alias("max_tokens"), F.lit(None).cast("double").alias("temperature"), F.lit(None).cast("double").alias("top_p"), F.lit(None).cast("array<string>").alias("stop"))
    fixed = rows.join(run_completions(jobs, backend, spec).select(F.col("_idx").alias("pos"), generated_code(F.col("_text")).alias("fix")), "pos").where("fix IS NOT NULL")
    out = fixed.select("pos", "language", "principle", F.col("output").alias("input"), F.concat(F.format_string("Refactor this %s code to follow %s.", F.coalesce("language", F.lit("unknown")), F.col("principle"))).alias("instruction"), F.concat(F.lit("<thought>"), F.col("hint"), F.lit("</thought>\n\n"), F.col("fix")).alias("output"))
    new = without_known(first_wins(out.withColumn("_e", X.digest(F.col("output"))), ["_e"], "pos").drop("_e"), known, "output")
    return new.withColumn("token_count", X.token_estimate(F.col("input")) + X.token_estimate(F.col("output")))


def progress(jobs: int, results: DataFrame, width: str = "20 seconds", time_col: str = "recorded_at") -> DataFrame:
    """Per window of ``width`` with results: results so far, percent of ``jobs``, rate per second since the first window, time left."""
    by = results.groupBy(F.window(F.col(time_col).cast("timestamp"), width).alias("w")).agg(F.count("*").alias("n"))
    order = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)  # over one row a window
    done = by.select(F.unix_micros("w.end").alias("at"), F.unix_micros("w.start").alias("from"), "n").select("at", F.sum("n").over(order).alias("done"), ((F.col("at") - F.min("from").over(order)) / 1e6).alias("seconds"))
    rate = F.col("done") / F.col("seconds")
    return done.select(F.timestamp_micros("at").alias("window_end"), "done", F.bround(F.least(F.col("done") / max(1, jobs) * 100, F.lit(100.0)), 1).alias("pct"), F.bround(rate, 6).alias("per_s"), X.duration(F.greatest(jobs - F.col("done"), F.lit(0)) / rate).alias("eta"))


def best_plan(rates: DataFrame) -> DataFrame:
    """The plan (plan, ord, rate) of highest rate, of equal ones the first by ``ord``; rates of 0 and null never win."""
    return rates.where("rate > 0").agg(F.max_by("plan", F.struct("rate", -F.col("ord"))).alias("plan"), F.max("rate").alias("rate"))
