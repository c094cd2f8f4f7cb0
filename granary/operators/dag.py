"""Plans as graphs of nodes: validation, ready nodes, retries, limits, context budgets, load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Limits of a plan, of its splits, of a context, and the vocabulary of states.
NODE_ID_RE = r"^N[0-9]{2}$"
MAX_NODES, MAX_SPLIT_DEPTH, MAX_CHILDREN, MAX_SPLITS = 24, 3, 2, 5
MAX_ATTEMPTS = 3
CONTEXT_TOKENS = 3072
STATES = ("PENDING", "READY", "RUNNING", "TEST_FAILED", "CODE_FAILED", "SANDBOX_VIOLATION", "TIMEOUT", "FAILED", "DONE")
#: Sections of a context with their tokens, the rest of ``CONTEXT_TOKENS`` (442) being left for the answer.
SECTIONS = {"policy": 180, "node": 350, "topology": 250, "brief": 350, "contracts": 600, "summaries": 650, "error_tail": 250}
#: Sections that always stay, and the order in which the others are given up.
KEPT_SECTIONS, EVICTED = ("policy", "node", "contracts", "error_tail"), ("summaries", "brief", "topology")
#: The events and the metrics that a run may report.
EVENT_TYPES = (
    "query.received", "policy.accepted", "policy.rejected", "planner.load.start", "planner.load.end", "plan.generated", "plan.schema.invalid", "plan.accepted", "node.ready", "node.attempt.start", "sandbox.start",
    "sandbox.exit", "sandbox.timeout", "sandbox.violation", "node.test.failed", "node.done", "node.failed", "model.unload.start", "model.unload.end", "resource.threshold.crossed", "node.split", "knowledge.brief.updated",
)
METRICS = ("model_load_time_ms", "model_unload_time_ms", "tokens_in", "tokens_out", "tokens_per_second", "prompt_build_time_ms", "sandbox_runtime_ms", "node_attempt_count", "node_failure_count", "schema_invalid_count", "context_truncation_count", "ram_available_mb", "cpu_percent", "kv_cache_estimate_mb", "hot_swap_count")
#: What each event makes of its node's state.
TRANSITIONS = {"node.ready": "READY", "node.attempt.start": "RUNNING", "node.test.failed": "TEST_FAILED", "sandbox.timeout": "TIMEOUT", "sandbox.violation": "SANDBOX_VIOLATION", "node.failed": "FAILED", "node.done": "DONE"}
PLANS = T.StructType([T.StructField(k, T.StringType()) for k in ("query_id", "objective", "plan_json", "created_at")])
NODE_STATE = T.StructType([*(T.StructField(k, T.StringType()) for k in ("query_id", "node_id", "status")), T.StructField("attempt", T.IntegerType()), T.StructField("started_at", T.StringType()), T.StructField("ended_at", T.StringType()), T.StructField("exit_code", T.IntegerType()), *(T.StructField(k, T.StringType()) for k in ("stdout_path", "stderr_path", "error_summary"))])
ARTIFACTS = T.StructType([*(T.StructField(k, T.StringType()) for k in ("artifact_id", "query_id", "node_id", "type", "path", "sha256")), T.StructField("token_estimate", T.IntegerType()), T.StructField("created_at", T.StringType())])
EVENTS = T.StructType([T.StructField("event_id", T.LongType()), *(T.StructField(k, T.StringType()) for k in ("query_id", "node_id", "event_type", "payload_json", "created_at"))])


def plan_errors(nodes: DataFrame) -> DataFrame:
    """Errors of plans (query_id, id, dependencies): query_id, id, error.

    bad_id, duplicate_id, self_dependency, missing_dependency, forward_dependency (on a later id; without
    these no cycle is possible), too_many_nodes (id null).
    """
    deps = nodes.select("query_id", "id", F.explode(F.array_distinct("dependencies")).alias("dep"))
    ids = nodes.select("query_id", F.col("id").alias("dep"), F.lit(True).alias("_has")).distinct()
    named = lambda d, name: d.select("query_id", "id", F.lit(name).alias("error"))
    counts = nodes.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") > MAX_NODES)
    return (
        named(nodes.where(~F.coalesce(F.col("id").rlike(NODE_ID_RE), F.lit(False))), "bad_id")
        .union(named(nodes.groupBy("query_id", "id").agg(F.count("*").alias("n")).where("n > 1"), "duplicate_id"))
        .union(named(deps.where("dep = id"), "self_dependency"))
        .union(named(deps.join(ids, ["query_id", "dep"], "left_anti"), "missing_dependency"))
        .union(named(deps.join(ids, ["query_id", "dep"], "left_semi").where("dep > id"), "forward_dependency").distinct())
        .union(counts.select("query_id", F.lit(None).cast("string"), F.lit("too_many_nodes")))
    )


def ready_nodes(nodes: DataFrame, state: DataFrame) -> DataFrame:
    """Pending nodes whose dependencies are all done: query_id, id."""
    s = state.select("query_id", F.col("node_id").alias("id"), "status")
    deps = nodes.select("query_id", "id", F.explode("dependencies").alias("dep"))
    done = s.where("status = 'DONE'").select("query_id", F.col("id").alias("dep"))
    blocked = deps.join(done, ["query_id", "dep"], "left_anti").select("query_id", "id").distinct()
    pending = nodes.select("query_id", "id").join(s, ["query_id", "id"], "left").where("status IS NULL OR status = 'PENDING'").select("query_id", "id")
    return pending.join(blocked, ["query_id", "id"], "left_anti")


def retry_decisions(events: DataFrame) -> DataFrame:
    """What follows for each node with failed attempts: fail (a sandbox violation, or attempts used up) or retry."""
    f = events.groupBy("query_id", "node_id").agg(F.count_if(F.col("event_type") == "NODE_FAILED").alias("attempts"), F.count_if(F.col("event_type") == "SANDBOX_VIOLATION").alias("violations"), F.count_if(F.col("event_type") == "NODE_DONE").alias("done"))
    decision = F.when(F.col("done") > 0, "done").when(F.col("violations") > 0, "fail").when(F.col("attempts") >= MAX_ATTEMPTS, "fail").otherwise("retry")
    return f.select("query_id", "node_id", "attempts", decision.alias("decision"))


def explosions(splits: DataFrame) -> DataFrame:
    """Plans beyond a limit (query_id, node_id, depth, children): 'PLAN_EXPLOSION' with nodes, depth, children, splits."""
    by = splits.groupBy("query_id").agg((F.count("*") + F.sum("children")).alias("nodes"), F.max("depth").alias("depth"), F.max("children").alias("children"), F.count_if(F.col("children") > 0).alias("splits"))
    over = (F.col("nodes") > MAX_NODES) | (F.col("depth") > MAX_SPLIT_DEPTH) | (F.col("children") > MAX_CHILDREN) | (F.col("splits") > MAX_SPLITS)
    return by.where(over).withColumn("verdict", F.lit("PLAN_EXPLOSION"))


def fit_context(sections: DataFrame, budget: int = CONTEXT_TOKENS) -> DataFrame:
    """Sections (query_id, section, priority, tokens) that fit: in order of priority while the running sum is within ``budget``."""
    w = Window.partitionBy("query_id").orderBy("priority", "section").rowsBetween(Window.unboundedPreceding, 0)
    return sections.withColumn("upto", F.sum("tokens").over(w)).where(F.col("upto") <= budget)


def last_summaries(summaries: DataFrame, keep: int = 2) -> DataFrame:
    """The newest ``keep`` summaries of each query (query_id, at, summary)."""
    w = Window.partitionBy("query_id").orderBy(F.desc("at"), "summary")
    return summaries.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= keep).drop("_k")


def pressure_spans(samples: DataFrame, cpu: float = 80.0, seconds: float = 5.0, ram_mb: int = 800) -> DataFrame:
    """Spans of high load in samples (t, cpu_pct, ram_avail_mb) of one machine's log: start_s, end_s, kind.

    CPU above ``cpu`` for more than ``seconds`` on end, or memory below ``ram_mb``.
    """
    order = Window.partitionBy("host").orderBy("t")
    rows = samples if "host" in samples.columns else samples.withColumn("host", F.lit("local"))

    def spans(flag, kind):
        f = rows.withColumn("_f", F.coalesce(flag, F.lit(False)))
        island = f.withColumn("_i", F.sum(F.when(F.col("_f"), 0).otherwise(1)).over(order))
        return island.where("_f").groupBy("host", "_i").agg(F.min("t").alias("start_s"), F.max("t").alias("end_s")).select("host", "start_s", "end_s", F.lit(kind).alias("kind"))

    return spans(F.col("cpu_pct") > cpu, "cpu").where(F.col("end_s") - F.col("start_s") > seconds).union(spans(F.col("ram_avail_mb") < ram_mb, "ram"))


def compiled_context(sections: DataFrame, budget: int = CONTEXT_TOKENS, reserve: int | None = None) -> DataFrame:
    """Pieces of contexts (query_id, section, age, tokens) that stay: query_id, section, age, tokens, cut (tokens it is cut to).

    A piece is cut to what its section may have in all, newest (least age) first. If a query's pieces still exceed ``budget``
    less ``reserve`` (for the answer), those of ``EVICTED`` sections go, section by section in that order and the oldest first;
    ``KEPT_SECTIONS`` stay whatever happens. Unknown sections go before all.
    """
    reserve = CONTEXT_TOKENS - sum(SECTIONS.values()) if reserve is None else reserve
    limit = F.create_map(*[F.lit(x) for kv in SECTIONS.items() for x in kv])
    newest = Window.partitionBy("query_id", "section").orderBy("age").rowsBetween(Window.unboundedPreceding, 0)
    room = F.coalesce(F.try_element_at(limit, "section"), F.lit(0)) - (F.sum("tokens").over(newest) - F.col("tokens"))
    cut = sections.withColumn("cut", F.greatest(F.lit(0), F.least("tokens", room)).cast("bigint")).where((F.col("cut") > 0) | F.col("section").isin(*KEPT_SECTIONS))
    # the last to go comes first, so a running sum tells what fits
    rank = F.when(F.col("section").isin(*KEPT_SECTIONS), 0).otherwise(len(EVICTED) + 1 - F.coalesce(F.array_position(F.array(*map(F.lit, EVICTED)), F.col("section")), F.lit(0)))
    order = Window.partitionBy("query_id").orderBy("_rank", "age", "section").rowsBetween(Window.unboundedPreceding, 0)
    return cut.withColumn("_rank", rank).withColumn("_upto", F.sum("cut").over(order)).where((F.col("_rank") == 0) | (F.col("_upto") <= budget - reserve)).select("query_id", "section", "age", "tokens", "cut")


def node_states(events: DataFrame) -> DataFrame:
    """State of each node after its events (event_id, query_id, node_id, event_type, created_at): query_id, node_id, status, attempt.

    The last event that moves a state decides (of one time the greatest event_id); a node without one is PENDING.
    """
    to = F.try_element_at(F.create_map(*[F.lit(x) for kv in TRANSITIONS.items() for x in kv]), F.col("event_type"))
    last = F.max(F.when(to.isNotNull(), F.struct("created_at", "event_id", to.alias("status"))))
    return events.groupBy("query_id", "node_id").agg(F.coalesce(last["status"], F.lit("PENDING")).alias("status"), F.count_if(F.col("event_type") == "node.attempt.start").alias("attempt"))


def unknown_events(events: DataFrame) -> DataFrame:
    """Event types outside of ``EVENT_TYPES``, with how often each came."""
    return events.where(~F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))).groupBy("event_type").agg(F.count("*").alias("n"))


def event_metrics(events: DataFrame) -> DataFrame:
    """Events by query and type, in one aggregation."""
    return events.groupBy("query_id", "event_type").agg(F.count("*").alias("n"))
