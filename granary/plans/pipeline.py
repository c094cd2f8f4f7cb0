"""Phases in order, each writing a table, and a command line over them.

python -m granary.plans.pipeline --data DIR --phase filter,mix,validate
"""

from __future__ import annotations

import argparse
import contextlib
import functools
import logging
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import text as X
from granary import session
from granary.operators import chunking, dedup, infer, mix, pages, quality, records, validate
from granary.operators.backends import EchoBackend, HttpBackend, NgramBackend
from granary.plans import resources
from granary.sources import files, paged, repositories, seeds

log = logging.getLogger("granary")
EXTENSIONS = {"python": [".py"], "c": [".c", ".h"], "javascript": [".js"], "html": [".html", ".htm"], "css": [".css"]}
EXCLUDED = [".git", "node_modules", "build", "dist", "vendor", "third_party", "__pycache__", "test", "tests"]
CONFIG_EXTENSIONS = [".yaml", ".yml", ".tf", ".tfvars", ".service", ".timer"]
#: Rows that an output needs for its phase to be skipped by --resume.
LEAST = {"hub": ("layers/doc_hub", 1), "chunk": ("chunks/code_raw", 50), "instruct": ("layers/code", 50), "docs": ("layers/doc", 50), "align": ("layers/alignment", 1), "align-code": ("layers/alignment_code", 100), "devops": ("layers/devops", 1), "mix": ("train", 100)}


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select("instruction", "output", "token_count", "input", "metadata", F.coalesce("metadata.layer", F.lit("code")).alias("layer"), F.coalesce("metadata.language", F.lit("unknown")).alias("language"))


BACKENDS: dict[str, Callable] = {"echo": EchoBackend, "ngram": NgramBackend}


def _backend(options) -> Callable:
    """What completes: one of ``BACKENDS`` by name, or a server by its address."""
    url = options.backend
    return BACKENDS[url] if url in BACKENDS else functools.partial(HttpBackend, url)


def _wanted_source(path: Column) -> Column:
    return quality.source_file_ok(path, F.lit(0), [e for es in EXTENSIONS.values() for e in es], EXCLUDED)


def phase_clone(spark: SparkSession, data: str, options) -> None:
    """Checkouts below repos/: fetched where git and the network allow (--fetch), else taken as they are; each must have enough files."""
    if options.fetch:
        repositories.clone_all([(r["repo"], r["url"]) for r in seeds.repositories(spark).collect()], f"{data}/repos")
    if files.exists(spark, f"{data}/repos"):
        listed = files.list_tree(spark, f"{data}/repos").withColumn("repo", F.element_at(F.split("path", "/"), 1))
        for r in validate.enough_files(listed).where("NOT ok").collect():
            log.warning("%s has only %d files", r["repo"], r["n_files"])


def phase_chunk(spark: SparkSession, data: str, options) -> None:
    """repos/REPO/... to chunks; only files of known languages outside of excluded folders are opened."""
    tree = files.read_tree(spark, f"{data}/repos", keep=_wanted_source).withColumn("repo", F.element_at(F.split("path", "/"), 1))
    language = F.coalesce(*(F.when(X.file_suffix(F.col("path")).isin(*e), lang) for lang, e in EXTENSIONS.items()))
    source = tree.where(quality.source_file_ok(F.col("path"), F.col("n_lines"), [e for es in EXTENSIONS.values() for e in es], EXCLUDED))
    chunks = chunking.source_chunks(source.withColumn("language", language), path="path")
    files.write_jsonl(validate.present(chunks, "repo", "file_path", "code"), f"{data}/chunks/code_raw")


def phase_instruct(spark: SparkSession, data: str, options) -> None:
    """Chunks to code records by completions that resume; a chunk whose text can't be used is left out."""
    chunks = files.read_jsonl(spark, f"{data}/chunks/code_raw", records.CHUNK)
    keyed = infer.numbered(chunks.withColumn("_o", F.struct("repo", "file_path", "start_line", "end_line", "chunk_type")), "_o").withColumnRenamed("pos", "_idx").drop("_o")
    if options.limit:
        keyed = keyed.where(F.col("_idx") < options.limit)
    jobs = keyed.select("_idx", infer.instruction_prompt(F.col("language"), F.col("code")).alias("prompt"), F.lit(None).cast("int").alias("max_tokens"), F.lit(None).cast("double").alias("temperature"), F.lit(None).cast("double").alias("top_p"), F.lit(None).cast("array<string>").alias("stop"))
    if not options.resume:
        session.remove(spark, f"{data}/runs/instruct")
    infer.run_to_folder(spark, jobs, f"{data}/runs/instruct", _backend(options))
    usable = infer.usable_instructions(keyed, spark.read.schema(infer.RESULT).parquet(f"{data}/runs/instruct/results")).where("defect IS NULL")
    files.write_jsonl(records.chunk_record(usable, X.strip(F.col("_text"))), f"{data}/layers/code")


def phase_align(spark: SparkSession, data: str, options) -> None:
    """Seeds, pairs asked for in rounds until there are --align of them, and questions about papers."""
    parts = [seeds.alignment_seeds(spark)]
    if options.align:
        made = infer.expand_in_rounds(spark, list(seeds.PRINCIPLES), list(seeds.LANGUAGES), seeds.PRINCIPLES, options.align, _backend(options))
        parts.append(made.select(*records.seed_record(F.col("language"), F.col("principle"), F.col("bad"), F.col("principle"), F.col("good"), source="expansion")))
    files.write_jsonl(mix.union_layers(*parts, seeds.paper_rows(spark)), f"{data}/layers/alignment")


def phase_devops(spark: SparkSession, data: str, options) -> None:
    """Seeds, and the configuration files below config/REPO."""
    parts = [seeds.operations_seeds(spark)]
    if files.exists(spark, f"{data}/config"):
        tree = files.read_tree(spark, f"{data}/config", keep=lambda path: quality.config_file_ok(path, F.lit(1), CONFIG_EXTENSIONS)).withColumn("repo", F.element_at(F.split("path", "/"), 1))
        good = tree.where(quality.config_file_ok(F.col("path"), F.col("n_lines"), CONFIG_EXTENSIONS))
        chunks = chunking.config_chunks(good)
        parts.append(chunks.select(*records.record(F.col("instruction"), F.col("output"), layer="devops", language="devops", source="repo", repo=F.element_at(F.split("path", "/"), 1), file=F.col("path"))))
    files.write_jsonl(mix.union_layers(*parts), f"{data}/layers/devops")


def phase_docs(spark: SparkSession, data: str, options) -> None:
    """Reference pages (key, html) below pages/FAMILY to doc records; --fetch fills the cache below cache/FAMILY first."""
    if options.fetch:
        for r in seeds.reference_pages(spark).groupBy("family").agg(F.collect_list("url").alias("urls")).collect():
            fetched, failed = paged.fetch_into(sorted(r["urls"]), f"{data}/cache/{r['family']}", paged.http_get)
            log.info("%s: %d pages fetched, %d given up", r["family"], fetched, len(failed))
    parts = []
    for f in pages.FAMILIES:
        if files.exists(spark, f"{data}/pages/{f}"):
            parts.append((f, spark.read.schema("key STRING, html STRING").json(f"{data}/pages/{f}")))
        if files.exists(spark, f"{data}/cache/{f}"):
            cached = files.read_tree(spark, f"{data}/cache/{f}", "*.html").select(F.regexp_replace("path", r"\.html$", "").alias("name"), F.col("text").alias("html"))
            listed = seeds.reference_pages(spark).where(F.col("family") == f)
            parts.append((f, paged.cached_pages(listed, cached).join(listed.select("url", "key"), "url").select("key", "html")))
    made = [pages.page_records(d, f, "key").select(*records.record(F.col("instruction"), F.col("output"), layer="doc", source=f"{f}_reference", topic=F.col("topic"))) for f, d in parts]
    if made:
        files.write_jsonl(mix.union_layers(*made), f"{data}/layers/doc")


#: Layers that rows of a hub go to: below hub/KIND/NAME, or from a paged source, and what their records are called.
HUB = {"code": "code_hub", "doc": "doc_hub", "alignment": "alignment_hub", "devops": "devops_hub"}


def phase_hub(spark: SparkSession, data: str, options) -> None:
    """Rows of hubs to records that go before those of their layer.

    Instruction rows lie below hub/rows (doc), hub/code and hub/alignment, chats below hub/chats (devops); a paged source
    ``--hub LAYER=MODULE:FUNCTION:ROWS`` is read page by page instead. Each output counts once, in a reproducible order, and
    ``--limit`` bounds what a source gives.
    """
    schema = "instruction STRING, input STRING, output STRING, category STRING, language STRING"
    found: dict[str, list[DataFrame]] = {layer: [] for layer in HUB}
    for kind, layer in (("rows", "doc"), ("code", "code"), ("alignment", "alignment")):
        if files.exists(spark, f"{data}/hub/{kind}"):
            found[layer].append(spark.read.schema(schema).json(f"{data}/hub/{kind}"))
    for named in options.hub or ():
        layer, _, place = named.partition("=")
        module, function, n = place.split(":")
        paged.register(spark)
        source = spark.read.format("pages").option("module", module).option("function", function).option("rows", n).option("most", options.limit or 0).load()
        found[layer].append(source.select(F.from_json("row", schema).alias("r")).select("r.*"))
    for layer, parts in found.items():
        made = [records.map_rows(p, "instruction", "output", "input", layer=layer, language=F.coalesce("language", F.lit("unknown")), source="hub:rows", category=F.col("category")) for p in parts]
        if layer == "devops" and files.exists(spark, f"{data}/hub/chats"):
            chats = spark.read.schema("conversations STRING").json(f"{data}/hub/chats")
            made.append(records.chat_pairs_nested(chats, "conversations").select(*records.record(F.col("instruction"), F.col("output"), layer="devops", language="unknown", source="hub:chats")))
        if made:
            once = _once(mix.union_layers(*made)).withColumn("_d", X.digest(F.col("output")))
            rows = mix.shuffled_head(once, options.limit, "_d", seed=options.seed) if options.limit else mix.shuffled(once, "_d", seed=options.seed)
            files.write_jsonl(rows.drop("_d"), f"{data}/layers/{HUB[layer]}")


def _once(rows: DataFrame) -> DataFrame:
    """One row of each output: that of least instruction."""
    keyed = rows.withColumn("_d", X.digest(F.col("output"))).withColumn("_o", F.struct("instruction", "input", "_d"))
    return dedup.first_wins(keyed.dropDuplicates(["_o"]), ["_d"], "_o").drop("_d", "_o")


def phase_align_code(spark: SparkSession, data: str, options) -> None:
    """Refactoring records from code records; they go before the seeds."""
    made_of = [x for x in SOURCES["code"] if files.exists(spark, f"{data}/layers/{x}")]
    code = mix.union_layers(*(files.read_jsonl(spark, f"{data}/layers/{x}") for x in made_of or ["code"])).select("instruction", "output", "metadata.language")
    keyed = infer.numbered(code.withColumn("_o", X.digest(F.concat_ws("\x1f", "instruction", "output"))), "_o").drop("_o")
    seen = files.read_jsonl(spark, f"{data}/layers/alignment").select("output")
    made = infer.expand_from_code(keyed, seen, seeds.PRINCIPLES, _backend(options), most=options.limit or 4000, seed=options.seed)
    files.write_jsonl(made.select(*records.record(F.col("instruction"), F.col("output"), F.col("input"), layer="alignment", language=F.col("language"), principle=F.col("principle"), source="code-expansion")), f"{data}/layers/alignment_code")


#: Where rows of each layer come from, in the order in which first copies win.
SOURCES = {"code": ("code_hub", "code"), "doc": ("doc_hub", "doc"), "alignment": ("alignment_hub", "alignment_code", "alignment"), "devops": ("devops_hub", "devops")}


def phase_filter(spark: SparkSession, data: str, options) -> None:
    """The waterfall over all layers that exist; the report goes to the log."""
    present = [(layer, k, x) for layer in mix.LAYERS for k, x in enumerate(SOURCES[layer]) if files.exists(spark, f"{data}/layers/{x}")]
    whole = mix.union_layers(*(_flat(files.read_jsonl(spark, f"{data}/layers/{x}")).withColumns({"layer": F.lit(layer), "_k": F.lit(k)}) for layer, k, x in present))
    order = F.struct("_k", X.digest(F.concat_ws("\x1f", "layer", "instruction", "output")).alias("d"))
    judged = quality.waterfall(infer.numbered(whole.withColumn("_o", order), "_o").drop("_o", "_k"))
    files.write_layers(judged.where(F.col("reason") == quality.KEPT), f"{data}/filtered")
    for r in quality.ranked_report(quality.drop_report(judged)).orderBy("layer", "rank").collect():
        log.info("%s %s: %d rows, %d tokens", r["layer"], r["reason"], r["n"], r["tokens"])


def phase_mix(spark: SparkSession, data: str, options) -> None:
    kept = spark.read.parquet(f"{data}/filtered")
    files.write_jsonl(mix.shuffled(kept.select("pos", "instruction", "input", "output", "token_count", "metadata"), "pos", seed=options.seed).drop("pos"), f"{data}/train")
    files.write_stats(mix.stats_document(kept), f"{data}/stats.json")


def phase_validate(spark: SparkSession, data: str, options) -> bool:
    report = validate.validation_report(_flat(files.read_jsonl(spark, f"{data}/train")), list(seeds.LANGUAGES), options.least).persist()
    for r in report.collect():
        log.log(logging.INFO if r["ok"] else logging.ERROR if r["fatal"] else logging.WARNING, "%s = %s %s", r["name"], r["value"], "ok" if r["ok"] else "not ok")
    return validate.passes(report)


PHASES: dict[str, Callable] = {"clone": phase_clone, "chunk": phase_chunk, "instruct": phase_instruct, "docs": phase_docs, "hub": phase_hub, "align": phase_align, "align-code": phase_align_code, "devops": phase_devops, "filter": phase_filter, "mix": phase_mix, "validate": phase_validate}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="granary")
    p.add_argument("--data", required=True)
    p.add_argument("--phase", default="all")
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--seed", type=int, default=mix.SEED)
    p.add_argument("--least", type=int, default=validate.MIN_LINES)
    p.add_argument("--resume", action="store_true", help="skip phases whose output is there with enough rows; completions go on from what they have")
    p.add_argument("--fetch", action="store_true", help="clone repositories and fetch reference pages first")
    p.add_argument("--backend", default="echo", help="echo, ngram, or the address of a completion server")
    p.add_argument("--align", type=int, default=0, help="refactoring pairs to ask for besides the seeds")
    p.add_argument("--hub", action="append", metavar="LAYER=MODULE:FUNCTION:ROWS", help="a paged source of instruction rows")
    p.add_argument("--monitor", help="CSV file for this machine's load while the phases run")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run phases in the order given; 1 for an unknown one. A failed validation is logged and doesn't change the code."""
    options = parse(argv)
    names = [x for x in PHASES if x != "align-code"] if options.phase == "all" else [x.strip() for x in options.phase.split(",") if x.strip()]
    unknown = [x for x in names if x not in PHASES]
    if unknown:
        log.error("unknown phase %s; known: %s", unknown[0], ", ".join(PHASES))
        return 1
    spark = spark or SparkSession.builder.appName("granary").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    data = options.data.rstrip("/")
    with resources.Monitor(path=options.monitor) if options.monitor else contextlib.nullcontext():
        run_phases(spark, names, data, options)
    session.clean(spark)
    return 0


def run_phases(spark: SparkSession, names: list[str], data: str, options) -> None:
    for x in names:
        if options.resume and x == "filter" and files.all_finished(spark, [f"{data}/filtered/layer={layer}" for layer in mix.LAYERS]):
            log.info("all filtered layers are there already")
            continue
        if options.resume and x in LEAST and files.finished(spark, f"{data}/{LEAST[x][0]}", LEAST[x][1]):
            log.info("%s is there already", x)
            continue
        PHASES[x](spark, data, options)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
