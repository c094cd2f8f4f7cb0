"""JSON lines, text files and Parquet as sources and sinks, with the checks of a phase's output."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import text as X
from granary import session
from granary.operators.records import RECORD
from granary.session import exists, write_text

class EmptyInput(ValueError):
    pass


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = session._fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = RECORD, most_bytes: int | None = None) -> DataFrame:
    """Rows of JSON lines; blank lines are skipped.

    A missing path gives no rows, an empty one raises :class:`EmptyInput`, one beyond ``most_bytes`` (where given) ValueError;
    a malformed line fails the query that reads it (:func:`bad_lines` names them).
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    size = total_bytes(spark, path)
    if size == 0:
        raise EmptyInput(f"{path} is empty")
    if most_bytes is not None and size > most_bytes:
        raise ValueError(f"{path} has {size} bytes, more than {most_bytes}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that aren't JSON: file, line."""
    t = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return t.where((X.strip(F.col("line")) != "") & F.try_parse_json("line").isNull())


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write JSON lines; the number of rows written, counted while writing."""
    seen = Observation("written")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).json(path)
    return int(seen.get["n"])


def write_layers(rows: DataFrame, path: str, layer: str = "layer") -> None:
    """Parquet by layer, so that a reader of one layer reads its files alone."""
    rows.write.mode("overwrite").partitionBy(layer).parquet(path)


def write_stats(row: DataFrame, path: str) -> dict:
    """The one row of statistics as an indented JSON file."""
    stats = json.loads(row.select(F.to_json(F.struct("*")).alias("j")).first()["j"])
    write_text(row.sparkSession, path, json.dumps(stats, indent=2, ensure_ascii=False))
    return stats


def finished(spark: SparkSession, path: str, least: int, fmt: str = "json") -> bool:
    """Whether a phase's output is there with at least ``least`` rows (no more than those are counted)."""
    if not exists(spark, path) or not total_bytes(spark, path):
        return False
    reader = spark.read.schema(RECORD) if fmt == "json" else spark.read
    return getattr(reader, fmt)(path).limit(least).count() >= least


def all_finished(spark: SparkSession, paths: list[str]) -> bool:
    """Whether all outputs of a phase are there; of none, it isn't finished."""
    return bool(paths) and all(exists(spark, p) for p in paths)


def list_tree(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files below ``root``: path (relative), length, and where each lies (``_file``). No content is read."""
    base = root.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    local = F.regexp_replace("path", r"^file:/*", "/")
    return files.select(F.substring(local, len(base if base.startswith("/") else base.replace("file://", "")) + 1, 1 << 20).alias("path"), "length", F.col("path").alias("_file"))


def read_tree(spark: SparkSession, root: str, glob: str = "*", keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Files below ``root``, in order of path: path (relative), length, text (malformed bytes replaced), n_lines.

    ``keep`` tells from the path whether a file is wanted; the others' content is never opened: each wanted file is read
    by the task that gets its place in the listing.
    """
    listed = list_tree(spark, root, glob)
    wanted = listed if keep is None else listed.where(keep(F.col("path")))

    def read(batches):
        from urllib.parse import unquote, urlparse

        for batch in batches:
            data = []
            for uri in batch.column(2).to_pylist():
                with open(unquote(urlparse(uri).path), "rb") as f:
                    data.append(f.read())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["path", "length", "content"])

    if root.startswith("/") or root.startswith("file:"):
        files = wanted.mapInArrow(read, "path STRING, length BIGINT, content BINARY")
    else:  # other file systems: Spark's own reader opens the files, after the filter on their paths
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        files = wanted.join(content.select(F.col("path").alias("_file"), "content"), "_file").drop("_file")
    text = X.decode_text(F.col("content"))
    return files.select("path", "length", text.alias("text"), X.file_lines(text).alias("n_lines")).orderBy("path")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` as a stream of files; a table of one file is met in its folder."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    fs, p = session._fs(spark, path)
    if fs.getFileStatus(p).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


METRICS = T.StructType(
    [T.StructField("t", T.DoubleType()), T.StructField("cpu_pct", T.DoubleType()), *(T.StructField(k, T.LongType()) for k in ("cpu_logical", "ram_used_mb", "ram_avail_mb")), *(T.StructField(k, T.DoubleType()) for k in ("gpu_util_pct", "gpu_vram_used_mb", "gpu_vram_free_mb", "gpu_power_w", "gpu_temp_c"))]
)


def write_metrics(rows: list[dict], path: str) -> None:
    """A monitor's rows as CSV at a local ``path``: all columns of ``METRICS``, blank where a value is missing."""
    import csv

    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, METRICS.names, restval="", extrasaction="ignore")
        out.writeheader()
        out.writerows({k: "" if v is None else v for k, v in r.items()} for r in rows)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A monitor's CSV; blank cells are null."""
    return spark.read.schema(METRICS).option("header", "true").csv(path)


def metric_averages(samples: DataFrame) -> DataFrame:
    """avg_gpu (of rows that have it) and avg_cpu, half to even at one digit; 0 of no rows."""
    mean = lambda c: F.coalesce(F.bround(F.avg(c), 1), F.lit(0.0))
    return samples.agg(mean("gpu_util_pct").alias("avg_gpu"), mean("cpu_pct").alias("avg_cpu"))
