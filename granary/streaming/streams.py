"""Structured Streaming forms: windowed metrics, deduplicated arrivals, results that resume."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from granary.functions import text as X

log = logging.getLogger("granary")


def event_time(events: DataFrame, column: str = "ts") -> DataFrame:
    """The same with ``column`` as a timestamp with zone (watermarks need one)."""
    return events.withColumn(column, F.col(column).cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 hour", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """n, mean and greatest value by window and keys; in a stream, rows later than ``late`` are dropped."""
    e = event_time(events)
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    return e.groupBy(F.window("ts", width).alias("w"), *keys).agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"), F.max("value").alias("max_value")).select(F.col("w.start").alias("window_start"), *keys, "n", "mean_value", "max_value")


def sessions(events: DataFrame, gap: str = "1 hour", late: str = "2 hours", key: str = "user_id") -> DataFrame:
    """Sessions of each key: start, end (of the last event) and number of events; a pause of ``gap`` ends one."""
    e = event_time(events)
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    return e.groupBy(key, F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n_events"), F.max("ts").alias("session_end")).select(key, F.col("s.start").alias("session_start"), "session_end", "n_events")


def arrivals_once(rows: DataFrame, text: str, time: str, within: str = "1 day") -> DataFrame:
    """Rows whose text hasn't come before; in a stream, hasn't come within ``within`` of event ``time``, so that state stays bounded.

    Null texts count as ''. Rows of a stream without a time are kept, each as it comes.
    """
    marked = event_time(rows, time).withColumn("_d", X.digest(X.text_or_empty(F.col(text))))
    if rows.isStreaming:
        return marked.withWatermark(time, within).dropDuplicatesWithinWatermark(["_d"]).drop("_d")
    return marked.dropDuplicates(["_d"]).drop("_d")


def resumable_results(spark: SparkSession, jobs_dir: str, jobs_schema, out_dir: str, checkpoint: str, complete) -> StreamingQuery:
    """Run ``complete`` (jobs to results) over files of jobs as they come; each batch writes a folder of its own.

    A batch that runs again after a crash overwrites its folder, so results are there exactly once.
    """

    def write(batch: DataFrame, number: int) -> None:
        complete(batch).write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    jobs = spark.readStream.schema(jobs_schema).parquet(jobs_dir)
    return jobs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(stream: DataFrame, out_dir: str, checkpoint: str, mode: str = "append") -> list[tuple[int, int]]:
    """Write all that a stream has now as Parquet and return when it is done: (batch, rows in) of each batch.

    While it runs, :class:`Progress` logs each batch.
    """
    seen = Progress()
    stream.sparkSession.streams.addListener(seen)
    try:
        query = stream.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        stream.sparkSession.streams.removeListener(seen)
    return sorted({(int(p["batchId"]), int(p["numInputRows"])) for p in query.recentProgress})


class Progress(StreamingQueryListener):
    """Keeps rows in and rate of each batch of the session's streams."""

    def __init__(self) -> None:
        self.batches: list[tuple[str, int, float]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((str(p.id), int(p.numInputRows), float(p.processedRowsPerSecond)))
        log.info("batch %d: %d rows, %.1f a second", p.batchId, p.numInputRows, p.processedRowsPerSecond)

    def onQueryTerminated(self, event) -> None:
        pass
