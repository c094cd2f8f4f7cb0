"""Session helpers: table access, the folder all executors share, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none, a folder is made and set, but on a single machine only: elsewhere executors
    couldn't see it.
    """
    uri = spark.conf.get("spark.checkpoint.dir", None)
    if uri:
        return uri.rstrip("/")
    known = getattr(spark, "_granary_shared", None)
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="granary-")
        spark.sparkContext.setCheckpointDir(known)
        spark._granary_shared = known
    return known


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder, below a folder of this application, that nothing else uses."""
    return f"{shared_dir(spark)}/granary/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def local_mount(spark: SparkSession, path: str) -> str | None:
    """The local path of a place in the shared folder that every machine has mounted; None on other file systems.

    A path without a scheme belongs to Spark's default file system, which needn't be the local one.
    """
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = str(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri())
    return "/" + uri[len("file:") :].lstrip("/") if uri.startswith("file:") else None


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later plans start from durable files.

    Unlike a cache this survives the loss of executors and cuts the lineage. :func:`discard` removes the files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._granary_path = path
    return back


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by :func:`materialize`, once nothing reads it any more."""
    remove(df.sparkSession, df._granary_path)


def clean(spark: SparkSession) -> None:
    """Remove all tables that this application has left in the shared folder."""
    remove(spark, f"{shared_dir(spark)}/granary/{spark.sparkContext.applicationId}")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, over an old one, on whatever file system ``path`` names."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df`` (file sizes for scans); never below 1."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(1, int(str(size)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
