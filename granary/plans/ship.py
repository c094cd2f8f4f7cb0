"""Give every worker this package, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import granary


def ship(spark: SparkSession) -> None:
    """Serve the package's sources to the session's workers once (a few hundred KB over Spark's own file server)."""
    if getattr(spark, "_granary_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(granary.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="granary-src-"), "granary.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("granary", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    spark._granary_shipped = True
