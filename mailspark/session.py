"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # JSON objects with a repeated key keep the last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Dates are compared as instants, never in the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    # Documents cross the Python border in small batches, long ones (mails with attachments) in smaller ones.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings and hand the package to the executors; everything else is
    left to the cluster."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    # Many folders are listed by a few tasks a core; each of the 10,000 by default costs more than the folders it lists.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", max(64, 4 * spark.sparkContext.defaultParallelism))
    ship(spark, __package__)
    return spark


def ship(spark: SparkSession, package: str) -> None:
    """Send a package of this folder to all executors, once per application.

    Python workers import it from there, so nothing has to be installed on the cluster."""
    archive = f"{package}.zip"
    if any(name.endswith("/" + archive) for name in spark.sparkContext.listFiles):
        return
    root = Path(__file__).resolve().parent.parent
    base = Path(tempfile.mkdtemp(prefix="ship-")) / package
    spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", root, package))


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's checkpoint folder, which all executors share.

    Where none is set, a local session (tests, a laptop) gets one on its own disk; a cluster must
    name one, since its executors would not see each other's files.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mailspark-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write once, read back: what follows never recomputes ``df``, also after the loss of
    an executor."""
    path = path or work_dir(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
