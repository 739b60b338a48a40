"""Document tables: keyed, written in batches, re-runnable."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.functions.text import cut_forwarded


def write_documents(df: DataFrame, path: str, batch: str, key: str = "doc_key", retire: DataFrame | None = None) -> None:
    """Write one batch of documents.  Writing the same batch again replaces it, so a job
    that died half-way is simply run again; other batches are never touched.

    A row without a key fails the job.  ``retire`` (a table with ``key``) lists documents that
    are no more: their rows of earlier batches stop counting.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
        raise ValueError(f"not a batch name: {batch!r}")
    named = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a row without {key}")).cast(df.schema[key].dataType)).otherwise(F.col(key))
    rows = df.withColumn(key, named).withColumn(RETIRED, F.lit(False))
    if retire is not None:
        gone = retire.select(F.col(key).cast(df.schema[key].dataType).alias(key)).distinct().withColumn(RETIRED, F.lit(True))
        rows = rows.unionByName(gone, allowMissingColumns=True)
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


#: Marks the rows of a batch that end a document.
RETIRED = "_retired"


def batch_order(batch: Column) -> Column:
    """Names of batches in the order a reader expects: numbers in them count as numbers."""
    pieces = F.regexp_extract_all(batch, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r"^\d"), F.lpad(F.regexp_replace(p, r"^0+(?=\d)", ""), 32, "0")).otherwise(p)), "")


def read_documents(spark: SparkSession, path: str, key: str = "doc_key") -> DataFrame:
    """The current rows of each key: those of its newest batch, unless that retired it.

    Only keys and batch names are shuffled to find replaced documents; where there are none,
    the texts of the table are not moved.
    """
    table = spark.read.option("basePath", path).parquet(path)
    table = table.withColumn("_order", batch_order(F.col("batch").cast("string"))).drop("batch")
    newest = table.groupBy(key).agg(F.min("_order").alias("_oldest"), F.max("_order").alias("_newest"))
    newest = newest.filter("_oldest < _newest").select(F.col(key).alias("_key"), "_newest")
    if not newest.isEmpty():
        old = (F.col(key) == F.col("_key")) & (F.col("_order") < F.col("_newest"))
        table = table.join(newest, old, "left_anti")
    return table.filter(~F.col(RETIRED)).drop("_order", RETIRED)


def update_documents(df: DataFrame, col: str = "markdown", **markers) -> DataFrame:
    """The second-pass cut as a new snapshot: the text column replaced, ``changed`` added.

    Nothing is rewritten in place; write the result as a new batch or a new table."""
    cleaned = cut_forwarded(F.col(col), **markers)
    return df.withColumn("_cleaned", cleaned).select(
        *[F.col("_cleaned").alias(c) if c == col else F.col(c) for c in df.columns],
        (F.col("_cleaned") != F.col(col)).alias("changed"),
    )


def write_changed(df: DataFrame, path: str, batch: str, key: str = "doc_key") -> None:
    """Write the changed documents of an ``update_documents`` snapshot as a batch."""
    write_documents(df.filter("changed").drop("changed"), path, batch, key)


def export_folder(df: DataFrame, path: str, key: str = "doc_key", col: str = "markdown") -> None:
    """One text file per document, in a folder named after its key.

    On a local or mounted disk tasks write the files (see ``_write_files``), elsewhere Spark's own text
    sink.  Rows of one key that lie in one partition are lines of one file; callers that want one file
    per key deal their rows by it.  A table is the better home for documents."""
    stripped = F.regexp_replace(F.col(col), r"\n\z", "")
    if not _on_disk(df.sparkSession, path):
        df.select(F.col(key).alias("doc"), stripped.alias("value")).write.mode("overwrite").partitionBy("doc").text(path)
        return
    name = F.col(key).cast("string")
    rows = df.select(F.when(name != "", name).otherwise(NO_KEY).alias("doc"), stripped.cast("binary").alias("value"))
    _write_files(rows.sortWithinPartitions("doc"), path)


def export_files(df: DataFrame, path: str, col: str = "value") -> None:
    """One text file per row, all in one folder; written as by ``export_folder``."""
    if not _on_disk(df.sparkSession, path):
        df.select(col).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
        return
    _write_files(df.select(F.lit(None).cast("string").alias("doc"), F.col(col).cast("binary").alias("value")), path)


#: Folder of the rows without a key, and the signs a folder name cannot hold, as in Spark's own sinks.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
_UNSAFE = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


def _hadoop(spark: SparkSession, path: str):
    """File system and qualified path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(jpath)


def _on_disk(spark: SparkSession, path: str) -> bool:
    return _hadoop(spark, path)[0].getScheme() == "file"


def _write_files(rows: DataFrame, path: str) -> None:
    """Files of ``doc`` (neighbouring rows of one are lines of one file ``doc=.../*.txt``; null: a file of its own in
    ``path`` itself) and ``value`` (binary), in place of what ``path`` held.

    Spark's sink starts a process per file here to set its permissions, and renames all folders one after
    the other at the end.  Tasks write the files themselves, each under a name that a second attempt gives it
    again; they lie in a folder beside ``path`` which takes its place when all are there."""
    spark, job = rows.sparkSession, uuid.uuid4().hex
    fs, target = _hadoop(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{job}")
    folder = beside.toUri().getPath()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        files, of, file, attempt, name = 0, None, None, "", ""
        os.makedirs(folder, exist_ok=True)
        for doc, line in chain.from_iterable(zip(batch["doc"], batch["value"]) for batch in batches):
            if file is None or doc is None or doc != of:
                if file is not None:
                    file.close()
                    os.replace(attempt, name)
                own = folder if doc is None else f"{folder}/doc={_UNSAFE.sub(lambda c: f'%{ord(c[0]):02X}', doc)}"
                os.makedirs(own, exist_ok=True)
                part = f"part-{task.partitionId():05d}-{job}-c{files:06d}.txt"
                attempt, name = f"{own}/.{part}-{task.taskAttemptId()}", f"{own}/{part}"
                file, of, files = open(attempt, "wb"), doc, files + 1
            file.write((line or b"") + b"\n")
        if file is not None:
            file.close()
            os.replace(attempt, name)
        yield pd.DataFrame({"files": [files]})

    try:
        fs.mkdirs(beside)
        rows.mapInPandas(write, "files long").write.format("noop").mode("overwrite").save()
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(beside, "_SUCCESS")).close()
        fs.delete(target, True)
        if not fs.rename(beside, target):
            raise OSError(f"cannot rename {beside} to {target}")
    finally:
        fs.delete(beside, True)
