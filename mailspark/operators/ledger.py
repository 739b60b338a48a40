"""Run state: which input of which stage is done.

The ledger is a table ``stage, key, input_hash, status, attempts, error, finished_at`` that
only ever grows by whole batches.  Done means: an entry for the same stage, key and input
with a closing status.  A changed input has another hash and is due again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.sinks.documents import write_documents
from mailspark.sources.files import path_exists

SCHEMA = (
    "stage string, key string, input_hash string, status string, attempts int, error string, "
    "finished_at timestamp"
)

# A stage that found nothing is as done as one that found something; failures are due again.
CLOSING = ("ok", "empty", "no_items", "rewritten")


def with_hash(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("input_hash", F.sha2(F.coalesce(F.col(col).cast("string"), F.lit("")), 256))


def entries(df: DataFrame, stage: str, key: str = "doc_key") -> DataFrame:
    """Ledger rows of a stage's result; attempts and error are filled in where missing."""

    def given(name: str, default):
        return F.col(name) if name in df.columns else F.lit(default)

    return df.select(
        F.lit(stage).alias("stage"),
        F.col(key).cast("string").alias("key"),
        given("input_hash", None).cast("string").alias("input_hash"),
        F.col("status").cast("string").alias("status"),
        given("attempts", 1).cast("int").alias("attempts"),
        given("error", None).cast("string").alias("error"),
        F.current_timestamp().alias("finished_at"),
    )


def write_entries(rows: DataFrame, path: str, batch: str) -> None:
    write_documents(rows, path, batch, key="key")


def read_ledger(spark: SparkSession, path: str, with_batch: bool = False) -> DataFrame:
    """All entries; ``with_batch`` adds the name of the batch that wrote them."""
    if path_exists(spark, path):
        table = spark.read.schema(SCHEMA + ", batch string").option("basePath", path).parquet(path)
    else:
        table = spark.createDataFrame([], SCHEMA + ", batch string")
    return table if with_batch else table.drop("batch")


def done_keys(ledger: DataFrame, stage: str, statuses: Sequence[str] = CLOSING) -> DataFrame:
    """Distinct ``key, input_hash`` that are done."""
    return ledger.filter((F.col("stage") == stage) & F.col("status").isin(*statuses)).select("key", "input_hash").distinct()


def pending(
    df: DataFrame,
    ledger: DataFrame,
    stage: str,
    key: str = "doc_key",
    overwrite: bool = False,
    statuses: Sequence[str] = CLOSING,
) -> DataFrame:
    """Rows still to be done: an anti join before any of them costs something.

    Rows carry ``input_hash`` where content counts; without it the key alone decides.
    """
    if overwrite:
        return df
    done = done_keys(ledger, stage, statuses)
    if "input_hash" in df.columns:
        same = (df[key].cast("string") == done["key"]) & (df["input_hash"] == done["input_hash"])
        return df.join(done, same, "left_anti")
    keys = done.select("key").distinct()
    return df.join(keys, df[key].cast("string") == keys["key"], "left_anti")


def pending_files(df: DataFrame, qa: DataFrame, key: str = "doc_key", file: str = "file") -> DataFrame:
    """Documents that have no record yet in the QA output.

    The output holds many rows per file; their keys are reduced before the join."""
    done = qa.select(F.col(file).alias("_file")).filter("_file is not null").distinct()
    return df.join(done, df[key] == done["_file"], "left_anti")


def pending_targets(df: DataFrame, targets: DataFrame, key: str, target: str, text: str, overwrite: bool = False) -> DataFrame:
    """Inputs without a non-empty target document (an empty target is made again)."""
    if overwrite:
        return df
    done = targets.filter(F.length(text) > 0).select(F.col(target).alias("_target")).distinct()
    return df.join(done, df[key] == done["_target"], "left_anti")


def gate(df: DataFrame, ledger: DataFrame, stage: str, key: str = "doc_key") -> DataFrame:
    """Only rows whose ``stage`` ended well go on; no entry means no passage."""
    passed = done_keys(ledger, stage, ("ok",))
    if "input_hash" in df.columns:
        same = (df[key].cast("string") == passed["key"]) & (df["input_hash"] == passed["input_hash"])
        return df.join(passed, same, "left_semi")
    keys = passed.select("key").distinct()
    return df.join(keys, df[key].cast("string") == keys["key"], "left_semi")


def first_n(df: DataFrame, n: int | None, key: str = "doc_key") -> DataFrame:
    """The rows of the ``n`` smallest keys, for trial runs.

    Only keys are ranked; the rows come back by a semi join, so no text is sorted."""
    if n is None:
        return df
    keys = df.select(F.col(key).alias("_key")).orderBy("_key").limit(n)
    return df.join(keys, df[key] == keys["_key"], "left_semi")


def due(
    df: DataFrame,
    ledger: DataFrame,
    stage: str,
    key: str = "doc_key",
    limit: int | None = None,
    when: str = "before_skip",
    overwrite: bool = False,
) -> DataFrame:
    """Skip what is done, and limit a trial run before or after skipping."""
    if when not in ("before_skip", "after_skip"):
        raise ValueError(f"when must be 'before_skip' or 'after_skip', not {when!r}")
    if when == "before_skip":
        return pending(first_n(df, limit, key), ledger, stage, key, overwrite)
    return first_n(pending(df, ledger, stage, key, overwrite), limit, key)


def nothing_due(df: DataFrame) -> bool:
    """True where a run can end before it connects to anything."""
    return df.isEmpty()
