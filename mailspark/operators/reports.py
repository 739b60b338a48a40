"""Counters and reports.  All are map-side combined; a hot status or category is no issue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_changed(df: DataFrame) -> DataFrame:
    """Documents scanned and documents changed by the second-pass cut."""
    return df.agg(F.count("*").alias("scanned"), F.count_if("changed").alias("cleaned"))


def count_status(ledger: DataFrame) -> DataFrame:
    """Rows per stage and status (ok, skip, fail kinds)."""
    return ledger.groupBy("stage", "status").agg(F.count("*").alias("n"))


def count_run(inputs: DataFrame, done: DataFrame, key: str = "doc_key") -> DataFrame:
    """Rows per status of one run, with ``skip`` for the inputs that it did not take up.  ``done``
    has a ``key`` and a ``status``.  ``ok`` and ``skip``
    are there with 0, too."""
    taken = done.select(F.col(key).alias("_taken")).distinct()
    skipped = inputs.join(taken, inputs[key] == taken["_taken"], "left_anti").select(F.lit("skip").alias("status"))
    counts = done.select("status").unionByName(skipped).groupBy("status").agg(F.count("*").alias("n"))
    kinds = inputs.sparkSession.createDataFrame([("ok",), ("skip",)], "status string")
    return counts.join(kinds, "status", "full").select("status", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def count_records(qa: DataFrame, file: str = "file") -> DataFrame:
    """Distinct files that have records, and records in total.

    Counting per file first keeps the distinct count free of one huge group."""
    per_file = qa.groupBy(file).agg(F.count("*").alias("n"))
    return per_file.agg(F.count(file).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"))


def progress(documents: DataFrame, qa: DataFrame, key: str = "doc_key", file: str = "file") -> DataFrame:
    """Share of documents done in percent, and records per hundred documents."""
    zero = F.lit(0).cast("bigint")
    total = documents.agg(F.count_distinct(key).alias("total")).withColumns({"files": zero, "records": zero})
    done = count_records(qa, file).withColumn("total", zero)
    whole = total.unionByName(done).agg(*[F.sum(c).alias(c) for c in ("total", "files", "records")])
    documents_or_null = F.nullif(F.col("total"), F.lit(0))
    return whole.select(
        "total",
        F.col("files").alias("done"),
        "records",
        F.round(F.lit(100.0) * F.col("files") / documents_or_null, 1).alias("done_pct"),
        F.round(F.lit(100.0) * F.col("records") / documents_or_null, 2).alias("records_pct"),
    )


def rewrite_totals(ledger: DataFrame, stage: str, batch_col: str, current: str) -> DataFrame:
    """Source rows seen, rows new in this batch, rows in total that carry an answer or were kept."""
    rows = ledger.filter(F.col("stage") == stage)
    written = F.col("status") != "malformed"
    return rows.agg(
        F.count("*").alias("source_rows"),
        F.count_if(written & (F.col(batch_col) == current)).alias("new_rows"),
        F.count_if(written).alias("total_rows"),
    )


def export_summary(order: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of an export and its field list, as one row."""
    fields = order.agg(F.array_sort(F.collect_list(F.struct("position", "column_name"))).alias("f"))
    fields = fields.select(F.lit(0).cast("bigint").alias("n_rows"), F.array_join(F.col("f")["column_name"], ",").alias("fields"))
    counted = table.agg(F.count("*").alias("n_rows")).withColumn("fields", F.lit(None).cast("string"))
    return counted.unionByName(fields).agg(F.sum("n_rows").alias("n_rows"), F.max("fields").alias("fields"))


def qa_mix(qa: DataFrame, subtotals: bool = False) -> DataFrame:
    """Records by category and model."""
    grouped = qa.rollup("category", "model") if subtotals else qa.groupBy("category", "model")
    return grouped.agg(F.count("*").alias("n"))
