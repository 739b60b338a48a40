"""JSON Lines scan with an explicit policy for malformed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.functions.jsontext import parse_object
from mailspark.functions.text import is_blank
from mailspark.sources.files import EmptyInput, check_not_empty, path_exists

POLICIES = ("keep", "skip", "fail")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines as ``line_key, line``.

    ``line_key`` orders the lines as they stand in the files: file, start of the split in
    the file, running number inside the split.  All rows of a split are read in order by
    one task, so the key is the same on every attempt and no line is ever counted globally.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    key = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.select(key.alias("line_key"), F.col("value").alias("line")).filter(~is_blank(F.col("line")))


def parse_lines(df: DataFrame, on_error: str = "keep") -> DataFrame:
    """Add ``record MAP<STRING, VARIANT>`` (null where the line is no JSON object).

    ``keep`` leaves malformed lines in with a null record, ``skip`` drops them, ``fail``
    stops the job at the first one.
    """
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}, not {on_error!r}")
    record = parse_object(F.col("line"))
    if on_error == "fail":
        message = F.concat(F.lit("malformed JSON line: "), F.col("line"))
        # Blank lines never raise, wherever the optimizer evaluates this.
        failure = F.when(~is_blank(F.col("line")), F.raise_error(message).cast("map<string,variant>"))
        record = F.coalesce(record, failure)
    df = df.withColumn("record", record)
    return df.filter(F.col("record").isNotNull()) if on_error == "skip" else df


def read_jsonl(
    spark: SparkSession, path: str, on_error: str = "keep", on_empty: str = "error"
) -> DataFrame:
    """``line_key, line, record`` of one JSON Lines file or a folder of them."""
    if not path_exists(spark, path):
        raise EmptyInput(f"no such file: {path}")
    return parse_lines(check_not_empty(read_lines(spark, path), path, on_empty), on_error)
