"""New files since the last run, as a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.sources.files import file_stamp, mail_key


def mail_stream(spark: SparkSession, root: str, glob: str = "*.eml", files_per_trigger: int = 10_000, stamps: bool = False) -> DataFrame:
    """Mail files as a stream of ``doc_key, content``, with the keys that ``stages.convert`` gives; with ``stamps`` also
    ``stamp``, length and time of the last change as ``list_mail`` spells them."""
    stamp = [file_stamp().alias("stamp")] if stamps else []
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(root)
        .select(mail_key(spark, F.col("path"), root, glob).alias("doc_key"), "content", *stamp)
    )


def table_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1_000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_available(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str
) -> None:
    """Process all files that have arrived since the last run, then stop.

    The checkpoint remembers which files are done and the file sink commits a batch as a
    whole, so each file is in the result exactly once, also after a crash.
    """
    query = (
        transform(source)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()


def run_batches(source: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand all that has arrived since the last run to ``each``, batch by batch with its number, then stop.

    A batch whose end the checkpoint has not seen is handed over again with the same number."""
    query = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
