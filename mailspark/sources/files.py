"""File scans: mail and Markdown, one row per file."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.sources import disk


class EmptyInput(ValueError):
    """The input folder or file is missing or holds no rows."""


def check_not_empty(df: DataFrame, what: str, on_empty: str = "error") -> DataFrame:
    """``on_empty="error"`` raises where there is nothing to do, ``"empty"`` passes on."""
    # Partitions are looked at until one has a row, without any column; isEmpty() starts them all.
    if on_empty == "error" and not df.select(F.lit(1).alias("one")).take(1):
        raise EmptyInput(f"no input: {what}")
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _resolved(spark: SparkSession, root: str) -> str:
    """The root as the scan will spell it, symbolic links of a local root resolved."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        return "file:" + os.path.realpath(fs.makeQualified(path).toUri().getPath())
    return fs.makeQualified(path).toString()


def _relative(path: Column, root: str) -> Column:
    """The path below the root; the scan spells local paths ``file:/x`` or ``file:///x``."""
    spelled = F.regexp_replace(path, "^file:/+", "file:/")
    return F.substr(spelled, F.lit(len(root.rstrip("/")) + 2))


def read_files(
    spark: SparkSession, root: str, glob: str, recursive: bool, on_empty: str = "error"
) -> DataFrame:
    """``doc_key, content`` of all files below ``root`` that match ``glob``.

    ``doc_key`` is the path relative to the root.  Content is binary.  On a local or mounted disk tasks list
    and read the files (see ``sources.disk``); elsewhere Spark's own scan does, where many small files share one
    partition (``spark.sql.files.openCostInBytes`` governs how many).
    """
    if not path_exists(spark, root):
        raise EmptyInput(f"no such folder: {root}")
    root = _resolved(spark, root)
    if root.startswith("file:") and os.path.isdir(root.removeprefix("file:")):
        return _read_disk(spark, root.removeprefix("file:"), glob, recursive, on_empty)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    df = files.load(root)
    if not recursive:
        # By the metadata column, so that files further below are left out before they are read.
        depth = root.rstrip("/").removeprefix("file:").count("/") + 1
        spelled = F.regexp_replace("_metadata.file_path", "^file:/+", "/")
        df = df.filter(F.regexp_count(spelled, F.lit("/")) == depth)
    df = df.select(_relative(F.col("path"), root).alias("doc_key"), "content")
    return check_not_empty(df, f"{glob} in {root}", on_empty)


def _read_disk(spark: SparkSession, root: str, glob: str, recursive: bool, on_empty: str) -> DataFrame:
    """``read_files`` below a folder on disk, under Spark's settings for files that are gone or cannot be read."""
    missing, corrupt = (spark.conf.get(f"spark.sql.files.ignore{kind}Files") == "true" for kind in ("Missing", "Corrupt"))
    files, number, size = disk.list_files(spark, root, glob, recursive, missing)
    check_not_empty(files, f"{glob} in file:{root}", on_empty)
    content = disk.content(F.col("path"), missing, corrupt).alias("content")
    df = disk.deal(files, number, size).select(_relative(F.col("path"), root).alias("doc_key"), content)
    return df.filter("content IS NOT NULL") if missing or corrupt else df


def read_mail(
    spark: SparkSession, root: str, glob: str = "*.eml", on_empty: str = "error"
) -> DataFrame:
    """All mail files below ``root``, sub-folders included: ``doc_key, target_key, content``.

    ``target_key`` is the key of the Markdown document made from it.
    """
    df = read_files(spark, root, glob, recursive=True, on_empty=on_empty)
    return df.withColumn("target_key", target_key(F.col("doc_key"), glob)).select("doc_key", "target_key", "content")


def list_mail(spark: SparkSession, root: str, glob: str = "*.eml", on_empty: str = "error") -> DataFrame:
    """The same files without their content, which is not read: ``path, doc_key`` (of the Markdown document), ``stamp``
    (length and time of the last change)."""
    if not path_exists(spark, root):
        raise EmptyInput(f"no such folder: {root}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(_resolved(spark, root))
    df = files.select("path", mail_key(spark, F.col("path"), root, glob).alias("doc_key"), file_stamp().alias("stamp"))
    return check_not_empty(df, f"{glob} in {root}", on_empty)


def file_stamp() -> Column:
    """Length and time of the last change of a scanned file."""
    return F.concat_ws("@", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))


def read_listed(spark: SparkSession, root: str, paths: list[str], glob: str = "*.eml") -> DataFrame:
    """``doc_key, content`` of the files at ``paths`` (as ``list_mail`` spells them) alone."""
    named = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]  # signs of patterns in file names
    files = spark.read.format("binaryFile").load(named)
    return files.select(mail_key(spark, F.col("path"), root, glob).alias("doc_key"), "content")


def target_key(key: Column, glob: str) -> Column:
    """The key of the Markdown document made from a mail file."""
    extension = glob.rpartition("*")[2]
    return F.concat(F.regexp_replace(key, r"\Q" + extension + r"\E$", ""), F.lit(".md"))


def mail_key(spark: SparkSession, path: Column, root: str, glob: str) -> Column:
    """The same key from a scanned path, for streams of files."""
    return target_key(_relative(path, _resolved(spark, root)), glob)


def read_markdown(
    spark: SparkSession,
    root: str,
    recursive: bool = False,
    on_error: str = "replace",
    glob: str = "*.md",
    on_empty: str = "error",
) -> DataFrame:
    """Markdown files as ``doc_key, markdown``."""
    df = read_files(spark, root, glob, recursive, on_empty)
    return decode_text(df, "content", on_error).withColumnRenamed("content", "markdown")


def decode_text(df: DataFrame, col: str, on_error: str = "replace") -> DataFrame:
    """Binary to text: bad bytes become U+FFFD (``replace``) or cost the row (``skip``)."""
    raw = F.col(col).cast("string")
    if on_error == "replace":
        return df.withColumn(col, F.make_valid_utf8(raw))
    if on_error == "skip":
        return df.filter(F.is_valid_utf8(raw)).withColumn(col, raw)
    raise ValueError(f"on_error must be 'replace' or 'skip', not {on_error!r}")
