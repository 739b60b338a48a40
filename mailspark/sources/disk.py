"""Files on a local or mounted disk, listed and read by tasks.

Spark's own scan keeps every file's status on the driver and a task for every few files, about 1 KB a file; here the
driver gets counts alone.  Which files count is the same: hidden and empty ones do not."""

from __future__ import annotations

import errno
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.session import work_dir

#: Sub-folders that a listing task goes into by itself; those it finds beyond are dealt to other tasks.
GO_ON = 1_000
#: Files that one task reads, and bytes of them that it holds at once (one file more, at most).
FILES, HELD = 10_000, 4 << 20
_LISTED = "path string, length long"


def _hidden(name: str) -> bool:
    """As in Spark's listing, which also leaves out names that are not UTF-8."""
    if (name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))) or name.startswith(".") or name.endswith("._COPYING_"):
        return True
    return not name.isascii() and any("\ud800" <= c <= "\udfff" for c in name)


def _entries(folder: str, missing: bool) -> Iterator[tuple[str, str, int]]:
    """``name, path, length`` of what counts in a folder, length -1 for sub-folders.  Links are followed.  With
    ``missing`` a folder that is gone is an empty one."""
    try:
        found = os.scandir(folder)
    except FileNotFoundError:
        if missing:
            return
        raise
    with found:
        for entry in found:
            if _hidden(entry.name):
                continue
            try:
                if entry.is_dir():
                    yield entry.name, entry.path, -1
                elif entry.is_file() and not (entry.name.startswith("_") and "=" not in entry.name) and (length := entry.stat().st_size):
                    yield entry.name, entry.path, length
            except OSError as error:  # gone meanwhile, or a link that leads nowhere
                if error.errno not in (errno.ENOENT, errno.ELOOP):
                    raise


def list_files(spark: SparkSession, folder: str, glob: str, recursive: bool, missing: bool = False) -> tuple[DataFrame, int, int]:
    """``path, length`` of the files in a folder whose names match, their number and bytes; kept in the work folder.

    The entries of one folder are listed by one task, as a stream.  Every round lists the folders that the round
    before has left, dealt over all cores, until none is left: a tree of few folders takes one round."""
    wanted = re.compile(spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern(), re.DOTALL)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, rows = GO_ON, []
        for start in chain.from_iterable(batch["path"] for batch in batches):
            todo = [start]
            while todo:
                for name, path, length in _entries(todo.pop(), missing):
                    if length >= 0:
                        if wanted.fullmatch(name):
                            rows.append((path, length))
                    elif recursive and left:
                        left -= 1
                        todo.append(path)
                    elif recursive:
                        rows.append((path, length))
                    if len(rows) == FILES:
                        yield pd.DataFrame(rows, columns=["path", "length"])
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["path", "length"])

    kept, cores = work_dir(spark, "listed"), spark.sparkContext.defaultParallelism
    due, rounds, files, size = spark.createDataFrame([(folder,)], "path string"), 0, 0, 0
    while True:
        at = f"{kept}/round={rounds}"
        due.mapInPandas(walk, _LISTED).repartition(cores).write.parquet(at)
        found = spark.read.schema(_LISTED).parquet(at)
        more, new, length = found.selectExpr("count_if(length < 0)", "count_if(length > 0)", "sum(greatest(length, 0))").first()
        rounds, files, size = rounds + 1, files + new, size + (length or 0)
        if not more:
            break
        due = found.filter("length < 0").select("path")
    return spark.read.schema(_LISTED).parquet(kept).filter("length > 0").select("path", "length"), files, size


def deal(files: DataFrame, number: int, size: int) -> DataFrame:
    """Listed files over as many tasks as their number and bytes ask for, all cores at least."""
    spark = files.sparkSession
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return files.repartition(max(1, min(number, max(spark.sparkContext.defaultParallelism, -(-number // FILES), -(-size // most)))))


def content(path: Column, missing: bool = False, corrupt: bool = False) -> Column:
    """The bytes of the file at each path; null where it is gone or cannot be read, if that is to be passed over."""

    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            held, size = [], 0
            for name in batch.to_pylist():
                try:
                    held.append(_read(name))
                    size += len(held[-1])
                except OSError as error:
                    if not (missing if isinstance(error, FileNotFoundError) else corrupt):
                        raise
                    held.append(None)
                if size >= HELD:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            if held:
                yield pa.array(held, pa.binary())

    # A file may change: read once per row, by no filter ahead.
    return F.arrow_udf(read, "binary").asNondeterministic()(path)


def _read(path: str) -> bytes:
    """A whole file, held against the checksums that Hadoop's local files have beside them."""
    with open(path, "rb") as file:
        data = file.read()
    folder, name = os.path.split(path)
    try:
        with open(f"{folder}/.{name}.crc", "rb") as file:
            sums = file.read()
    except FileNotFoundError:
        return data
    if sums[:4] == b"crc\0":
        step = int.from_bytes(sums[4:8])
        if sums[8:] != b"".join(zlib.crc32(data[i : i + step]).to_bytes(4) for i in range(0, len(data), step)):
            raise OSError(f"checksum error: {path}")
    return data
