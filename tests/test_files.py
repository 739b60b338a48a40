"""Folders of many small files: written, listed and read without a cost per file that is not the file's."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from mailspark.session import configure
from mailspark.sinks.documents import _write_files, export_folder
from mailspark.sources.files import check_not_empty, read_markdown

ROWS = [("b", "one\n"), ("a/1", "é\n\n"), ("b", None), ("x=%:\t'", "three"), ("", "four"), (None, "five"), ("A b", "six\nseven"), ("b", "")]


def _found(root) -> dict[str, list[bytes]]:
    """Texts by folder, hidden files and marks left out."""
    found = {}
    for folder, _, names in os.walk(root):
        for name in sorted(n for n in names if n.endswith(".txt")):
            with open(os.path.join(folder, name), "rb") as file:
                found.setdefault(os.path.relpath(folder, root), []).append(file.read())
    return found


def test_export_folder_equals_the_text_sink(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_key string, markdown string").coalesce(1)
    plain = docs.select(F.col("doc_key").alias("doc"), F.regexp_replace("markdown", r"\n\z", "").alias("value"))
    plain.write.partitionBy("doc").text(str(tmp_path / "plain"))
    for _ in range(2):  # the second takes the place of the first
        export_folder(docs, str(tmp_path / "own"))
    own = _found(tmp_path / "own")
    assert own == _found(tmp_path / "plain") and len(own) == 5
    assert sorted(os.listdir(tmp_path)) == ["own", "plain"] and (tmp_path / "own" / "_SUCCESS").exists()
    # Beside each file of the sink lies a checksum; for either a process was started to set permissions.
    assert not [name for _, _, names in os.walk(tmp_path / "own") for name in names if name.endswith(".txt.crc")]
    export_folder(docs.withColumn("doc_key", F.lit(7)), str(tmp_path / "own"))
    assert list(_found(tmp_path / "own")) == ["doc=7"]


def test_a_failed_export_leaves_what_was_there(spark, tmp_path):
    export_folder(spark.createDataFrame([("a", "old")], "doc_key string, markdown string"), str(tmp_path / "own"))
    bad = spark.range(4).selectExpr("concat('a', id) doc", "encode(if(id = 3, raise_error('no'), 'new'), 'UTF-8') value")
    with pytest.raises(Exception, match="no"):
        _write_files(bad, str(tmp_path / "own"))
    assert _found(tmp_path) == {"own/doc=a": [b"old\n"]} and os.listdir(tmp_path) == ["own"]


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    docs = spark.range(200).selectExpr("cast(id as string) doc_key", "concat('t', id) markdown")
    export_folder(docs, str(tmp_path / "own"))
    tasks = int(configure(spark).conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism"))
    assert tasks <= max(64, 4 * spark.sparkContext.defaultParallelism)
    read = read_markdown(spark, str(tmp_path / "own"), recursive=True, glob="*.txt")
    assert sorted(r["markdown"] for r in read.collect()) == sorted(f"t{i}\n" for i in range(200))


def test_the_look_for_a_row_does_not_start_all_tasks(spark):
    sc = spark.sparkContext
    sc.setJobGroup("look", "look")
    check_not_empty(spark.range(0, 1000, 1, 100), "rows")
    tracker = sc.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("look") for s in tracker.getJobInfo(job).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) < 20
