"""Files on disk: listed and read by tasks, the same files that Spark's own scan reads."""

from __future__ import annotations

import os

import pytest

from mailspark.sources import disk
from mailspark.sources.files import EmptyInput, read_files, read_mail, read_markdown

NAMES = [
    "a.md", "empty.md", "_h.md", "_k=1.md", ".dot.md", "x._COPYING_", "_metadata.md", "_d/in.md", "_k=2/in.md", "_metadata_d/in.md", ".d/in.md",
    "s/t/u/v.md", "é/ü.md", "c%20 d.md", "x{1}.md", "b.MD", "s/b1.md", "s/b2.md", "s/b^.md",
]


def _write(root, name: str, content: bytes) -> None:
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(content)


def _rows(df) -> list[tuple[str, bytes]]:
    return sorted((r["doc_key"], bytes(r["content"])) for r in df.collect())


@pytest.fixture
def tree(tmp_path):
    """More sub-folders than one task goes into by itself, files at all depths."""
    names = ["top.txt", *(f"doc={i}/part.txt" for i in range(2 * disk.GO_ON + 100)), *(f"deep/{i}/{j}/x.txt" for i in range(3) for j in range(4))]
    for name in names:
        _write(tmp_path, name, name.encode())
    return str(tmp_path), names


def test_the_driver_holds_no_files_of_a_markdown_folder(spark, tree):
    root, names = tree
    docs = read_markdown(spark, root, recursive=True, glob="*.txt")
    assert sorted(map(tuple, docs.collect())) == sorted((n, n) for n in names)
    # Spark's scan has every file in its plan; here there is the list alone, in a few files for each of two or three rounds.
    assert len(docs.inputFiles()) <= 3 * spark.sparkContext.defaultParallelism
    assert not [f for f in docs.inputFiles() if f.endswith(".txt")]
    assert [tuple(r) for r in read_markdown(spark, root, glob="*.txt").collect()] == [("top.txt", "top.txt")]


def test_which_files_count_is_as_in_the_scan_of_spark(spark, tmp_path):
    root = str(tmp_path)
    for name in NAMES:
        _write(root, name, b"" if name == "empty.md" else name.encode())
    with open(os.path.join(os.fsencode(root), b"bad\xff.md"), "wb") as file:
        file.write(b"x")
    for link, to in {"link.md": "a.md", "broken.md": "nowhere", "s2": "s", "s/loop": "."}.items():
        os.symlink(to, os.path.join(root, link))
    for glob in ("*.md", "{a,link}.md", "b[12].md", "b[^1].md", "b[!1].md", "?.md", "*", r"x\{1\}.md"):
        plain = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
        plain = sorted((r["path"].removeprefix(f"file:{root}/"), bytes(r["content"])) for r in plain.collect())
        assert plain and _rows(read_files(spark, root, glob, recursive=True)) == plain
        assert _rows(read_files(spark, root, glob, recursive=False, on_empty="empty")) == [r for r in plain if "/" not in r[0]]
    with pytest.raises(EmptyInput):
        read_files(spark, root, "*.none", recursive=True)


def test_checksums_are_held_against_files(spark, tmp_path):
    root = str(tmp_path / "sink")
    spark.range(3).selectExpr("repeat(concat('text ', id), 300) value").coalesce(1).write.text(root)
    assert len(_rows(read_files(spark, root, "*.txt", recursive=True))[0][1]) == 3 * (300 * 6 + 1)
    (name,) = (n for n in os.listdir(root) if n.endswith(".txt"))
    with open(os.path.join(root, name), "r+b") as file:
        file.seek(600)
        file.write(b"#")
    with pytest.raises(Exception, match="checksum"):
        read_files(spark, root, "*.txt", recursive=True).collect()


def test_files_that_go_after_the_listing(spark, tmp_path):
    for name in ("a.md", "b.md"):
        _write(tmp_path, name, name.encode())
    setting = "spark.sql.files.ignoreMissingFiles"
    strict = read_files(spark, str(tmp_path), "*.md", recursive=True)
    spark.conf.set(setting, "true")
    try:
        lenient = read_files(spark, str(tmp_path), "*.md", recursive=True)
    finally:
        spark.conf.unset(setting)
    os.remove(tmp_path / "a.md")
    assert _rows(lenient) == [("b.md", b"b.md")]
    with pytest.raises(Exception, match="a.md"):
        strict.collect()
    assert strict.count() == 2  # of the list: no file is read where no content is asked for


def test_few_bytes_are_held_at_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(disk, "HELD", 10)
    names = {f"{i}.md": b"x" * (i % 7 * 4 + 1) for i in range(60)}
    for name, content in names.items():
        _write(tmp_path, name, content)
    assert _rows(read_files(spark, str(tmp_path), "*.md", recursive=False)) == sorted(names.items())


def test_the_driver_holds_no_files_of_a_mail_folder(spark, tree):
    root, names = tree
    mails = read_mail(spark, root, glob="*.txt")
    assert sorted((r["doc_key"], r["target_key"], bytes(r["content"])) for r in mails.collect()) == sorted(
        (n, n.removesuffix(".txt") + ".md", n.encode()) for n in names
    )
    assert not [f for f in mails.inputFiles() if f.endswith(".txt")]


def test_tasks_grow_with_files_and_bytes_not_with_a_cost_per_file(spark, tmp_path):
    files = spark.range(10).selectExpr("concat('f', id) path", "id length")
    tasks = lambda number, size: disk.deal(files, number, size).rdd.getNumPartitions()
    cores, most = spark.sparkContext.defaultParallelism, 128 << 20
    assert [tasks(0, 0), tasks(1, 5), tasks(2_000, 5)] == [1, 1, cores]
    assert tasks(100 * disk.FILES, 5) == 100 and tasks(5_000, 50 * most) == 50
