"""Model calls, ledger, sources, sinks, whole stages and the stream."""

from __future__ import annotations

import csv
import io
import json
import os
import time
from email.message import EmailMessage
from pathlib import Path

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from mailspark.operators import ledger as L
from mailspark.operators import model as M
from mailspark.operators import requests as R
from mailspark.operators.mime import parse_mail
from mailspark.plans import stages
from mailspark.sinks.documents import read_documents, write_documents
from mailspark.sinks.jsonl import write_qa
from mailspark.sources.files import EmptyInput, read_mail, read_markdown
from mailspark.sources.jsonl import read_jsonl
from mailspark.streaming.files import mail_stream, run_available

# The clients below travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _asked(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return df.withColumn("messages", R.messages("s", F.col("t")))


def _answers(df):
    return {r["i"]: (r["response"], r["status"], r["attempts"], r["error"]) for r in df.collect()}


def test_call_model_once_per_request(spark, tmp_path):
    log = str(tmp_path / "calls")

    def connect():
        def fn(messages, model, temperature, json_mode):
            with open(log, "a") as f:
                f.write(messages[1]["content"] + "\n")
            return f"{messages[1]['content']}|{model}|{temperature}|{json_mode}"

        return fn

    got = M.call_model(_asked(spark, ["a", "b", "a", "a", "c"]), connect, model="m", json_mode=True, threads=3, dedupe=True)
    assert _answers(got)[3] == ("a|m|0.1|True", "ok", 1, None)
    assert got.count() == 5  # another action, no further calls
    assert sorted(Path(log).read_text().split()) == ["a", "b", "c"]


def test_answer_log_survives_a_killed_run(spark, tmp_path):
    """Each request that was answered before the run died is called once."""
    calls, log, texts = tmp_path / "calls", str(tmp_path / "log"), [f"t{i}" for i in range(40)] + ["t1", "t1"]
    calls.mkdir()

    def connect(last):
        def fn(messages, **_):
            text = messages[1]["content"]
            if text == last:
                raise RuntimeError("killed")
            with open(calls / text, "a") as f:
                f.write("x")
            return text.upper()

        return lambda: fn

    asked = _asked(spark, texts)
    options = {"model": "m", "log": log, "on_error": "fail", "dedupe": True, "waves": 8}
    with pytest.raises(Exception, match="killed"):
        M.call_model(asked, connect("t7"), **options)
    answered = {r["request_hash"]: r["response"] for r in spark.read.parquet(log).collect()} if Path(log).exists() else {}
    before = set(answered.values())
    got = M.call_model(asked, connect(None), **options)
    assert _answers(got) == {i: (x.upper(), "ok", 1, None) for i, x in enumerate(texts)} and "request_hash" not in got.columns
    assert {x for x in before if (calls / x.lower()).read_text() != "x"} == set()
    M.call_model(asked, connect("t7"), **options)  # nothing left to call
    M.call_model(asked, connect(None), **(options | {"model": "n"}))  # another model is another request
    assert len((calls / "t7").read_text()) == 2 and all(len((calls / x).read_text()) >= 2 for x in set(texts))


def test_call_model_in_place(spark, tmp_path):
    log = str(tmp_path / "calls")

    def connect():
        def fn(messages, **_):
            with open(log, "a") as f:
                f.write(messages[1]["content"] + "\n")
            return messages[1]["content"].upper()

        return fn

    got = M.call_model(_asked(spark, ["a", "b", "a"]), connect, model="m", threads=2)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert _answers(got) == {i: (t, "ok", 1, None) for i, t in enumerate("ABA")} and got.count() == 3
    assert sorted(Path(log).read_text().split()) == ["a", "a", "b"]


def test_newest_batch_counts(spark, tmp_path):
    path = str(tmp_path / "table")
    for batch, rows in (("9", [("a", "old"), ("b", "only"), ("c", "one"), ("c", "two")]), ("10", [("a", "new")])):
        write_documents(spark.createDataFrame(rows, "doc_key string, markdown string"), path, batch)
    assert sorted(tuple(r) for r in read_documents(spark, path).collect()) == [("a", "new"), ("b", "only"), ("c", "one"), ("c", "two")]
    none = spark.createDataFrame([], "doc_key string, markdown string")
    write_documents(none, path, "11", retire=spark.createDataFrame([("c",), ("never",)], "doc_key string"))
    assert sorted(tuple(r) for r in read_documents(spark, path).collect()) == [("a", "new"), ("b", "only")]
    with pytest.raises(Exception, match="a row without doc_key"):
        write_documents(spark.createDataFrame([(None, "x")], "doc_key string, markdown string"), path, "12")


def test_retry_timeout_and_errors(spark):
    def connect():
        tries = {}

        def fn(messages, **_):
            text = messages[1]["content"]
            tries[text] = tries.get(text, 0) + 1
            if text == "slow":
                time.sleep(30)
            if text == "flaky" and tries[text] < 3:
                raise ConnectionError("lost")
            if text == "dead":
                raise ConnectionError("lost")
            if text == "refused":
                raise ValueError("no")
            return text

        return fn

    texts = ["fine", "flaky", "dead", "refused", "slow"]
    policy = M.distil_policy(timeout=2.0)
    got = _answers(M.call_model(_asked(spark, texts), connect, model="m", policy=policy, concurrency=1, threads=2))
    assert got[0] == ("fine", "ok", 1, None) and got[1] == ("flaky", "ok", 3, None)
    assert got[2] == (None, "error", 3, "ConnectionError: lost") and got[3] == (None, "error", 1, "ValueError: no")
    assert got[4][1:3] == ("timeout", 1)
    with pytest.raises(Exception, match="model call failed"):
        M.call_model(_asked(spark, ["dead"]), connect, model="m", on_error="fail")


def test_no_rows_no_client(spark):
    def connect():
        raise RuntimeError("must not connect")

    assert M.call_model(_asked(spark, ["a"]).filter("false"), connect, model="m").count() == 0


def test_policy_and_choices():
    assert [M.scrub_policy().wait(n) for n in (1, 2, 3, 7, 9)] == [1.0, 2.0, 4.0, 60.0, 60.0]
    assert M.choose_model(None, " ", "general", "d") == "general" and M.choose_model(None, None, "", "d") == "d"
    with pytest.raises(M.TierError):
        M.check_tier("raw", public_endpoint=True)
    M.check_tier("raw", public_endpoint=False)


def test_pending_knows_content(spark):
    docs = L.with_hash(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "doc_key string, markdown string"), "markdown")
    done = docs.filter("doc_key <> 'd'").withColumn("status", F.expr("CASE doc_key WHEN 'a' THEN 'ok' WHEN 'b' THEN 'error' ELSE 'empty' END"))
    ledger = L.entries(done, "scrub")
    assert {r[0] for r in L.pending(docs, ledger, "scrub").collect()} == {"b", "d"}
    changed = L.with_hash(docs.withColumn("markdown", F.lit("new")), "markdown")
    assert L.pending(changed, ledger, "scrub").count() == 4
    assert L.pending(docs, ledger, "distil").count() == 4
    assert {r[0] for r in L.due(docs, ledger, "scrub", limit=2).collect()} == {"b"}
    assert {r[0] for r in L.due(docs, ledger, "scrub", limit=1, when="after_skip").collect()} == {"b"}
    assert [r[0] for r in L.gate(docs, ledger, "scrub").collect()] == ["a"]


def _write(path: Path, content: bytes):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)


def test_file_sources(spark, tmp_path):
    root = tmp_path / "real"
    _write(root / "a b.eml", b"x")
    _write(root / "sub" / "c%20d.eml", b"y")
    _write(root / "sub" / "note.txt", b"z")
    os.symlink(root, tmp_path / "link")
    got = {(r["doc_key"], r["target_key"], bytes(r["content"])) for r in read_mail(spark, str(tmp_path / "link")).collect()}
    assert got == {("a b.eml", "a b.md", b"x"), ("sub/c%20d.eml", "sub/c%20d.md", b"y")}

    docs = tmp_path / "md"
    _write(docs / "1.md", "ok 你".encode())
    _write(docs / "2.md", b"bad \xff byte")
    _write(docs / "k=1" / "3.md", b"below")
    top = {r["doc_key"]: r["markdown"] for r in read_markdown(spark, str(docs)).collect()}
    assert top == {"1.md": "ok 你", "2.md": "bad � byte"}
    deep = read_markdown(spark, str(docs), recursive=True, on_error="skip").collect()
    assert {r["doc_key"] for r in deep} == {"1.md", "k=1/3.md"}

    (tmp_path / "none").mkdir()
    for missing in ("none", "absent"):
        with pytest.raises(EmptyInput):
            read_markdown(spark, str(tmp_path / missing))
    assert read_markdown(spark, str(tmp_path / "none"), on_empty="empty").count() == 0


def test_jsonl_policies(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a":1}\n\n  \n{"a":\n{"b":"u v"}\r\n[1]\n', encoding="utf-8")
    assert [r["record"] is None for r in read_jsonl(spark, str(path)).orderBy("line_key").collect()] == [False, True, False, True]
    assert read_jsonl(spark, str(path), "skip").count() == 2
    with pytest.raises(Exception, match="malformed JSON line"):
        read_jsonl(spark, str(path), "fail").select(F.size("record")).collect()
    with pytest.raises(EmptyInput):
        read_jsonl(spark, str(tmp_path / "absent"))


def test_line_keys_follow_the_file(spark, tmp_path):
    path = tmp_path / "long.jsonl"
    path.write_text("".join(f'{{"n":{i},"pad":"{"x" * (i % 50)}"}}\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        lines = read_jsonl(spark, str(path))
        assert lines.rdd.getNumPartitions() > 3
        numbers = [r[0] for r in lines.orderBy("line_key").select(F.try_variant_get(F.col("record")["n"], "$", "int")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert numbers == list(range(20_000))


def test_document_batches(spark, tmp_path):
    path = str(tmp_path / "docs")
    frame = lambda *rows: spark.createDataFrame(list(rows), "doc_key string, markdown string")
    write_documents(frame(("a", "1"), ("b", "1")), path, "0001")
    assert read_documents(spark, path).count() == 2
    for _ in range(2):
        write_documents(frame(("b", "2"), ("c", "2")), path, "0002")
    got = {tuple(r) for r in read_documents(spark, path).collect()}
    assert got == {("a", "1"), ("b", "2"), ("c", "2")}
    with pytest.raises(ValueError):
        write_documents(frame(("a", "1")), path, "../x")


def _csv_rows(folder: Path):
    files = sorted(folder.glob("part-*"))
    texts = [f.read_bytes().decode("utf-8") for f in files if f.stat().st_size]
    assert all(t.startswith("﻿") for t in texts)
    tables = [list(csv.reader(io.StringIO(t[1:], newline=""))) for t in texts]
    assert len({tuple(t[0]) for t in tables}) == 1
    return tables[0][0], [row for t in tables for row in t[1:]]


def test_export(spark, tmp_path):
    records = [
        {"file": "a", "category": None, "model": "G1", "issue": "x\ny\r\n", "resolution": 'say "hi", 你', "code_snippet": "", "extra": 1},
        {"k": "p\nq", "file": "b", "flag": True, "n": 3, "nested": {"z": [1, None]}},
        {"resolution": None, "last": "l"},
    ]
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n\n", encoding="utf-8")
    header = stages.export(spark, str(path), str(tmp_path / "out"))
    assert header == ["file", "category", "model", "issue", "resolution", "code_snippet", "k", "flag", "n", "nested", "last"]
    columns, rows = _csv_rows(tmp_path / "out")
    assert columns == header
    assert rows == [
        ["a", "", "G1", "x y", 'say "hi", 你', "", "", "", "", "", ""],
        ["b", "", "", "", "", "", "p q", "True", "3", '{"z":[1,null]}', ""],
        ["", "", "", "", "", "", "", "", "", "", "l"],
    ]
    stages.export(spark, str(path), str(tmp_path / "one"), single_file=True)
    assert len([f for f in (tmp_path / "one").glob("part-*") if f.stat().st_size]) == 1
    path.write_text("{broken\n")
    with pytest.raises(Exception, match="malformed JSON line"):
        stages.export(spark, str(path), str(tmp_path / "bad"))
    path.write_text("\n")
    assert stages.export(spark, str(path), str(tmp_path / "none"), on_empty="empty") == []


def _mail(subject, body):
    message = EmailMessage()
    message["Subject"], message["From"] = subject, "Ann <ann@example.org>"
    message.set_content(body)
    return bytes(message)


def scrub_client():
    def fn(messages, **_):
        text = messages[1]["content"].split(">\n", 1)[1].rsplit("\n</document>", 1)[0]
        return "junk" if "unscrubbable" in text else json.dumps({"markdown": text.replace("ann@example.org", "<EMAIL>")})

    return fn


def distil_client():
    def fn(messages, **_):
        text = messages[1]["content"]
        if "invoice" in text:
            return '{"items": []}'
        return json.dumps({"items": [{"category": "sdk", "issue": "怎么处理？", "resolution": "见 https://drive.google.com/x", "mail": "<EMAIL>" in text}]})

    return fn


def rewrite_client():
    return lambda messages, **_: '{"resolution": "请重启", "category": null}'


def test_convert_reads_only_what_changed(spark, tmp_path):
    """Unchanged files are known by length and time and not read; changed, new and failed ones are."""
    import os

    inbox, md, ledger = tmp_path / "in", str(tmp_path / "md"), str(tmp_path / "ledger")
    for name in ("1.eml", "sub/2 [x].eml", "3{a}.eml", "4.eml", "5.eml"):
        _write(inbox / name, _mail("Subject", f"Body of {name[0]} here"))
    run = lambda batch: {r["doc_key"] for r in stages.convert(spark, str(inbox), md, ledger, batch).collect()}
    texts = lambda: {r["doc_key"]: r["markdown"] for r in read_documents(spark, md).collect()}
    assert run("b1") == {"1.md", "sub/2 [x].md", "3{a}.md", "4.md", "5.md"}
    times = os.stat(inbox / "1.eml")
    _write(inbox / "1.eml", _mail("Subject", "Body of 9 here"))  # as long, and as old: it is not looked at
    os.utime(inbox / "1.eml", ns=(times.st_atime_ns, times.st_mtime_ns))
    assert run("b2") == set() and "Body of 1" in texts()["1.md"]
    _write(inbox / "sub/2 [x].eml", _mail("Subject", "Body changed and longer"))
    os.utime(inbox / "4.eml", ns=(1, 1_700_000_000_000_000_000))  # another time, the content it had: read, not converted
    assert run("b3") == {"sub/2 [x].md"} and "changed" in texts()["sub/2 [x].md"]
    os.utime(inbox / "1.eml", ns=(1, 1_700_000_000_000_000_000))
    _write(inbox / "6.eml", _mail("Subject", "New"))
    assert run("b4") == {"1.md", "6.md"} and "Body of 9" in texts()["1.md"]
    assert run("b5") == set() and len(texts()) == 6
    listed = L.read_ledger(spark, ledger).where("stage = 'listed'").groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in listed} == {"1.md": 2, "sub/2 [x].md": 2, "3{a}.md": 1, "4.md": 2, "5.md": 1, "6.md": 1}


def test_stream_and_convert_agree(spark, tmp_path):
    """One folder through both gives equal tables and ledgers; a replayed batch adds nothing."""
    inbox = tmp_path / "in"
    for name in ("1.eml", "sub/2.eml", "3.eml"):
        _write(inbox / name, _mail("Subject", f"Body of {name}"))
    paths = {n: (str(tmp_path / n / "md"), str(tmp_path / n / "ledger")) for n in ("batch", "stream")}

    def both(batch, checkpoint="check"):
        stages.convert(spark, str(inbox), *paths["batch"], batch)
        stages.convert_stream(spark, str(inbox), *paths["stream"], str(tmp_path / checkpoint), files_per_trigger=2)
        found = []
        for md, ledger in paths.values():
            book = L.read_ledger(spark, ledger).select("stage", "key", "input_hash", "status").collect()
            found.append((sorted(map(tuple, read_documents(spark, md).collect())), sorted(map(tuple, book))))
        assert found[0] == found[1]
        return found[0]

    docs, book = both("b1")
    assert len(docs) == 3 and len(book) == 6
    assert both("b1") == (docs, book)  # run again under its name: replaced, not emptied
    _write(inbox / "4.eml", _mail("Subject", "Body of 4"))
    more, longer = both("b2")
    assert len(more) == 4 and len(longer) == 8
    stages.convert_stream(spark, str(inbox), *paths["stream"], str(tmp_path / "lost"), name="again")  # its checkpoint is lost
    assert sorted(map(tuple, read_documents(spark, paths["stream"][0]).collect())) == more
    _write(inbox / "1.eml", _mail("Subject", "Another body"))  # the stream has seen this path; convert finds it
    assert [r["doc_key"] for r in stages.convert(spark, str(inbox), *paths["stream"], "turn").collect()] == ["1.md"]


def test_mail_to_csv(spark, tmp_path):
    """All stages in a row, run twice: the second run finds only the new mail."""
    inbox, ledger = tmp_path / "in", str(tmp_path / "ledger")
    _write(inbox / "1.eml", _mail("Driver", "It crashes."))
    _write(inbox / "sub" / "2.eml", _mail("Bill", "Where is the invoice?"))
    _write(inbox / "3.eml", _mail("Odd", "unscrubbable"))
    md, clean, qa, final = (str(tmp_path / n) for n in ("md", "clean", "qa", "final"))

    def run(batch):
        stages.convert(spark, str(inbox), md, ledger, batch)
        scrubbed = stages.scrub(spark, read_documents(spark, md), scrub_client, "s", clean, ledger, batch, model="m")
        distilled = stages.distil(spark, read_documents(spark, clean), distil_client, "s", qa, ledger, batch, model="m")
        rewritten = stages.rewrite(spark, read_documents(spark, qa, key="file"), rewrite_client, "s", final, ledger, batch, model="m")
        return [None if d is None else d.count() for d in (scrubbed, distilled, rewritten)]

    assert run("b1") == [3, 2, 1]
    assert {r["doc_key"] for r in read_documents(spark, md).collect()} == {"1.md", "sub/2.md", "3.md"}
    assert {r["doc_key"] for r in read_documents(spark, clean).collect()} == {"1.md", "sub/2.md"}
    record = json.loads(read_documents(spark, final).first()["line"])
    assert record == {"file": "1.md", "category": None, "model": None, "issue": "怎么处理？", "resolution": "请重启", "code_snippet": ""}

    _write(inbox / "4.eml", _mail("New", "Again."))
    # The bad answer is tried again, the mail without records is not.
    assert run("b2") == [2, 1, 1]
    status = {(r["stage"], r["status"]): r["n"] for r in L.read_ledger(spark, ledger).groupBy("stage", "status").agg(F.count("*").alias("n")).collect()}
    assert status[("convert", "ok")] == 4 and status[("scrub", "ok")] == 3 and status[("scrub", "bad_json")] == 2
    assert status[("distil", "ok")] == 2 and status[("distil", "no_items")] == 1 and status[("rewrite", "rewritten")] == 2

    lines = str(tmp_path / "lines")
    read_documents(spark, final).select("line").write.text(lines)
    assert stages.export(spark, lines, str(tmp_path / "csv")) == ["file", "category", "model", "issue", "resolution", "code_snippet"]
    assert len(_csv_rows(tmp_path / "csv")[1]) == 2


def test_qa_sink_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("f", None, None, "你\n", None, "")], "file string, category string, model string, issue string, resolution string, code_snippet string")
    write_qa(df, str(tmp_path / "qa"))
    write_qa(df, str(tmp_path / "qa"))
    text = "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "qa").glob("part-*"))
    assert text == '{"file":"f","category":null,"model":null,"issue":"你\\n","resolution":null,"code_snippet":""}\n' * 2


def test_stream_takes_each_mail_once(spark, tmp_path):
    inbox, sink, checkpoint = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "cp")
    _write(inbox / "1.eml", _mail("one", "x"))

    def run():
        run_available(mail_stream(spark, str(inbox)), lambda s: parse_mail(s).select("doc_key", "subject"), sink, checkpoint)
        return sorted(r["subject"] for r in spark.read.parquet(sink).collect())

    assert run() == ["one"]
    _write(inbox / "sub" / "2.eml", _mail("two", "y"))
    assert run() == ["one", "two"]
    assert run() == ["one", "two"]
    assert sorted(r["doc_key"] for r in spark.read.parquet(sink).collect()) == ["1.md", "sub/2.md"]


def test_a_hanging_call_holds_up_no_later_batch(spark):
    """Each batch has a call that hangs; the other threads go on with the batches behind it."""

    def connect():
        def fn(messages, **_):
            text = messages[1]["content"]
            if int(text) % 10 == 0:
                time.sleep(30)
            return text

        return fn

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        begun = time.time()
        got = _answers(M.call_model(_asked(spark, [str(i) for i in range(100)]).coalesce(1), connect, model="m", policy=M.CallPolicy(timeout=2.0), threads=10))
        assert time.time() - begun < 15  # one batch after the other: 20 seconds at least
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [got[i][1] for i in range(100)] == ["timeout" if i % 10 == 0 else "ok" for i in range(100)]
    assert [got[i][0] for i in range(100)] == [None if i % 10 == 0 else str(i) for i in range(100)]
