"""The five stages as one call each, resumable through the ledger.

Every stage reads what is due (an anti join before anything expensive), writes its result
as one batch, then the ledger rows of that batch.  A job that dies in between is run again
with the same batch name and replaces what it left; the answers of models that it has
already got are taken from the batch's answer log, beside the ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.operators import ledger as L
from mailspark.operators import model as M
from mailspark.operators.markdown import project_headers, to_markdown
from mailspark.operators.mime import best_body, parse_mail
from mailspark.operators.requests import distil_request, rewrite_request, scrub_request
from mailspark.operators.responses import extract_items, explode_items, merge_record, qa_records, scrubbed_text
from mailspark.operators.tabular import column_list, tabular_rows, to_table
from mailspark.session import materialise
from mailspark.sinks.csv import write_csv
from mailspark.sinks.documents import read_documents, write_documents
from mailspark.sources.files import list_mail, path_exists, read_listed, read_mail
from mailspark.sources.jsonl import parse_lines, read_jsonl
from mailspark.streaming.files import mail_stream, run_batches


def mail_to_markdown(mails: DataFrame, **flags) -> DataFrame:
    """Raw mails (``doc_key, content``) to ``doc_key, status, error, markdown``."""
    parsed = to_markdown(project_headers(best_body(parse_mail(mails))), **flags)
    failed = F.col("parse_error").isNotNull()
    keys = [c for c in mails.columns if c != "content"]
    return parsed.select(
        *keys,
        F.when(failed, "error").otherwise("ok").alias("status"),
        F.col("parse_error").alias("error"),
        F.when(~failed, F.col("markdown")).alias("markdown"),
    )


def _answer_log(ledger: str, stage: str, batch: str) -> str:
    """Where a batch keeps the answers that it has paid for."""
    return f"{ledger.rstrip('/')}-answers/{stage}-{batch}"


def _finish(df: DataFrame, spark: SparkSession, stage: str, batch: str, out: str, ledger: str, keep=("ok",)) -> DataFrame:
    """Write a stage's documents and its ledger rows from one materialised result."""
    done = materialise(df)
    write_documents(done.filter(F.col("status").isin(*keep)).select("doc_key", "markdown"), out, batch)
    L.write_entries(L.entries(done, stage), ledger, f"{stage}-{batch}")
    return done


def convert(spark: SparkSession, root: str, out: str, ledger: str, batch: str, overwrite: bool = False, **flags) -> DataFrame:
    """Mail files below ``root`` to Markdown documents.

    Files are listed first, without their content.  One whose length and time of change are in the
    ledger (stage ``listed``) is not read; one that is read, but has the content it had, is not
    converted.  Files that failed are due again.  The driver, which lists them anyway, names the files to
    read; where that is more than half, the folder is read as a whole."""
    book = _book(spark, ledger, batch)
    files = list_mail(spark, root).withColumnRenamed("stamp", "input_hash")
    total = files.count()
    files = materialise(L.pending(files, book, "listed", overwrite=overwrite))
    paths = [r["path"] for r in files.select("path").limit(total // 2 + 1).collect()]
    if 2 * len(paths) > total:
        mails = read_mail(spark, root).select(F.col("target_key").alias("doc_key"), "content").join(files.select("doc_key"), "doc_key", "left_semi")
    elif paths:
        mails = read_listed(spark, root, paths)
    else:
        mails = spark.createDataFrame([], "doc_key string, content binary")
    return _converted(spark, files, mails, out, ledger, batch, overwrite, **flags)


def _book(spark: SparkSession, ledger: str, batch: str) -> DataFrame:
    """What other batches have done: a batch that is run again is done from the start."""
    own = [f"{stage}-{batch}" for stage in ("convert", "listed")]
    return L.read_ledger(spark, ledger, with_batch=True).filter(~F.col("batch").isin(*own)).drop("batch")


def _converted(spark, files: DataFrame, mails: DataFrame, out: str, ledger: str, batch: str, overwrite: bool = False, **flags) -> DataFrame:
    """Convert ``mails`` (``doc_key, content``) whose content is new, and enter ``files`` (``doc_key, input_hash``) as seen."""
    book = _book(spark, ledger, batch)
    mails = L.pending(L.with_hash(mails, "content"), book, "convert", overwrite=overwrite)
    done = _finish(mail_to_markdown(mails, **flags), spark, "convert", batch, out, ledger)
    failed = done.filter(~F.col("status").isin(*L.CLOSING)).select("doc_key")
    seen = files.join(failed, "doc_key", "left_anti").withColumn("status", F.lit("ok"))
    L.write_entries(L.entries(seen, "listed"), ledger, f"listed-{batch}")
    return done


def convert_stream(
    spark: SparkSession, root: str, out: str, ledger: str, checkpoint: str, name: str = "stream", files_per_trigger: int = 10_000, **flags
) -> None:
    """``convert`` for the files that have arrived since the last run, in micro-batches, then stop.

    Each micro-batch is a batch of the document table and of the ledger, named after its number, so that one
    that is replayed after a crash replaces what it left and adds nothing.  A stream knows a file by its path, so
    it sees new files alone; ``convert`` may take turns with it over one folder and finds the changed
    ones, since both skip what the ledger knows.
    """

    def one(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        files = materialise(batch.select("doc_key", F.col("stamp").alias("input_hash")))
        due = L.pending(files, _book(session, ledger, f"{name}-{number}"), "listed").select("doc_key")
        mails = batch.select("doc_key", "content").join(due, "doc_key", "left_semi")
        _converted(session, files, mails, out, ledger, f"{name}-{number}", **flags)

    run_batches(mail_stream(spark, root, files_per_trigger=files_per_trigger, stamps=True), one, checkpoint)


def scrub(
    spark: SparkSession, documents: DataFrame, connect, system: str, out: str, ledger: str, batch: str,
    overwrite: bool = False, limit: int | None = None, **call,
) -> DataFrame | None:
    """Markdown documents through the scrub model; only good answers become documents."""
    due = materialise(L.due(L.with_hash(documents, "markdown"), L.read_ledger(spark, ledger), "scrub", limit=limit, overwrite=overwrite))
    if L.nothing_due(due):
        return None
    call = {"policy": M.scrub_policy(), "json_mode": True, "tier": "raw", "public_endpoint": False} | call
    call = {"log": None if overwrite else _answer_log(ledger, "scrub", batch)} | call
    answered = M.call_model(scrub_request(due, system), connect, **call)
    answered = answered.withColumnRenamed("status", "call_status").drop("markdown", "messages")
    result = scrubbed_text(answered)
    result = result.withColumn("status", F.when(F.col("call_status") == "ok", F.col("status")).otherwise(F.col("call_status")))
    done = _finish(result, spark, "scrub", batch, out, ledger)
    clean = L.with_hash(done.filter(F.col("status") == "ok"), "markdown")  # what may pass, by its text
    L.write_entries(L.entries(clean, "scrubbed"), ledger, f"scrubbed-{batch}")
    return done


def distil(
    spark: SparkSession, documents: DataFrame, connect, system: str, out: str, ledger: str, batch: str,
    limit: int | None = None, when: str = "before_skip", **call,
) -> DataFrame | None:
    """Scrubbed documents through the distil model to QA records.  Texts that did not come out of
    the scrub, word for word and under their key, never get here: raw text under a key that has passed
    has another hash."""
    book = L.read_ledger(spark, ledger)
    passed = L.gate(L.with_hash(documents.select("doc_key", "markdown"), "markdown"), book, "scrubbed")
    due = materialise(L.due(passed, book, "distil", limit=limit, when=when))
    if L.nothing_due(due):
        return None
    call = {"policy": M.distil_policy(), "tier": "scrubbed", "log": _answer_log(ledger, "distil", batch)} | call
    answered = M.call_model(distil_request(due, system), connect, **call).drop("markdown", "messages")
    listed = extract_items(answered.withColumnRenamed("status", "call_status"))
    status = F.when(F.col("call_status") == "ok", F.col("status")).otherwise(F.col("call_status"))
    done = materialise(listed.withColumn("status", status))
    # A document that gives no item any more ends the items of its former version.
    without = done.filter(F.col("status").isin("empty", "no_items")).select(F.col("doc_key").alias("file"))
    write_documents(qa_records(explode_items(done)), out, batch, key="file", retire=without)
    L.write_entries(L.entries(done, "distil"), ledger, f"distil-{batch}")
    return done


def rewrite(
    spark: SparkSession, qa: DataFrame, connect, system: str, out: str, ledger: str, batch: str,
    limit: int | None = None, resume: bool = True, **call,
) -> DataFrame | None:
    """QA records through the rewrite model; a record without a usable answer stays as it is."""
    key = F.concat_ws("#", "file", F.col("item_no").cast("string"))
    record = F.to_json(F.struct(*[c for c in qa.columns if c != "item_no"]), {"ignoreNullFields": "false"})
    keyed = L.with_hash(qa.withColumn("doc_key", key).withColumn("line", record), "line")
    due = materialise(L.due(keyed, L.read_ledger(spark, ledger), "rewrite", limit=limit, when="after_skip", overwrite=not resume))
    gone = None
    if path_exists(spark, out):  # items whose document does not give them any more
        gone = read_documents(spark, out).select("doc_key").join(keyed.select("doc_key"), "doc_key", "left_anti")
        gone = materialise(gone)
    if L.nothing_due(due) and (gone is None or gone.isEmpty()):
        return None
    call = {"policy": M.rewrite_policy(), "json_mode": True, "log": _answer_log(ledger, "rewrite", batch) if resume else None} | call
    answered = M.call_model(rewrite_request(due, system), connect, **call).withColumnRenamed("status", "call_status")
    merged = merge_record(parse_lines(answered.drop("messages")))
    merged = merged.select("doc_key", "file", "item_no", "input_hash", "attempts", "error", "status", F.to_json("record").alias("line"))
    done = materialise(merged)
    write_documents(done.select("doc_key", "file", "item_no", "line"), out, batch, retire=gone)
    kept = F.when(F.col("status") == "rewritten", "rewritten").otherwise("ok")
    L.write_entries(L.entries(done.withColumn("status", kept), "rewrite"), ledger, f"rewrite-{batch}")
    return done


def export(spark: SparkSession, src: str, dst: str, keep_order: bool = True, on_empty: str = "error", **csv) -> list[str]:
    """JSON Lines to CSV; returns the header.  A malformed line fails the job.

    ``keep_order`` range-partitions by line, so files and rows follow the source."""
    rows = tabular_rows(read_jsonl(spark, src, on_error="fail", on_empty=on_empty))
    columns = column_list(rows)
    if not columns:
        return []
    table = to_table(rows, columns, keep_key=True)
    if keep_order:
        table = table.orderBy("line_key")
    write_csv(table, dst, columns, **csv)
    return columns
