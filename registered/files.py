"""Sources and sinks: tables are written out as files in the work folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailspark.session import work_dir
from mailspark.sinks.csv import BOM, write_csv
from mailspark.sinks.documents import export_files, export_folder, read_documents, update_documents, write_changed, write_documents
from mailspark.sinks.jsonl import write_qa, write_rewritten
from mailspark.sources.files import check_not_empty, decode_text, read_mail, read_markdown
from mailspark.sources.jsonl import read_jsonl
from registered.base import Tables, query
from registered.qa import QA_SQL, qa
from registered.text import FORWARD_SQL, FORWARDS


def _turn_folder(t: Tables, name: str) -> str:
    """One folder per turn with one text file in it.  Turns are dealt by their key: a file costs far more than its bytes, and a
    table of few bytes is one task."""
    path = work_dir(t.spark, name)
    turns = t.conversations.select(F.concat_ws("-", "conv_id", "turn").alias("doc_key"), F.col("text").alias("markdown"))
    export_folder(turns.repartition(t.parts, "doc_key"), path)
    return path


_FOLDER = r"^doc=([^/]+)/.*$"


@query("s1_mail_scan", "SELECT concat(conv_id, '-', turn) AS folder, concat(text, chr(10)) AS body, '.md' AS target FROM conversations")
def s1(t: Tables):
    files = read_mail(t.spark, _turn_folder(t, "s1"), glob="*.txt")
    return files.select(
        F.regexp_extract("doc_key", _FOLDER, 1).alias("folder"),
        F.col("content").cast("string").alias("body"),
        F.regexp_extract("target_key", r"[.][a-z]+$", 0).alias("target"),
    )


@query("s2_markdown_top_folder", "SELECT conv_id, turn, concat(conv_id, ' ', turn, chr(10), text, chr(10)) AS markdown FROM conversations")
def s2(t: Tables):
    path = work_dir(t.spark, "s2")
    turns = t.conversations.select(F.expr("concat(conv_id, ' ', turn, chr(10), text)").alias("value"))
    export_files(turns.repartition(t.parts), path)
    head = F.split(F.substring_index("markdown", "\n", 1), " ")
    docs = read_markdown(t.spark, path, glob="*.txt")
    return docs.select(head[0].cast("bigint").alias("conv_id"), head[1].cast("bigint").alias("turn"), "markdown")


@query("s3_markdown_sub_folders", "SELECT concat(conv_id, '-', turn) AS folder, concat(text, chr(10)) AS markdown FROM conversations")
def s3(t: Tables):
    docs = read_markdown(t.spark, _turn_folder(t, "s3"), recursive=True, glob="*.txt")
    return docs.select(F.regexp_extract("doc_key", _FOLDER, 1).alias("folder"), "markdown")


def _damaged(t: Tables):
    raw = F.expr("CASE WHEN doc_id % 3 = 0 THEN concat(encode(text, 'UTF-8'), unhex('FF'), encode(lang, 'UTF-8')) ELSE encode(text, 'UTF-8') END")
    return t.documents.select("doc_id", raw.alias("content"))


@query("s4_decode_replace", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat(text, chr(65533), lang) ELSE text END AS content FROM documents")
def s4_replace(t: Tables):
    return decode_text(_damaged(t), "content", "replace")


@query("s4_decode_skip", "SELECT doc_id, text AS content FROM documents WHERE doc_id % 3 <> 0")
def s4_skip(t: Tables):
    return decode_text(_damaged(t), "content", "skip")


# One line per event: good, cut short, with trailing text, blank, with a repeated key.
_LINE = """CASE event_id % 7 WHEN 1 THEN substr(good, 1, length(good) - 3) WHEN 2 THEN concat(good, ' ,') WHEN 3 THEN ' ' WHEN 4 THEN concat('{"id":-1,', substr(good, 2)) ELSE good END"""


def _event_lines(t: Tables) -> str:
    path = work_dir(t.spark, "events")
    good = F.expr("""concat('{"id":', event_id, ',"props":', props, '}')""")
    t.events.select("event_id", good.alias("good")).select(F.expr(_LINE).alias("value")).write.text(path)
    return path


@query(
    "s5_jsonl_keep",
    """SELECT count(*) FILTER (WHERE event_id % 7 <> 3) AS n_lines, count(*) FILTER (WHERE event_id % 7 IN (1, 2)) AS n_bad,
              count(*) FILTER (WHERE event_id % 7 <> 3) AS n_keys FROM events""",
)
def s5_keep(t: Tables):
    lines = read_jsonl(t.spark, _event_lines(t), "keep")
    return lines.agg(
        F.count("*").alias("n_lines"), F.count_if(F.col("record").isNull()).alias("n_bad"), F.count_distinct("line_key").alias("n_keys")
    )


@query(
    "s5_jsonl_skip",
    """SELECT event_id AS id, props::JSON->>'k' AS k FROM events WHERE event_id % 7 NOT IN (1, 2, 3)""",
)
def s5_skip(t: Tables):
    lines = read_jsonl(t.spark, _event_lines(t), "skip")
    return lines.select(
        F.try_variant_get(F.col("record")["id"], "$", "bigint").alias("id"),
        F.try_variant_get(F.col("record")["props"], "$.k", "string").alias("k"),
    )


@query("s6_not_empty", "SELECT doc_id, quality FROM labels")
def s6(t: Tables):
    return check_not_empty(t.labels, "labels", "error").select("doc_id", "quality")


_SECOND = "SELECT doc_id FROM labels WHERE quality = 1"


@query(
    "k1_document_table",
    f"SELECT concat('doc-', doc_id) AS doc_key, CASE WHEN doc_id IN ({_SECOND}) THEN concat(text, ' v2') ELSE text END AS markdown FROM documents",
)
def k1(t: Tables):
    path = work_dir(t.spark, "k1")
    docs = t.documents.select(F.concat(F.lit("doc-"), F.col("doc_id")).alias("doc_key"), F.col("text").alias("markdown"), "doc_id")
    newer = docs.join(t.labels.filter("quality = 1"), "doc_id", "left_semi").withColumn("markdown", F.concat("markdown", F.lit(" v2")))
    write_documents(docs.drop("doc_id"), path, "0001")
    write_documents(newer.drop("doc_id"), path, "0002")
    write_documents(newer.drop("doc_id"), path, "0002")  # run again: the batch is replaced
    return read_documents(t.spark, path)


@query("k2_qa_jsonl", f"SELECT file, category IS NULL AS no_category, model, resolution, issue, 6 AS n_keys FROM {QA_SQL}")
def k2(t: Tables):
    path = work_dir(t.spark, "k2")
    write_qa(qa(t), path)
    record = F.col("record")

    def text(name: str):
        return F.try_variant_get(F.try_element_at(record, F.lit(name)), "$", "string").alias(name)

    lines = read_jsonl(t.spark, path, "fail")
    return lines.select(
        text("file"), text("category").isNull().alias("no_category"), text("model"), text("resolution"), text("issue"), F.size(record).alias("n_keys")
    )


@query("k3_rewrite_output", f"SELECT file, issue FROM {QA_SQL}")
def k3(t: Tables):
    path = work_dir(t.spark, "k3")
    rows = qa(t).select("file", "issue", "model")
    write_rewritten(rows, path, resumed=False)
    write_rewritten(rows.filter("model IS NULL"), path, resumed=False)  # started afresh
    write_rewritten(rows.filter("model IS NOT NULL"), path, resumed=True)  # went on
    return t.spark.read.schema("file string, issue string").json(path)


@query(
    "k4_csv_lines",
    "SELECT concat(q, conv_id, q, ',', q, turn, q, ',', q, role, ' ', q, q, 'said', q, q, q, ',', q, replace(replace(text, q, concat(q, q)), chr(10), ' '), q, ',', q, q) AS line "
    "FROM (SELECT *, chr(34) AS q FROM conversations)",
)
def k4(t: Tables):
    path = work_dir(t.spark, "k4")
    table = t.conversations.select(
        "conv_id", "turn", F.concat("role", F.lit(' "said"')).alias("who"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"),
        F.lit(None).cast("string").alias("nothing"),
    )
    write_csv(table.repartition(3, "conv_id"), path)
    lines = t.spark.read.option("lineSep", "\r\n").text(path)
    header = BOM + '"conv_id","turn","who","text","nothing"'
    # The reader drops the mark at the head of a file.
    return lines.filter(~F.col("value").isin(header, header[1:])).select(F.col("value").alias("line"))


@query("k5_update_documents", f"SELECT doc_id::VARCHAR AS doc_key, cut AS markdown FROM ({FORWARD_SQL})")
def k5(t: Tables):
    path = work_dir(t.spark, "k5")
    docs = t.documents.select(F.col("doc_id").cast("string").alias("doc_key"), F.expr(FORWARDS).alias("markdown"))
    write_documents(docs, path, "0001")
    write_changed(update_documents(read_documents(t.spark, path)), path, "0002")
    return read_documents(t.spark, path)
