"""Incremental runs and counters: documents as inputs, labels as what earlier runs did."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailspark.operators import ledger as L
from mailspark.operators import reports
from mailspark.operators.scrub import scrub as scrub_rules
from mailspark.session import work_dir
from mailspark.streaming.files import run_available, table_stream
from registered.base import SQL, Tables, query
from registered.qa import QA_SQL, qa

_KEY = "concat('doc-', doc_id, '.md')"
_SORTED = "concat('doc-', lpad(doc_id::VARCHAR, 9, '0'))"


def _documents(t: Tables):
    return t.documents.select("doc_id", F.expr(_KEY).alias("doc_key"), F.col("text").alias("markdown"))


def _ledger(t: Tables, stage: str = "scrub"):
    """What the labels say: quality is the stage's outcome."""
    done = t.labels.select(
        F.expr(_KEY).alias("doc_key"), F.expr("CASE WHEN quality = 1 THEN 'ok' ELSE 'bad_json' END").alias("status")
    )
    return L.entries(done, stage)


@query(
    "i1_pending_targets",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def i1(t: Tables):
    targets = t.labels.select(F.expr(_KEY).alias("target"), F.expr("CASE WHEN quality = 1 THEN 'text' ELSE '' END").alias("body"))
    return L.pending_targets(_documents(t), targets, "doc_key", "target", "body").select("doc_id")


@query(
    "i2_pending",
    "SELECT doc_id, text AS markdown FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def i2(t: Tables):
    return L.pending(_documents(t), _ledger(t), "scrub").select("doc_id", "markdown")


@query("i2_overwrite", "SELECT doc_id FROM documents")
def i2_overwrite(t: Tables):
    return L.pending(_documents(t), _ledger(t), "scrub", overwrite=True).select("doc_id")


@query("i3_pending_files", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def i3(t: Tables):
    # Several records per finished file, as an output has.
    records = t.labels.select(F.expr(_KEY).alias("file"), F.explode(F.sequence(F.lit(0), F.col("quality"))).alias("item_no"))
    return L.pending_files(_documents(t), records).select("doc_id")


@query(
    "i4_changed_input",
    """SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 0)""",
)
def i4(t: Tables):
    # Documents with a toxic label were done in an older version: other text, other hash.
    docs = _documents(t)
    labelled = docs.join(t.labels, "doc_id")
    old = labelled.withColumn("markdown", F.expr("CASE WHEN toxic = 1 THEN concat(markdown, ' old') ELSE markdown END"))
    ledger = L.entries(L.with_hash(old, "markdown").withColumn("status", F.lit("rewritten")), "rewrite")
    return L.pending(L.with_hash(docs, "markdown"), ledger, "rewrite").select("doc_id")


_DONE = f"(SELECT {_SORTED} AS k FROM labels WHERE quality = 1)"


def _sorted(t: Tables):
    docs = t.documents.select("doc_id", F.expr("concat('doc-', lpad(doc_id, 9, '0'))").alias("doc_key"))
    done = t.labels.select(
        F.expr("concat('doc-', lpad(doc_id, 9, '0'))").alias("doc_key"),
        F.expr("CASE WHEN quality = 1 THEN 'ok' ELSE 'error' END").alias("status"),
    )
    return docs, L.entries(done, "distil")


@query(
    "i5_limit_before_skip",
    f"SELECT k AS doc_key FROM (SELECT {_SORTED} AS k FROM documents ORDER BY k LIMIT 50) WHERE k NOT IN {_DONE}",
)
def i5_before(t: Tables):
    docs, ledger = _sorted(t)
    return L.due(docs, ledger, "distil", limit=50, when="before_skip").select("doc_key")


@query(
    "i5_limit_after_skip",
    f"SELECT k AS doc_key FROM (SELECT {_SORTED} AS k FROM documents) WHERE k NOT IN {_DONE} ORDER BY k LIMIT 50",
)
def i5_after(t: Tables):
    docs, ledger = _sorted(t)
    return L.due(docs, ledger, "distil", limit=50, when="after_skip").select("doc_key")


@query("i6_nothing_due", "SELECT count(*) AS n, count(*) = 0 AS nothing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def i6(t: Tables):
    docs = _documents(t)
    done = L.entries(docs.withColumn("status", F.lit("ok")), "scrub")
    due = L.pending(docs, done, "scrub")
    return due.agg(F.count("*").alias("n")).withColumn("nothing", F.lit(L.nothing_due(due)))


@query("i7_new_files")
def i7(t: Tables):
    """The documents arrive in two loads; each run takes what is new."""
    arriving, sink, checkpoint = (work_dir(t.spark, n) for n in ("arriving", "scrubbed", "checkpoint"))
    docs = t.documents.select("doc_id", "lang", "text")

    def scrub(stream):
        return scrub_rules(stream.withColumnRenamed("text", "markdown"), "markdown")

    for first_load in (True, False):
        load = docs.filter(F.col("lang").eqNullSafe("en") == first_load)
        load.write.mode("append").parquet(arriving)
        run_available(table_stream(t.spark, arriving, docs.schema), scrub, sink, checkpoint)
    return t.spark.read.parquet(sink)


# The stream must give what one batch gives; cards apart, the rules have an SQL form.
def _i7_sql() -> str:
    from registered.scrub import _sql_cards, _sql_scrub

    return f"SELECT doc_id, lang, {_sql_scrub(_sql_cards('text'))} AS markdown FROM documents"


SQL["i7_new_files"] = _i7_sql()


@query(
    "a1_count_status",
    "SELECT 'scrub' AS stage, CASE WHEN quality = 1 THEN 'ok' ELSE 'bad_json' END AS status, count(*) AS n FROM labels GROUP BY ALL",
)
def a1(t: Tables):
    return reports.count_status(_ledger(t))


@query(
    "a1_count_run",
    """SELECT 'ok' AS status, count(*) FILTER (WHERE quality = 1) AS n FROM labels UNION ALL SELECT 'bad_json', count(*) FILTER (WHERE quality <> 1) FROM labels
       UNION ALL SELECT 'skip', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def a1_run(t: Tables):
    """A run that takes up the labelled documents and skips the others."""
    done = t.labels.select("doc_id", F.when(F.col("quality") == 1, "ok").otherwise("bad_json").alias("status"))
    return reports.count_run(t.documents.select("doc_id"), done, key="doc_id")


@query("a2_count_records", "SELECT count(DISTINCT doc_id) AS files, count(*) AS records FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE quality = 1)")
def a2(t: Tables):
    records = t.labels.select(F.expr(_KEY).alias("file"), F.explode(F.sequence(F.lit(0), F.col("quality"))).alias("item_no"))
    return reports.count_records(records)


@query(
    "a3_progress",
    """SELECT total, done, records, round(100.0 * done / total, 1)::DOUBLE AS done_pct, round(100.0 * records / total, 2)::DOUBLE AS records_pct
       FROM (SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM labels) AS done, (SELECT sum(quality + 1) FROM labels)::BIGINT AS records)""",
)
def a3(t: Tables):
    records = t.labels.select(F.expr(_KEY).alias("file"), F.explode(F.sequence(F.lit(0), F.col("quality"))).alias("item_no"))
    return reports.progress(_documents(t), records)


@query(
    "a4_rewrite_totals",
    f"SELECT count(*) AS source_rows, count(*) FILTER (WHERE item_no % 7 <> 0 AND item_no % 2 = 1) AS new_rows, count(*) FILTER (WHERE item_no % 7 <> 0) AS total_rows FROM {QA_SQL}",
)
def a4(t: Tables):
    ledger = qa(t).select(
        F.lit("rewrite").alias("stage"),
        F.concat_ws("#", "file", "item_no").alias("key"),
        F.expr("CASE WHEN item_no % 7 = 0 THEN 'malformed' ELSE 'rewritten' END").alias("status"),
        F.expr("CASE WHEN item_no % 2 = 1 THEN 'b2' ELSE 'b1' END").alias("batch"),
    )
    return reports.rewrite_totals(ledger, "rewrite", "batch", "b2")
