"""JSON Lines to a table, over lines made of events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailspark.operators import reports
from mailspark.operators import tabular as E
from mailspark.sources.jsonl import parse_lines
from registered.base import Tables, query

# Three kinds of lines: QA rows with an extra key, event rows, and event rows with more keys.
_QA = """to_json(named_struct('file', concat('e', event_id), 'category', event_type, 'model', CASE WHEN event_id % 2 = 0 THEN 'G1' END,
   'issue', concat(event_type, chr(13), chr(10), 'two', chr(10)), 'resolution', user_id, 'code_snippet', event_id % 4 = 0, 'extra', 'dropped'),
   map('ignoreNullFields', 'false'))"""
_EVENT = """concat('{"user":', user_id, ',"kind":"', event_type, chr(92), 'n', event_type, '","props":', props, '}')"""
_MORE = """concat('{"flag":', event_id % 2 = 0, ',"kind":"', event_type, '","nothing":null,"list":[', user_id, ',"x"],"file":"f"}')"""
LINES = f"CASE event_id % 3 WHEN 0 THEN {_EVENT} WHEN 1 THEN {_QA} ELSE {_MORE} END"


def lines(t: Tables):
    # The event number stands in for file and line.
    key = F.struct(F.lit("events").alias("file"), F.lit(0).cast("bigint").alias("split_start"), F.col("event_id").alias("row"))
    return parse_lines(t.events.select("event_id", key.alias("line_key"), F.expr(LINES).alias("line")), "fail")


@query("e1_is_qa", "SELECT event_id, event_id % 3 = 1 AS is_qa FROM events")
def e1(t: Tables):
    return lines(t).select("event_id", E.is_qa(F.col("record")).alias("is_qa"))


@query(
    "e2_qa_cells",
    """SELECT event_id, concat('e', event_id) AS file, event_type AS category, CASE WHEN event_id % 2 = 0 THEN 'G1' END AS model,
              concat(event_type, ' two') AS issue, user_id::VARCHAR AS resolution, CASE WHEN event_id % 4 = 0 THEN 'True' ELSE 'False' END AS code_snippet,
              'file,category,model,issue,resolution,code_snippet' AS keys FROM events WHERE event_id % 3 = 1""",
)
def e2(t: Tables):
    rows = E.tabular_rows(lines(t)).filter("is_qa")
    names = ["file", "category", "model", "issue", "resolution", "code_snippet"]
    return rows.select(
        "event_id",
        *[F.try_element_at("cells", F.lit(n)).alias(n) for n in names],
        F.array_join(F.map_keys("cells"), ",").alias("keys"),
    )


@query(
    "e3_free_cells",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat(event_type, ' ', event_type) ELSE event_type END AS kind,
              CASE WHEN event_id % 3 = 0 THEN user_id::VARCHAR END AS "user", CASE WHEN event_id % 3 = 0 THEN replace(props, ' ', '') END AS props,
              CASE WHEN event_id % 3 = 2 THEN CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END END AS flag,
              CASE WHEN event_id % 3 = 2 THEN concat('[', user_id, ',"x"]') END AS list, NULL::VARCHAR AS nothing FROM events WHERE event_id % 3 <> 1""",
)
def e3(t: Tables):
    rows = E.tabular_rows(lines(t)).filter("NOT is_qa")
    names = ["kind", "user", "props", "flag", "list", "nothing"]
    return rows.select("event_id", *[F.try_element_at("cells", F.lit(n)).alias(n) for n in names])


_FIELDS = ["user", "kind", "props", "file", "category", "model", "issue", "resolution", "code_snippet", "flag", "nothing", "list"]


@query(
    "e4_column_order",
    """WITH keys AS (SELECT event_id, unnest(k) AS column_name, unnest(range(len(k))) AS pos FROM (SELECT event_id,
         CASE event_id % 3 WHEN 0 THEN ['user', 'kind', 'props'] WHEN 1 THEN ['file', 'category', 'model', 'issue', 'resolution', 'code_snippet']
              ELSE ['flag', 'kind', 'nothing', 'list', 'file'] END AS k FROM events))
       SELECT column_name, row_number() OVER (ORDER BY min(event_id * 100 + pos)) - 1 AS position FROM keys GROUP BY column_name""",
)
def e4(t: Tables):
    return E.column_order(E.tabular_rows(lines(t)))


@query(
    "e5_to_table",
    """SELECT CASE WHEN event_id % 3 = 0 THEN user_id::VARCHAR ELSE '' END AS "user",
              CASE event_id % 3 WHEN 0 THEN concat(event_type, ' ', event_type) WHEN 1 THEN '' ELSE event_type END AS kind,
              CASE WHEN event_id % 3 = 0 THEN replace(props, ' ', '') ELSE '' END AS props,
              CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('e', event_id) ELSE 'f' END AS file,
              CASE WHEN event_id % 3 = 1 THEN event_type ELSE '' END AS category, CASE WHEN event_id % 3 = 1 AND event_id % 2 = 0 THEN 'G1' ELSE '' END AS model,
              CASE WHEN event_id % 3 = 1 THEN concat(event_type, ' two') ELSE '' END AS issue, CASE WHEN event_id % 3 = 1 THEN user_id::VARCHAR ELSE '' END AS resolution,
              CASE WHEN event_id % 3 <> 1 THEN '' WHEN event_id % 4 = 0 THEN 'True' ELSE 'False' END AS code_snippet,
              CASE WHEN event_id % 3 <> 2 THEN '' WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS flag, '' AS nothing,
              CASE WHEN event_id % 3 = 2 THEN concat('[', user_id, ',"x"]') ELSE '' END AS list FROM events""",
)
def e5(t: Tables):
    return E.to_table(E.tabular_rows(lines(t)))


@query("a5_export_summary", f"SELECT count(*) AS n_rows, '{','.join(_FIELDS)}' AS fields FROM events")
def a5(t: Tables):
    rows = E.tabular_rows(lines(t))
    return reports.export_summary(E.column_order(rows), rows)
