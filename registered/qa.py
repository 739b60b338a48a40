"""Distillation, rewrite and contract checks over conversations, documents, parts and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailspark.functions import pii
from mailspark.functions.jsontext import parse_object
from mailspark.operators import contracts as C
from mailspark.operators import records as N
from mailspark.operators import requests as R
from mailspark.operators import responses as A
from mailspark.operators import turns as U
from mailspark.operators import vocabulary as V
from mailspark.plans.threads import turns_to_mix
from mailspark.operators.reports import qa_mix
from registered.base import S, Tables, query, sql_rtrim

_KEY = "concat('thread-', conv_id, '-', turn, '.md')"


@query(
    "d1_distil_request",
    f"""SELECT conv_id, turn, 'system,user' AS roles, 'Extract QA.' AS system_text,
               concat('<thread name="', {_KEY}, '">', chr(10), text, chr(10), '</thread>', chr(10),
                      'Return JSON only: {{"items": [...]}}, each item with category, model, issue, resolution and code_snippet.') AS user_text
        FROM conversations""",
)
def d1(t: Tables):
    mails = t.conversations.select("conv_id", "turn", F.expr(_KEY).alias("doc_key"), F.col("text").alias("markdown"))
    asked = R.distil_request(mails, "Extract QA.").withColumn("m", F.col("messages"))
    return asked.select(
        "conv_id", "turn", F.array_join(F.col("m")["role"], ",").alias("roles"),
        F.col("m")[0]["content"].alias("system_text"), F.col("m")[1]["content"].alias("user_text"),
    )


# Model answers of all shapes, one per turn, made from the turn's own text.
ITEM = """to_json(named_struct('category', role, 'model', CASE WHEN turn % 2 = 0 THEN 'G1' END, 'issue', text, 'resolution', array(role, text),
          'code_snippet', CASE WHEN turn % 3 = 0 THEN text END), map('ignoreNullFields', 'false'))"""
OTHER = """to_json(named_struct('category', 'other', 'issue', conv_id, 'code_snippet', turn % 2, 'extra', true))"""
ANSWERS = f"""CASE (conv_id + turn) % 13
  WHEN 0 THEN concat('[', item, ',', other, ']') WHEN 1 THEN concat('{{"items":[', item, ',', other, ']}}')
  WHEN 2 THEN concat('{{"qa":[', item, ']}}') WHEN 3 THEN concat('{{"qas":[', other, ']}}') WHEN 4 THEN concat('{{"data":[', item, ',"junk",', other, ']}}')
  WHEN 5 THEN concat('{{"items":', turn, ',"qa":[', item, ',', other, ']}}') WHEN 6 THEN '{{"items":[]}}' WHEN 7 THEN concat('{{"other":[', item, ']}}')
  WHEN 8 THEN CAST(turn AS STRING) WHEN 9 THEN '' WHEN 10 THEN substr(concat('[', item, ']'), 1, 20) WHEN 11 THEN concat('[', item, '] as asked')
  ELSE concat('[', item, '],[', item, ']') END"""
_SHAPE = "((conv_id + turn) % 13)"
_STATUS = f"""CASE WHEN {_SHAPE} <= 5 THEN 'ok' WHEN {_SHAPE} = 6 THEN 'no_items' WHEN {_SHAPE} IN (7, 8) THEN 'no_list'
              WHEN {_SHAPE} = 9 THEN 'empty' ELSE 'bad_json' END"""
_N_ITEMS = f"CASE {_SHAPE} WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN 3 WHEN 5 THEN 2 WHEN 6 THEN 0 ELSE NULL END"


def answers(t: Tables):
    made = t.conversations.select(
        "conv_id", "turn", F.expr(_KEY).alias("doc_key"), F.expr(ITEM).alias("item"), F.expr(OTHER).alias("other")
    )
    return made.select("conv_id", "turn", "doc_key", F.expr(ANSWERS).alias("response"))


@query("d2_extract_items", f"SELECT conv_id, turn, {_STATUS} AS status, {_N_ITEMS} AS n_items FROM conversations")
def d2(t: Tables):
    listed = A.extract_items(answers(t))
    return listed.select("conv_id", "turn", "status", F.size("items").alias("n_items"))


@query("d3_answer_status", f"SELECT {_STATUS} AS status, count(*) AS n, coalesce(sum({_N_ITEMS}), 0)::BIGINT AS items FROM conversations GROUP BY 1")
def d3(t: Tables):
    listed = A.extract_items(answers(t))
    return listed.groupBy("status").agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.size("items"), F.lit(0))).cast("bigint").alias("items")
    )


# The kinds of the items of each answer: i(tem), o(ther), j(unk).
_KINDS = f"CASE {_SHAPE} WHEN 0 THEN 'io' WHEN 1 THEN 'io' WHEN 2 THEN 'i' WHEN 3 THEN 'o' WHEN 4 THEN 'ijo' WHEN 5 THEN 'io' ELSE '' END"
_ITEMS_SQL = f"""SELECT *, kinds[i + 1] AS kind FROM (SELECT *, {_KINDS} AS kinds, unnest(range(len({_KINDS}))) AS i FROM conversations)"""


@query(
    "d4_explode_items",
    f"SELECT conv_id, turn, i::INT AS item_no, CASE WHEN kind = 'j' THEN 'not_object' ELSE 'ok' END AS item_status FROM ({_ITEMS_SQL})",
)
def d4(t: Tables):
    items = A.explode_items(A.extract_items(answers(t)))
    return items.select("conv_id", "turn", "item_no", "item_status")


@query(
    "d5_qa_records",
    f"""SELECT {_KEY} AS file, i::INT AS item_no, CASE kind WHEN 'i' THEN role ELSE 'other' END AS category,
               CASE WHEN kind = 'i' AND turn % 2 = 0 THEN 'G1' END AS model, CASE kind WHEN 'i' THEN text ELSE conv_id::VARCHAR END AS issue,
               CASE WHEN kind = 'i' THEN to_json([role, text])::VARCHAR END AS resolution,
               CASE WHEN kind = 'i' AND turn % 3 = 0 THEN text WHEN kind = 'o' AND turn % 2 = 1 THEN '1' ELSE '' END AS code_snippet
        FROM ({_ITEMS_SQL}) WHERE kind <> 'j'""",
)
def d5(t: Tables):
    return A.distil_response(answers(t))


@query(
    "d6_category",
    """SELECT doc_id, CASE WHEN given IN ('sdk', 'sensor', 'control') THEN given ELSE 'other' END AS category,
              given IN ('sdk', 'sensor', 'control') AS category_known
       FROM (SELECT doc_id, CASE source WHEN 'src1' THEN 'sdk' WHEN 'src2' THEN 'sensor' WHEN 'src3' THEN 'control' ELSE source END AS given FROM documents)""",
)
def d6(t: Tables):
    given = t.documents.select(
        "doc_id",
        F.expr("CASE source WHEN 'src1' THEN ' SDK ' WHEN 'src2' THEN 'Sensor' WHEN 'src3' THEN 'control' ELSE source END").alias("category"),
    )
    return V.normalise_category(given)


def _score_sql(words) -> str:
    """Hits of a keyword list by hand: each padded word stands between non-word characters."""
    return " + ".join(f"len(regexp_extract_all(low, '(?:^|[^0-9a-z_]){w}(?:$|[^0-9a-z_])'))" for w in words)


@query(
    "d6_category_rules",
    f"""SELECT doc_id, CASE WHEN greatest(a, b) = 0 THEN 'other' WHEN a >= b THEN 'first' ELSE 'second' END AS category
        FROM (SELECT doc_id, {_score_sql(['the', 'die', 'la'])} AS a, {_score_sql(['and', 'und', 'les'])} AS b
              FROM (SELECT doc_id, regexp_replace(lower(text), '([^0-9a-z_])', '\\1\\1', 'g') AS low FROM documents))""",
)
def d6_rules(t: Tables):
    words = {"first": ("the", "die", "la"), "second": ("and", "und", "les")}
    return t.documents.select("doc_id", V.category_rules(F.col("text"), words).alias("category"))


_BRANDS = [f"Brand#{i}" for i in range(1, 26)] + ["Brand#1 Plus"]


@query(
    "d7_model_vocabulary",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' AND p_size % 2 = 0 THEN 'Brand#1 Plus' ELSE p_brand END AS model FROM part""",
)
def d7(t: Tables):
    text = F.expr("concat(p_name, ' / ', lower(p_brand), CASE WHEN p_size % 2 = 0 THEN '-PLUS ' ELSE ' ' END, p_type)")
    return t.part.select("p_partkey", V.normalise_model(text, _BRANDS).alias("model"))


_MENTION = """CASE CAST(substr(source, 4) AS INT) WHEN 1 THEN 'Our go2 edu fails' WHEN 2 THEN 'Go2 Air stuck' WHEN 3 THEN 'the B2-W wheel' WHEN 4 THEN 'b2w wheel'
  WHEN 5 THEN 'L1-lidar dust' WHEN 6 THEN 'Go20 is none' WHEN 7 THEN '问题：G1机器人' WHEN 8 THEN 'h1, then g1' ELSE '' END"""


@query(
    "d7_model_names",
    """SELECT doc_id, CASE s WHEN 1 THEN 'Go2 EDU' WHEN 2 THEN 'Go2' WHEN 3 THEN 'B2-W' WHEN 4 THEN 'B2-W' WHEN 5 THEN 'L1 LiDAR' WHEN 7 THEN 'G1' WHEN 8 THEN 'H1' END AS model,
              CASE s WHEN 1 THEN 'Go2 EDU' WHEN 2 THEN 'Go2 Air' WHEN 3 THEN 'B2-W' WHEN 4 THEN 'B2-W' WHEN 5 THEN 'L1 LiDAR' WHEN 7 THEN 'G1' WHEN 8 THEN 'H1' END AS variant
       FROM (SELECT doc_id, substr(source, 4)::INT AS s FROM documents)""",
)
def d7_names(t: Tables):
    text = F.concat_ws("\n", F.expr(_MENTION), F.col("text"))
    return t.documents.select(
        "doc_id", V.normalise_model(text).alias("model"), V.normalise_model(text, keep_suffix=True).alias("variant")
    )


_BIZ = ["invoice", "payment", "visa", "报价"]
_TECH = ["firmware", "motor", "log", "报错"]
_MIXED = """concat(CASE doc_id % 4 WHEN 0 THEN concat('Please send the Invoice.', chr(10)) WHEN 1 THEN concat('the payment failed, see Log', chr(10)) ELSE '' END,
  text, CASE doc_id % 5 WHEN 0 THEN concat(chr(10), '请发报价') WHEN 1 THEN concat(chr(10), '电机报错') WHEN 2 THEN concat(chr(10), 'visa') ELSE '' END)"""


def _alternatives(words) -> str:
    return "|".join(rf"\b{w}\b" if w.isascii() else w for w in words)


_B, _T = f"(?i){_alternatives(_BIZ)}", f"(?i){_alternatives(_TECH)}"


@query(
    "d8_filter_technical",
    f"""SELECT doc_id, {sql_rtrim(f"array_to_string(list_filter(string_split(md, chr(10)), lambda x: regexp_matches(x, '{_T}') OR NOT regexp_matches(x, '{_B}')), chr(10))")} AS markdown
        FROM (SELECT doc_id, {_MIXED} AS md FROM documents)
        WHERE NOT regexp_matches(md, '{_B}') OR regexp_matches(md, '{_T}')""",
)
def d8(t: Tables):
    docs = t.documents.select("doc_id", F.expr(_MIXED).alias("markdown"))
    return C.filter_technical(docs, business=_BIZ, technical=_TECH)


_URLS = """concat(text, ' see https://docs.example.org/', doc_id, '/a.html and (http://example.com/', lang, ') or https://docs.example.org/', doc_id, '/a.html')"""


@query(
    "d9_missing_urls",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('http://example.com/', lang)
              ELSE concat('https://docs.example.org/', doc_id, '/a.html http://example.com/', lang) END AS missing FROM documents""",
)
def d9(t: Tables):
    answer = F.expr(
        f"CASE doc_id % 3 WHEN 0 THEN {_URLS} WHEN 1 THEN concat('https://docs.example.org/', doc_id, '/a.html') ELSE text END"
    )
    missing = C.missing_urls(F.expr(_URLS), answer)
    return t.documents.select("doc_id", F.array_join(missing, " ").alias("missing"))


_PHRASED = """CASE doc_id % 6 WHEN 0 THEN concat(text, '建议用户重启') WHEN 1 THEN concat(text, '客户遇到问题') WHEN 2 THEN concat(text, '如前文邮件所示') WHEN 3 THEN '请先重启机器人，然后检查电机' ELSE text END"""


@query(
    "d10_d11_voice_and_language",
    f"""SELECT doc_id, 0::BIGINT AS urls_missing, doc_id % 6 < 2 AS third_person,
               len(regexp_extract_all(concat(t, r), '\\p{{Han}}')) / length(concat(t, r)) >= 0.3 AS is_chinese
        FROM (SELECT doc_id, {_PHRASED} AS t, '请先检查' AS r FROM documents)""",
)
def d10(t: Tables):
    docs = t.documents.select("doc_id", F.expr(_PHRASED).alias("issue"), F.lit("请先检查").alias("resolution"), F.lit("").alias("source"))
    return C.check_distilled(docs, "source").select("doc_id", "urls_missing", "third_person", "is_chinese")


_THREAD = """concat(text, CASE turn % 3 WHEN 0 THEN concat(chr(10), '---', chr(10), chr(10), 'Reply:', chr(10), role, ' answer', chr(10), '---', chr(10), 'more')
  WHEN 1 THEN concat(chr(10), '---', chr(10), 'no reply: line') ELSE '' END)"""


@query(
    "d12_split_reply",
    f"""SELECT conv_id, turn, CASE turn % 3 WHEN 1 THEN concat({sql_rtrim('text')}, chr(10), '---', chr(10), 'no reply: line') ELSE {sql_rtrim('text')} END AS question,
               CASE WHEN turn % 3 = 0 THEN concat(role, ' answer', chr(10), '---', chr(10), 'more') END AS answer FROM conversations""",
)
def d12_split(t: Tables):
    question, answer = U.split_reply(F.expr(_THREAD))
    return t.conversations.select("conv_id", "turn", question.alias("question"), answer.alias("answer"))


_PAIRS = """WITH t AS (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS q FROM {turns})
  SELECT conv_id, q AS turn, 'question' AS status, max(text) FILTER (WHERE role = 'user') AS issue,
         string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role = 'assistant') AS resolution,
         count(*) FILTER (WHERE role = 'assistant') AS n_answers
  FROM t WHERE q IS NOT NULL AND role IN ('user', 'assistant') GROUP BY conv_id, q
  UNION ALL
  SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'orphan_answer' ELSE 'other_role' END, NULL, text, 0
  FROM t WHERE role NOT IN ('user', 'assistant') OR role = 'assistant' AND q IS NULL"""


@query("d12_pair_turns", _PAIRS.format(turns="conversations"))
def d12_pair(t: Tables):
    return U.pair_turns(t.conversations)


# All conversations laid end to end as ONE thread whose questions are rare: the skewed case.
_LONG = "(SELECT 0::BIGINT AS conv_id, conv_id * 10 + turn AS turn, CASE WHEN conv_id % 50 = 3 AND turn = 0 THEN 'user' ELSE 'assistant' END AS role, text FROM conversations)"


@query("d12_one_long_thread", _PAIRS.format(turns=_LONG))
def d12_long(t: Tables):
    thread = t.conversations.select(
        F.lit(0).cast("bigint").alias("conv_id"),
        (F.col("conv_id") * 10 + F.col("turn")).alias("turn"),
        F.expr("CASE WHEN conv_id % 50 = 3 AND turn = 0 THEN 'user' ELSE 'assistant' END").alias("role"),
        "text",
    )
    return U.pair_turns(thread)


QA_COLUMNS = [
    f"{_KEY} AS file", "CAST(turn AS INT) AS item_no", "CASE WHEN turn % 3 = 0 THEN NULL ELSE role END AS category",
    "CASE WHEN conv_id % 2 = 0 THEN 'G1' END AS model", "text AS issue", "CASE WHEN turn % 4 <> 1 THEN concat(role, ' ', conv_id) END AS resolution",
    "CASE WHEN turn % 5 = 0 THEN 'ls' ELSE '' END AS code_snippet",
]
QA_SQL = "(SELECT " + ", ".join(QA_COLUMNS) + ", conv_id, turn FROM conversations)"


def qa(t: Tables):
    return t.conversations.selectExpr(*QA_COLUMNS)


@query(
    "d13_alternative_records",
    f"SELECT file, item_no, issue AS question, resolution AS answer, model AS product, coalesce(category, '') AS tags, NULL::VARCHAR AS source_note FROM {QA_SQL}",
)
def d13(t: Tables):
    return N.to_alternative(qa(t)).withColumn("tags", F.array_join("tags", "|"))


@query(
    "d13_parse_alternative",
    f"""SELECT file, 0 AS item_no, question, NULL::VARCHAR AS answer, product, CASE WHEN turn % 2 = 0 THEN concat(role, '|x') ELSE '' END AS tags, 'note' AS source_note
        FROM (SELECT {_KEY} AS file, turn, role, text AS question, CASE WHEN turn % 3 = 0 THEN 'G1' END AS product FROM conversations)""",
)
def d13_parse(t: Tables):
    item = """to_json(array(named_struct('question', text, 'product', CASE WHEN turn % 3 = 0 THEN 'G1' END,
              'tags', CASE WHEN turn % 2 = 0 THEN array(role, 'x') END, 'source_note', 'note')))"""
    made = t.conversations.select(F.expr(_KEY).alias("doc_key"), F.expr(item).alias("response"))
    records = N.alternative_records(A.explode_items(A.extract_items(made)))
    return records.withColumn("tags", F.array_join("tags", "|"))


@query(
    "d13_round_trip",
    f"SELECT file, item_no, category, model, issue, resolution, '' AS code_snippet FROM {QA_SQL}",
)
def d13_back(t: Tables):
    return N.from_alternative(N.to_alternative(qa(t)))


@query(
    "r1_minimal_record",
    f"""SELECT file, item_no, to_json({{'file': file, 'category': category, 'model': model, 'issue': issue, 'resolution': coalesce(resolution, ''), 'code_snippet': code_snippet}})::VARCHAR AS record
        FROM {QA_SQL}""",
)
def r1(t: Tables):
    return qa(t).select("file", "item_no", R.minimal_record().alias("record"))


@query(
    "r2_rewrite_request",
    f"""SELECT file, item_no, concat('<record>', chr(10),
          to_json({{'file': file, 'category': category, 'model': model, 'issue': issue, 'resolution': coalesce(resolution, ''), 'code_snippet': code_snippet}}),
          chr(10), '</record>', chr(10), 'Return this record as JSON, with the same keys and better wording.') AS user_text FROM {QA_SQL}""",
)
def r2(t: Tables):
    asked = R.rewrite_request(qa(t), "Rewrite.")
    return asked.select("file", "item_no", F.col("messages")[1]["content"].alias("user_text"))


# Base and patch records made from orders.
_BASE = "to_json(named_struct('status', o_orderstatus, 'total', CAST(o_totalprice AS STRING), 'cust', o_custkey), map('ignoreNullFields', 'false'))"
_PATCH = """CASE o_orderkey % 6 WHEN 0 THEN to_json(named_struct('total', NULL, 'note', o_orderpriority), map('ignoreNullFields', 'false'))
  WHEN 1 THEN '{"status":"X","cust":"y"}' WHEN 2 THEN ' ' WHEN 3 THEN '[1]' WHEN 4 THEN NULL ELSE '{"note":{"a":[1,2]}} trailing' END"""


@query(
    "r3_r4_merge_record",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'rewritten' WHEN 1 THEN 'rewritten' WHEN 2 THEN 'kept_blank' WHEN 4 THEN 'kept_no_answer' ELSE 'kept_bad_json' END AS status,
              CASE WHEN o_orderkey % 6 = 1 THEN 'X' ELSE o_orderstatus END AS o_status, CASE WHEN o_orderkey % 6 = 1 THEN 'y' ELSE o_custkey::VARCHAR END AS cust,
              o_orderkey % 6 = 0 AS total_gone, CASE WHEN o_orderkey % 6 = 0 THEN o_orderpriority END AS note,
              CASE WHEN o_orderkey % 6 = 0 THEN 'status,total,cust,note' ELSE 'status,total,cust' END AS keys FROM orders""",
)
def r3(t: Tables):
    df = t.orders.select("o_orderkey", parse_object(F.expr(_BASE)).alias("record"), F.expr(_PATCH).alias("response"))

    def value(key: str):
        return F.try_variant_get(F.try_element_at("record", F.lit(key)), "$", "string")

    return A.merge_record(df).select(
        "o_orderkey", "status", value("status").alias("o_status"), value("cust").alias("cust"),
        value("total").isNull().alias("total_gone"), value("note").alias("note"),
        F.array_join(F.map_keys("record"), ",").alias("keys"),
    )


_LINKED = """concat(text, ' video https://drive.google.com/file/d/', doc_id, '/view?usp=x, docs https://example.org/a/', doc_id, ' (https://www.dropbox.com/s/', lang, ') https://x.sharepoint.com/y')"""


@query(
    "r5_share_links",
    f"""SELECT doc_id, replace(replace(replace(md, concat('https://drive.google.com/file/d/', doc_id, '/view?usp=x,'), '{pii.SHARE_PHRASE}'),
               concat('https://www.dropbox.com/s/', lang), '{pii.SHARE_PHRASE}'), 'https://x.sharepoint.com/y', '{pii.SHARE_PHRASE}') AS resolution, 3::BIGINT AS n_share_links
        FROM (SELECT doc_id, lang, {_LINKED} AS md FROM documents)""",
)
def r5(t: Tables):
    docs = t.documents.select("doc_id", F.expr(_LINKED).alias("resolution"))
    return C.replace_share_links(docs, ["resolution"])


@query(
    "r6_rewrite_checks",
    f"""SELECT doc_id, doc_id % 6 < 2 AS third_person, doc_id % 6 = 2 AS mail_context,
               len(regexp_extract_all(concat(t, '请'), '\\p{{Han}}')) / length(concat(t, '请')) >= 0.3 AS is_chinese
        FROM (SELECT doc_id, {_PHRASED} AS t FROM documents)""",
)
def r6(t: Tables):
    docs = t.documents.select("doc_id", F.expr(_PHRASED).alias("issue"), F.lit("请").alias("resolution"))
    return C.check_rewritten(docs).select("doc_id", "third_person", "mail_context", "is_chinese")


@query("r7_same_keys", "SELECT o_orderkey, o_orderkey % 6 <> 0 AS same FROM orders")
def r7(t: Tables):
    df = t.orders.select("o_orderkey", parse_object(F.expr(_BASE)).alias("record"), F.expr(_PATCH).alias("response"))
    merged = A.merge_record(df, out="merged")
    return merged.select("o_orderkey", C.same_keys(F.col("record"), F.col("merged")).alias("same"))


@query("a6_qa_mix", f"SELECT category, model, count(*) AS n FROM {QA_SQL} GROUP BY category, model")
def a6(t: Tables):
    return qa_mix(qa(t))


@query("a6_qa_mix_subtotals", f"SELECT category, model, count(*) AS n FROM {QA_SQL} GROUP BY ROLLUP (category, model)")
def a6_rollup(t: Tables):
    return qa_mix(qa(t), subtotals=True)


@query("a6_threads_to_mix", "SELECT 'other' AS category, NULL::VARCHAR AS model, count(*) AS n FROM conversations WHERE role = 'user'")
def a6_threads(t: Tables):
    return turns_to_mix(t.conversations)
