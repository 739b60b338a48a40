"""Text clean-up over ``documents`` and ``conversations``.

The tables hold no mail markers, so markers are put in by one SQL expression that both
engines run; it keeps each whole text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mailspark.functions import text as X
from mailspark.operators.reports import count_changed
from mailspark.sinks.documents import update_documents
from registered.base import H, S, Tables, query, sql_clean, sql_cut, sql_first, sql_lines, sql_rtrim

# Texts with every kind of line end, NUL excluded (DuckDB has no such character in text).
BREAKS = "concat(replace(text, '. ', concat('.', chr(13), chr(10))), chr(13), lang, chr(9), ' ', chr(10), source, ' ', chr(9))"

QUOTES = """concat(
  CASE WHEN doc_id % 5 = 0 THEN concat('From: first line', chr(10)) WHEN doc_id % 5 = 1 THEN concat('  ', chr(10), chr(10)) ELSE '' END,
  text,
  CASE doc_id % 9
    WHEN 0 THEN concat(chr(10), 'FROM: a@b.example', chr(10), 'old ', lang)
    WHEN 1 THEN concat(chr(10), 'On Tuesday, somebody wrote:  ', chr(10), '> old')
    WHEN 2 THEN concat(chr(10), '发件人： x', chr(10), 'old')
    WHEN 3 THEN concat(chr(10), '-----original message-----', chr(10), 'old')
    WHEN 4 THEN concat(chr(10), 'Re: From: no marker', chr(10), ' To: indented', chr(10), 'Date:', chr(10), 'kept')
    WHEN 5 THEN concat(chr(10), '在昨天写道：', '　', chr(10), 'old')
    WHEN 6 THEN concat(chr(10), 'Subject:', '　', 'wide blank', chr(10), 'old')
    ELSE concat('  ', '　', chr(10), ' ')
  END)"""

SIGNATURES = """concat(
  CASE WHEN doc_id % 5 = 0 THEN concat('-- ', chr(10)) WHEN doc_id % 5 = 1 THEN concat(chr(10), '  Regards', chr(10), 'x', chr(10)) ELSE '' END,
  text,
  CASE doc_id % 8
    WHEN 0 THEN concat(chr(10), '-- ', chr(10), source)
    WHEN 1 THEN concat(chr(10), '  Best Regards, ', chr(10), source)
    WHEN 2 THEN concat(chr(10), 'best regards', chr(10), 'kept')
    WHEN 3 THEN concat(chr(10), '谢谢！', chr(10), source)
    WHEN 4 THEN concat(chr(10), '此致，敬礼', chr(10), source)
    WHEN 5 THEN concat(chr(10), '-- Jane', chr(10), source)
    WHEN 6 THEN concat(chr(10), '--- rule', chr(10), 'Regards to you all', chr(10))
    ELSE chr(10)
  END)"""

FORWARDS = """concat(
  CASE WHEN doc_id % 7 = 0 THEN concat('Regards', chr(10)) ELSE '' END,
  text,
  CASE doc_id % 9
    WHEN 0 THEN concat(' ', chr(10), chr(10), '  ', chr(10), '---------- Forwarded message ----------', chr(10), 'old')
    WHEN 1 THEN concat(chr(10), 'OFFICE: +49 30', chr(10), 'old')
    WHEN 2 THEN concat(chr(10), 'best regards', chr(10), 'old')
    WHEN 3 THEN concat(chr(10), 'Best Regards,', chr(10), 'kept')
    WHEN 4 THEN concat(chr(10), '抄送人:x', chr(10), 'old')
    WHEN 5 THEN concat(chr(10), '---------- forwarded message ----------', chr(10), 'kept  ')
    WHEN 6 THEN concat(chr(10), 'Email: Support_eu', chr(10), 'old')
    ELSE ''
  END)"""

QUOTE_RE2 = "|".join(
    [
        *[rf"^{name}:[{S}]" for name in ("From", "To", "Cc", "Date", "Subject")],
        rf"^-----Original Message-----[{S}]*$",
        rf"^On .+ wrote:[{S}]*$",
        rf"^在.+写道[:：][{S}]*$",
        *[rf"^{name}[:：]" for name in ("发件人", "发送时间", "收件人", "主题")],
    ]
)
SIGNATURE_RE2 = "|".join(
    [
        "^--$",
        rf"^--[{S}]",
        "^(?:Kind regards|Kind Regards|Best regards|Best Regards|Regards|Sincerely),?$",
        "^谢谢[!！]?$",
        rf"^此致[，,]?[{S}]*敬礼$",
    ]
)
FORWARD_RE2 = "|".join(
    [
        rf"^-{{5,}}[{S}]*转发的邮件信息[-{S}]*$",
        rf"^-{{5,}}[{S}]*Forwarded message[-{S}]*$",
        *[rf"^{name}[:：]" for name in ("发件人", "收件人", "抄送人", "主题", "日期")],
    ]
)
CONTACT_RE2 = "|".join(
    [
        *[rf"^{name}[{S}]*$" for name in ("Kind Regards", "Best Regards", "Regards")],
        rf"^谢谢[!！]?[{S}]*$",
        rf"^此致[，,]?[{S}]*敬礼[{S}]*$",
        *[rf"^{name}:[{S}]*\+?\d" for name in ("Office", "Mobile", "WhatsApp")],
        "^WeChat:",
        rf"^Email:[{S}]*support_",
    ]
)


def _documents(t: Tables, expression: str):
    return t.spread("documents").select("doc_id", F.expr(expression).alias("md"))


@query(
    "t1_newlines",
    f"SELECT doc_id, regexp_replace({BREAKS}, '\\r\\n?', chr(10), 'g') AS clean FROM documents",
)
def t1(t: Tables):
    return _documents(t, BREAKS).select("doc_id", X.normalise_newlines(F.col("md")).alias("clean"))


@query("t2_trailing_blanks", f"SELECT doc_id, {sql_clean(BREAKS)} AS clean FROM documents")
def t2(t: Tables):
    return _documents(t, BREAKS).select("doc_id", X.clean_text(F.col("md")).alias("clean"))


@query(
    "t3_strip_quoted",
    f"SELECT doc_id, cut FROM ({sql_cut(f'(SELECT doc_id, {QUOTES} AS md FROM documents)', 'md', '(?i)' + QUOTE_RE2)})",
)
def t3(t: Tables):
    return _documents(t, QUOTES).select("doc_id", X.strip_quoted(F.col("md")).alias("cut"))


@query(
    "t4_strip_signature",
    f"SELECT doc_id, cut FROM ({sql_cut(f'(SELECT doc_id, {SIGNATURES} AS md FROM documents)', 'md', SIGNATURE_RE2, trimmed=True)})",
)
def t4(t: Tables):
    return _documents(t, SIGNATURES).select("doc_id", X.strip_signature(F.col("md")).alias("cut"))


BOTH = f"concat({SIGNATURES}, chr(13), chr(10), {QUOTES})"
_CLEANED = f"(SELECT doc_id, {sql_clean(BOTH)} AS md FROM documents)"
_UNQUOTED = f"(SELECT doc_id, cut AS md2 FROM ({sql_cut(_CLEANED, 'md', '(?i)' + QUOTE_RE2)}))"


@query("t5_postprocess", f"SELECT doc_id, cut FROM ({sql_cut(_UNQUOTED, 'md2', SIGNATURE_RE2, trimmed=True)})")
def t5(t: Tables):
    return _documents(t, BOTH).select("doc_id", X.postprocess(F.col("md")).alias("cut"))


@query("t5_keep_quoted", f"SELECT doc_id, cut FROM ({sql_cut(_CLEANED, 'md', SIGNATURE_RE2, trimmed=True)})")
def t5_keep_quoted(t: Tables):
    return _documents(t, BOTH).select("doc_id", X.postprocess(F.col("md"), quoted=False).alias("cut"))


_HIT = sql_first("l", f"regexp_matches({{line}}, '{FORWARD_RE2}') OR regexp_matches({{line}}, '(?i){CONTACT_RE2}')")
_LAST = f"list_max(list_filter(range(1, hit), lambda i: regexp_matches(l[i], '[^{S}]')))"
FORWARD_SQL = f"""
  SELECT doc_id, md, CASE WHEN hit IS NULL THEN md
                          ELSE concat(array_to_string(l[1:coalesce({_LAST}, 0)], chr(10)), chr(10)) END AS cut
  FROM (SELECT *, {_HIT} AS hit
        FROM (SELECT *, {sql_lines('md')} AS l FROM (SELECT doc_id, {FORWARDS} AS md FROM documents)))"""


@query("t6_cut_forwarded", f"SELECT doc_id, cut FROM ({FORWARD_SQL})")
def t6(t: Tables):
    return _documents(t, FORWARDS).select("doc_id", X.cut_forwarded(F.col("md")).alias("cut"))


_BLANK_TAIL = "concat(text, ' ', chr(10), chr(9), chr(10), '　', chr(10), 'Regards', chr(10), source)"
_KEPT = f"list_max(list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '[^{S}]')))"


@query(
    "t7_trailing_blank_lines",
    f"SELECT doc_id, concat(array_to_string(l[1:coalesce({_KEPT}, 0)], chr(10)), chr(10)) AS cut "
    f"FROM (SELECT doc_id, {sql_lines("concat(text, ' ')")} AS l FROM documents)",
)
def t7(t: Tables):
    return _documents(t, _BLANK_TAIL).select("doc_id", X.cut_forwarded(F.col("md")).alias("cut"))


@query(
    "t8_count_changed",
    f"SELECT count(*) AS scanned, count(*) FILTER (WHERE cut <> md) AS cleaned FROM ({FORWARD_SQL})",
)
def t8(t: Tables):
    return count_changed(update_documents(_documents(t, FORWARDS), "md"))


TAILS = """concat(text, CASE doc_id % 4 WHEN 0 THEN '　' WHEN 1 THEN concat(chr(10), chr(9), ' ')
                                      WHEN 2 THEN concat(' .', chr(13), ' ') ELSE '' END)"""


@query("t9_right_trim", f"SELECT doc_id, {sql_rtrim(TAILS)} AS trimmed FROM documents")
def t9(t: Tables):
    return t.documents.select("doc_id", X.rstrip(F.expr(TAILS)).alias("trimmed"))


_LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


@query(
    "t10_oneline",
    f"""SELECT conv_id, turn, regexp_replace(regexp_replace(body, '(?:{_LINE_ENDS})$', ''), '{_LINE_ENDS}', ' ', 'g') AS line
        FROM (SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN '' ELSE concat(replace(text, '. ', concat('.', chr(13), chr(10))),
              CASE turn % 3 WHEN 0 THEN concat(chr(10), chr(10)) WHEN 1 THEN concat(chr(13), chr(10)) ELSE chr(11) END) END AS body
              FROM conversations)""",
)
def t10(t: Tables):
    body = F.expr(
        """CASE WHEN turn % 4 = 3 THEN NULL ELSE concat(replace(text, '. ', concat('.', chr(13), chr(10))),
           CASE turn % 3 WHEN 0 THEN concat(chr(10), chr(10)) WHEN 1 THEN concat(chr(13), chr(10)) ELSE chr(11) END) END"""
    )
    return t.conversations.select("conv_id", "turn", X.oneline(body).alias("line"))
