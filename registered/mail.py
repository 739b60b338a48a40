"""Mail operators over conversations turned into RFC 822 messages, and dates of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailspark.functions import dates
from mailspark.operators import markdown as D
from mailspark.operators import mime
from registered.base import S, Tables, query, sql_clean, sql_rtrim

CRLF = "concat(chr(13), chr(10))"

# Header text of each turn, as both engines build it.
SUBJECT = "concat('Thread ', conv_id, ' über turn ', turn)"
FROM = "concat('\"Lee, ', upper(role), '\" <', role, '@example.org>')"
TO = "concat('desk', turn, '@example.com')"
CC = "CASE WHEN turn % 3 = 0 THEN 'Team Lead <lead@example.net>' ELSE '' END"
DATE = """CASE conv_id % 4 WHEN 0 THEN 'Mon, 04 Mar 2024 09:15:22 +0000' WHEN 1 THEN 'Tue, 05 Mar 2024 22:10:00 +0900'
          WHEN 2 THEN 'Wed, 06 Mar 2024 23:59:59 -0330' ELSE 'sometime in March' END"""
DATE_ISO = """CASE conv_id % 4 WHEN 0 THEN '2024-03-04T09:15:22+00:00' WHEN 1 THEN '2024-03-05T22:10:00+09:00'
              WHEN 2 THEN '2024-03-06T23:59:59-03:30' ELSE NULL END"""
SENT_AT = """CASE conv_id % 4 WHEN 0 THEN '2024-03-04 09:15:22' WHEN 1 THEN '2024-03-05 13:10:00'
             WHEN 2 THEN '2024-03-07 03:29:59' ELSE NULL END"""
OFFSET = "CASE conv_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 540 WHEN 2 THEN -210 ELSE NULL END"
# Shapes: 0 plain, 1 alternative, 2 mixed with an attached text first, 3 html only, 4 blank plain + html.
SHAPE = "(turn % 5)"


def _part(content_type: str, text: str, disposition: str = "", charset: str = "utf-8") -> str:
    head = f"Content-Type: {content_type}; charset={charset}"
    extra = f", {CRLF}, 'Content-Disposition: {disposition}'" if disposition else ""
    coded = f"base64(encode({text}, '{charset.upper()}'))"
    return f"concat('{head}'{extra}, {CRLF}, 'Content-Transfer-Encoding: base64', {CRLF}, {CRLF}, {coded}, {CRLF})"


def _multipart(kind: str, *parts: str) -> str:
    pieces = "".join(f", '--b1', {CRLF}, {p}" for p in parts)
    return f"concat('Content-Type: multipart/{kind}; boundary=b1', {CRLF}, {CRLF}{pieces}, '--b1--', {CRLF})"


HTML = "concat('<p>', text, '</p>')"
BODY = f"""CASE {SHAPE}
  WHEN 0 THEN {_part('text/plain', 'text')}
  WHEN 1 THEN {_multipart('alternative', _part('text/plain', 'text'), _part('text/html', HTML))}
  WHEN 2 THEN {_multipart('mixed', _part('text/plain', "'notes'", 'ATTACHMENT; filename=n.txt'), _part('text/plain', 'text', charset='utf-16be'), _part('text/plain', "'second'"))}
  WHEN 3 THEN {_part('text/html', HTML)}
  ELSE {_multipart('alternative', _part('text/plain', "concat(' ', chr(10))"), _part('text/plain', "'later'"), _part('text/html', HTML))}
END"""


def mails(t: Tables, body: str = BODY):
    """``conv_id, turn, content``: one message per turn."""
    raw = F.expr(
        f"""concat('Subject: =?utf-8?B?', base64(encode({SUBJECT}, 'UTF-8')), '?=', {CRLF}, 'From: ', {FROM}, {CRLF}, 'To:  ', {TO}, {CRLF},
                   CASE WHEN {CC} = '' THEN '' ELSE concat('Cc: ', {CC}, {CRLF}) END, 'Date: ', {DATE}, {CRLF},
                   'MIME-Version: 1.0', {CRLF}, {body})"""
    )
    return t.conversations.select("conv_id", "turn", F.encode(raw, "UTF-8").alias("content"))


# What the chosen body is, and the document made of it.
BODY_KIND_SQL = f"CASE WHEN {SHAPE} >= 3 THEN 'html' ELSE 'plain' END"
BODY_SQL = f"CASE WHEN {SHAPE} >= 3 THEN {HTML} ELSE text END"
FROM_SQL = "concat('\"Lee, ', upper(role), '\" <', role, '@example.org>')"


@query(
    "m1_parse_mail",
    f"""SELECT conv_id, turn, {SUBJECT} AS subject, {FROM_SQL} AS from_addr, {TO} AS to_addr, {CC} AS cc_addr, {DATE} AS date_raw,
               {SHAPE} NOT IN (0, 3) AS is_multipart,
               CASE {SHAPE} WHEN 0 THEN 1 WHEN 3 THEN 1 WHEN 1 THEN 3 ELSE 4 END AS n_parts, NULL::VARCHAR AS parse_error
        FROM conversations""",
)
def m1(t: Tables):
    parsed = mime.parse_mail(mails(t))
    return parsed.withColumn("n_parts", F.size("parts")).drop("parts")


@query(
    "m2_flatten_parts",
    f"""SELECT conv_id, turn, unnest(CASE {SHAPE} WHEN 0 THEN [0] WHEN 1 THEN [1, 2] WHEN 2 THEN [2, 3] WHEN 3 THEN [0] ELSE [1, 2, 3] END) AS part_no,
               unnest(CASE {SHAPE} WHEN 0 THEN ['text/plain'] WHEN 1 THEN ['text/plain', 'text/html'] WHEN 2 THEN ['text/plain', 'text/plain']
                      WHEN 3 THEN ['text/html'] ELSE ['text/plain', 'text/plain', 'text/html'] END) AS content_type,
               unnest(CASE {SHAPE} WHEN 0 THEN [text] WHEN 1 THEN [text, {HTML}] WHEN 2 THEN [text, 'second']
                      WHEN 3 THEN [{HTML}] ELSE [concat(' ', chr(10)), 'later', {HTML}] END) AS part_text
        FROM conversations""",
)
def m2(t: Tables):
    parts = mime.explode_parts(mime.parse_mail(mails(t)))
    return parts.select("conv_id", "turn", "part_no", "content_type", F.col("text").alias("part_text"))


@query("m3_best_body", f"SELECT conv_id, turn, {BODY_KIND_SQL} AS body_kind, {BODY_SQL} AS body FROM conversations")
def m3(t: Tables):
    return mime.best_body(mime.parse_mail(mails(t))).select("conv_id", "turn", "body_kind", "body")


LONE = f"""CASE turn % 3 WHEN 0 THEN {_part('text/html', HTML)} WHEN 1 THEN {_part('image/png', 'text')} ELSE
           concat('Content-Transfer-Encoding: 8bit', {CRLF}, {CRLF}, text) END"""


@query(
    "m4_single_part",
    f"""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'html' ELSE 'plain' END AS body_kind,
               CASE WHEN turn % 3 = 0 THEN {HTML} ELSE text END AS body FROM conversations""",
)
def m4(t: Tables):
    return mime.best_body(mime.parse_mail(mails(t, LONE))).select("conv_id", "turn", "body_kind", "body")


def _coded(charset_header: str, raw: str) -> str:
    return f"""concat('Content-Type: text/plain{charset_header}', {CRLF}, 'Content-Transfer-Encoding: base64', {CRLF}, {CRLF}, base64({raw}))"""


CHARSETS = f"""CASE turn % 4
  WHEN 0 THEN {_coded('; charset=utf-16-le', "encode(text, 'UTF-16LE')")}
  WHEN 1 THEN {_coded('; charset=no-such-set', "encode(text, 'UTF-8')")}
  WHEN 2 THEN {_coded('', "encode(text, 'UTF-8')")}
  ELSE {_coded('; charset=utf-8', "unhex(concat(hex(encode(text, 'UTF-8')), 'FF', hex(encode(role, 'UTF-8'))))")}
END"""


@query(
    "m5_charsets",
    """SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN concat(text, chr(65533), role) ELSE text END AS body FROM conversations""",
)
def m5(t: Tables):
    return mime.best_body(mime.parse_mail(mails(t, CHARSETS))).select("conv_id", "turn", "body")


@query(
    "m6_headers",
    f"""SELECT conv_id, turn, {SUBJECT} AS subject, {FROM_SQL} AS from_addr, {TO} AS to_addr, {CC} AS cc_addr, {DATE} AS date_raw,
               {DATE_ISO} AS date_iso, {SENT_AT} AS sent_at, {OFFSET} AS tz_offset_min FROM conversations""",
)
def m6(t: Tables):
    projected = D.project_headers(mime.parse_mail(mails(t)))
    return projected.select(
        "conv_id", "turn", "subject", "from_addr", "to_addr", "cc_addr", "date_raw", "date_iso",
        F.date_format("sent_at", "yyyy-MM-dd HH:mm:ss").alias("sent_at"), "tz_offset_min",
    )


# Order dates as mail dates: offsets, a missing zone, zone names, and texts that are no date.
ORDER_DATE = """CASE o_orderkey % 6
  WHEN 0 THEN concat({d}, ' +0530') WHEN 1 THEN concat({d}, ' -0000') WHEN 2 THEN concat({d}, ' EST')
  WHEN 3 THEN {d} WHEN 4 THEN concat('Thu, 31 Feb ', o_orderkey + 1000, ' 10:00:00 +0000') ELSE concat({d}, ' -0800 (PST)') END"""


@query(
    "m7_date_iso",
    """SELECT o_orderkey,
              CASE WHEN o_orderkey % 6 = 4 THEN NULL ELSE concat(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'),
                CASE o_orderkey % 6 WHEN 0 THEN '+05:30' WHEN 2 THEN '-05:00' WHEN 5 THEN '-08:00' ELSE '' END) END AS date_iso,
              CASE WHEN o_orderkey % 6 = 0 THEN 330 WHEN o_orderkey % 6 = 2 THEN -300 WHEN o_orderkey % 6 = 5 THEN -480
                   WHEN o_orderkey % 6 = 4 AND o_orderkey + 1000 < 10000 THEN 0 ELSE NULL END AS tz_offset_min
       FROM orders""",
)
def m7(t: Tables):
    text = F.expr(ORDER_DATE.format(d="date_format(o_orderdate, 'EEE, dd MMM yyyy HH:mm:ss')"))
    return t.orders.select(
        "o_orderkey", dates.rfc2822_to_iso(text).alias("date_iso"), dates.tz_offset_minutes(text).alias("tz_offset_min")
    )


HEADER_COLUMNS = [
    "CASE WHEN conv_id % 3 = 0 THEN '' ELSE concat('Thread ', conv_id) END AS subject",
    "CASE WHEN turn % 2 = 0 THEN '' ELSE concat(role, '@example.org') END AS from_addr",
    "CASE WHEN conv_id % 5 = 0 THEN 'desk@example.com' ELSE '' END AS to_addr",
    "CASE WHEN turn % 4 = 1 THEN 'lead@example.net' ELSE '' END AS cc_addr",
    "CASE WHEN conv_id % 2 = 0 THEN '' WHEN turn % 2 = 0 THEN 'once' ELSE 'Mon, 04 Mar 2024 09:15:22 +0000' END AS date_raw",
]
HEADERS = ", ".join(HEADER_COLUMNS)
_ITEMS = """concat(CASE WHEN from_addr = '' THEN '' ELSE concat('- From: ', from_addr, chr(10)) END,
  CASE WHEN to_addr = '' THEN '' ELSE concat('- To: ', to_addr, chr(10)) END,
  CASE WHEN cc_addr = '' THEN '' ELSE concat('- Cc: ', cc_addr, chr(10)) END,
  CASE WHEN date_raw = '' THEN '' WHEN date_raw = 'once' THEN concat('- Date: once', chr(10))
       ELSE concat('- Date: 2024-03-04T09:15:22+00:00', chr(10)) END)"""
_HEADER = f"""concat(CASE WHEN subject = '' THEN '' ELSE concat('# ', subject, chr(10)) END,
  CASE WHEN {_ITEMS} = '' THEN '' ELSE concat(CASE WHEN subject = '' THEN '' ELSE chr(10) END, {_ITEMS}, chr(10), '---', chr(10)) END)"""
_WITH_HEADERS = f"(SELECT conv_id, turn, text, {HEADERS} FROM conversations)"


@query("m8_header_block", f"SELECT conv_id, turn, {_HEADER} AS header FROM {_WITH_HEADERS}")
def m8(t: Tables):
    df = t.conversations.selectExpr("conv_id", "turn", *HEADER_COLUMNS)
    return D.render_header(D.project_headers(df)).select("conv_id", "turn", "header")


@query(
    "m9_to_markdown",
    f"SELECT conv_id, turn, concat({sql_rtrim(sql_clean(f'concat({_HEADER}, chr(10), text)'))}, chr(10)) AS markdown FROM {_WITH_HEADERS}",
)
def m9(t: Tables):
    df = t.conversations.selectExpr("conv_id", "turn", "text AS body", "'plain' AS body_kind", *HEADER_COLUMNS)
    return D.to_markdown(D.project_headers(df), keep_quoted=True, keep_signature=True).select("conv_id", "turn", "markdown")


@query(
    "m9_mail_to_markdown",
    f"""SELECT conv_id, turn, concat({sql_rtrim(sql_clean("concat('# ', subject, chr(10), chr(10), '- From: ', from_addr, chr(10), '- To: ', to_addr, chr(10), cc, '- Date: ', date, chr(10), chr(10), '---', chr(10), chr(10), body)"))}, chr(10)) AS markdown
        FROM (SELECT conv_id, turn, {SUBJECT} AS subject, {FROM_SQL} AS from_addr, {TO} AS to_addr,
                     CASE WHEN {CC} = '' THEN '' ELSE concat('- Cc: ', {CC}, chr(10)) END AS cc, coalesce({DATE_ISO}, {DATE}) AS date,
                     CASE WHEN {SHAPE} >= 3 THEN concat(regexp_replace(regexp_replace(regexp_replace(text, '[ \\t\\n]+', ' ', 'g'), '^ +', ''), ' +$', ''), chr(10)) ELSE text END AS body
              FROM conversations)""",
)
def m9_mail(t: Tables):
    from mailspark.plans.stages import mail_to_markdown

    return mail_to_markdown(mails(t)).select("conv_id", "turn", "markdown")


_HTML_RULES = [
    (
        r"(?i)<!--[\s\S]*?(?:-->|$)|<script\b[\s\S]*?(?:</script\s*>|$)|<style\b[\s\S]*?(?:</style\s*>|$)"
        r"|<title\b[\s\S]*?(?:</title\s*>|$)|<!doctype[^>]*>",
        "",
    ),
    (r"[ \t\n\r\f]+", " "),
    (r'(?i)<img src="([^"]*)" alt="([^"]*)">', r"![\2](\1)"),
    (r'(?i)<img\b[^>]*?\bsrc="([^"]*)"[^>]*>', r"![](\1)"),
    (r"(?i)</?(?:strong|b)(?:\s[^>]*)?>", "**"),
    (r"(?i)</?(?:em|i)(?:\s[^>]*)?>", "*"),
    (r"(?i)</?(?:code|tt|kbd)(?:\s[^>]*)?>", "`"),
    (r"(?i)</?(?:span|font|u|small)(?:\s[^>]*)?>", ""),
    (r'(?i)<a\b[^>]*?\bhref="([^"]*)"[^>]*>([^<]*)</a\s*>', r"[\2](\1)"),
    (r"(?i)<br\b[^>]*>", "\n"),
    (r"(?i)<hr\b[^>]*>", "\n\n---\n\n"),
    *[(rf"(?i)<h{n}\b[^>]*>", "\n\n" + "#" * n + " ") for n in range(1, 7)],
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (r"(?i)<li\b[^>]*>", "\n- "),
    (
        r"(?i)</?(?:p|div|article|body|footer|html|nav|ul|ol|section|header|main|aside|form|table|tbody|thead|tfoot|tr"
        r"|blockquote|pre|center|address|dl|dt|dd|fieldset|figure|figcaption)(?:\s[^>]*)?>",
        "\n\n",
    ),
    (r"</?[A-Za-z][^>]*>", ""),
]


def _html_sql(x: str) -> str:
    x = sql_clean(x)
    for pattern, replacement in _HTML_RULES:
        pattern = pattern.replace("'", "''")
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')"
    for entity, char in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&reg;", "®"),
        ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&#39;", "''"), ("&#8217;", "’"), ("&#x27;", "''"),
        ("&#169;", "©"), ("&#64;", "@"), ("&amp;", "&"),
    ):
        x = f"replace({x}, '{entity}', '{char}')"
    x = f"regexp_replace(regexp_replace({x}, ' *\\n *', chr(10), 'g'), '\\n{{3,}}', '\n\n', 'g')"
    return f"concat(regexp_replace(regexp_replace({x}, '^[{S}]+', ''), '[{S}]+$', ''), chr(10))"


_PAGE = """concat(html, '<h2 class="x">Q&#38;A</h2><p>It&#8217;s <B>bold</B>, <em>so</em> <code>a=1</code>&hellip;<br/>next<ol><li>one<li><a href="/x?a=1">two</a></ol>',
           '<img src="/i.png" alt="x"><hr>&#x27;&#169;&copy;&lt;p&gt;', url, '<script>var x = "<p>";')"""


@query("h1_html_to_markdown", f"SELECT page_id, {_html_sql(_PAGE.replace('&#38;', '&amp;'))} AS markdown FROM pages")
def h1(t: Tables):
    return D.html_to_markdown(t.spread("pages").select("page_id", F.expr(_PAGE).alias("html")), "html").select("page_id", "markdown")


# Attributes whose names end like others, table cells, end tags with blanks, names of HTML5: expected by hand.
_LOOKALIKE = r"""concat('<p><img data-src="real.jpg" src="/i', page_id, '.gif"><a data-href="no" href = "/y">yes</a> <a data-href="no">none</a> &lbrace;x&rbrace;&NotEqualTilde;&AMP;lt;</p>',
  '<table><tr><th>a</th><th class="n">b</th></tr><tr><td>1</td> <td>', page_id, '</td></tr></table><pre>x', chr(10), 'y</pre ><p>behind</p>')"""


@query(
    "h1_lookalikes_cells",
    """SELECT page_id, concat('![](/i', page_id, '.gif)[yes](/y) none {x}', chr(8770), chr(824), '&lt;', chr(10), chr(10), 'a | b', chr(10), chr(10), '1 | ', page_id, chr(10), chr(10),
              '```', chr(10), 'x', chr(10), 'y', chr(10), '```', chr(10), chr(10), 'behind', chr(10)) AS markdown FROM pages""",
)
def h1_lookalikes(t: Tables):
    return D.html_to_markdown(t.spread("pages").select("page_id", F.expr(_LOOKALIKE).alias("html")), "html").select("page_id", "markdown")


# Blocks of code, alternative texts, attributes in every spelling, entities: expected by hand.
_MARKED = r"""concat('<p>M&uuml;ller &euro;5 &#00000038; &#x2013; &amp;lt; &unknown;</p><pre class=x><code>line ', page_id, chr(10), '  if a &lt; b:', chr(10), '    *c*</code></pre>',
  "<p><img alt='the fan' src=/f", page_id, '.png> <img src="g.png"> <a class=b href=', "'https://example.org/", page_id, "'>see</a> <a href=https://example.org>bare</a></p>")"""


@query(
    "h1_code_alt_links",
    """SELECT page_id, concat('Müller €5 & – &lt; &unknown;', chr(10), chr(10), '```', chr(10), 'line ', page_id, chr(10), '  if a < b:', chr(10), '    *c*', chr(10), '```', chr(10), chr(10),
              '![the fan](/f', page_id, '.png) ![](g.png) [see](https://example.org/', page_id, ') [bare](https://example.org)', chr(10)) AS markdown FROM pages""",
)
def h1_marked(t: Tables):
    return D.html_to_markdown(t.spread("pages").select("page_id", F.expr(_MARKED).alias("html")), "html").select("page_id", "markdown")
