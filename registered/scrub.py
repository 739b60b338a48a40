"""Scrub rules, audit and dictionary over ``documents``, with personal data of every kind
put in by one expression that both engines run."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mailspark.functions import pii
from mailspark.operators import ledger as L
from mailspark.operators import model as M
from mailspark.operators import requests as R
from mailspark.operators import responses as A
from mailspark.operators import scrub as P
from mailspark.session import work_dir
from registered.base import Tables, query

# Every document gets lines with data of every kind.  A piece is its text, and the rule that must
# replace it with what; pieces without a rule stay.  The checks put the expected text together from
# the pieces; patterns of their own they use on the documents' own text only.
_LONG_NUMBER, _LONG_CODE, _LONG_NAME = "'" + "7" * 60 + "'", "'" + "A1" * 30 + "'", "'" + "ab1_" * 15 + "'"
PIECES: list[tuple[str, str | None, str]] = [
    ("concat(chr(10), 'mail: ')", None, ""), ("concat(source, '.user+', doc_id, '@', lang, '-corp.example.com')", "email", "<EMAIL>"),
    ("'; cc '", None, ""), ("concat('müller', doc_id, '@firma.de')", "email", "<EMAIL>"),
    ("', '", None, ""), ("concat('info', doc_id, '@müller.de')", "email", "<EMAIL>"), ("' or '", None, ""), ("concat('o''brien', doc_id, '@firma.de')", "email", "<EMAIL>"),
    ("' ('", None, ""), ("concat('a=b', doc_id, '@firma.de')", "email", "<EMAIL>"), ("')'", None, ""),
    ("' 请将日志发送到'", None, ""), ("concat('support', doc_id, '@firma.de')", "email", "<EMAIL>"), ("'谢谢'", None, ""),
    ("concat(chr(10), 'call ')", None, ""), ("concat('+49-30-', 1000000 + doc_id)", "phone_international", "<PHONE>"),
    ("' or 电话'", None, ""), ("concat('13', 800000000 + doc_id)", "phone_label", "<PHONE>"), ("'元 or '", None, ""),
    ("concat('15', 800000000 + doc_id)", "phone_mobile", "<PHONE>"),
    ("' tel: '", None, ""), ("concat('030 ', 10000 + doc_id)", "phone_label", "<PHONE>"), ("', fax '", None, ""), (_LONG_NUMBER, "phone_label", "<PHONE>"),
    ("'; phone: '", None, ""), ("concat('(555) 123 ', 10000 + doc_id)", "phone_label", "<PHONE>"), ("', Tel. '", None, ""), ("concat('030/', 1000000 + doc_id)", "phone_label", "<PHONE>"),
    ("', Phone: '", None, ""), ("concat('555.123.', 1000 + doc_id)", "phone_label", "<PHONE>"), ("', '", None, ""), ("concat('+49/30/', 1000000 + doc_id)", "phone_international", "<PHONE>"),
    ("', Intel 13900 24 cores'", None, ""),
    ("concat(chr(10), 'WeChat: ')", None, ""), ("concat('wx_', doc_id, 'abc')", "messenger", "<ACCOUNT>"), ("' QQ号：'", None, ""),
    ("concat(10000 + doc_id, '')", "messenger", "<ACCOUNT>"), ("' Telegram id: '", None, ""), ("concat('@bot', doc_id)", "messenger", "<ACCOUNT>"),
    ("' 微信 '", None, ""), ("concat('wx_', doc_id)", "messenger", "<ACCOUNT>"), ("' WeChat ID is '", None, ""), ("concat('wx_', doc_id)", "messenger", "<ACCOUNT>"),
    ("' wechat: '", None, ""), (_LONG_NAME, "messenger", "<ACCOUNT>"), ("', WeChat works'", None, ""),
    ("', QQ '", None, ""), ("concat(123400000 + doc_id, '')", "messenger", "<ACCOUNT>"), ("', Telegram '", None, ""), ("concat('@some', lang, 'body')", "messenger", "<ACCOUNT>"), ("', QQ group'", None, ""),
    ("concat(chr(10), 'Order No. ')", None, ""), ("concat('ABCDE-', 20240 + doc_id)", "order_id", "<ORDER_ID>"), ("', invoice #'", None, ""),
    ("concat(7000 + doc_id, '')", "order_id", "<ORDER_ID>"), ("' 合同编号：'", None, ""), ("concat('HT', 99000 + doc_id)", "order_id", "<ORDER_ID>"),
    ("' 发票号码：'", None, ""), ("concat(12340000 + doc_id, '')", "order_id", "<ORDER_ID>"), ("' 订单号是：'", None, ""),
    ("concat('A', 12340000 + doc_id)", "order_id", "<ORDER_ID>"), ("' order no. '", None, ""), (_LONG_NUMBER, "order_id", "<ORDER_ID>"),
    ("', order no. '", None, ""), ("concat('AB', 12345 + doc_id, '/0815')", "order_id", "<ORDER_ID>"), ("', Order ID '", None, ""), ("concat('ORD_2024_', 77 + doc_id)", "order_id", "<ORDER_ID>"),
    ("', contract '", None, ""), ("concat('C_', 77123 + doc_id)", "order_id", "<ORDER_ID>"), ("', invoice: '", None, ""), ("concat('INV.2024.', 55 + doc_id)", "order_id", "<ORDER_ID>"),
    ("' order 5 units, in order 2024-01-01, invoice 2024Q3, the recorder 12345'", None, ""),
    ("chr(10)", None, ""), ("concat('SN-HR-2024-', doc_id)", "serial", "<SERIAL>"), ("' serial number: '", None, ""),
    ("concat('X', 1000 + doc_id, 'Z')", "serial_label", "<SERIAL>"), ("' S/N#'", None, ""), ("concat(55555 + doc_id, '')", "serial_label", "<SERIAL>"),
    ("' serial: '", None, ""), (_LONG_CODE, "serial_label", "<SERIAL>"),
    ("', S/N '", None, ""), ("concat('A1B2C', 1000 + doc_id)", "serial_label", "<SERIAL>"), ("', SN: '", None, ""), ("concat('ABC', 10000 + doc_id)", "serial_label", "<SERIAL>"),
    ("', serial number '", None, ""), ("concat('ABC', 10000 + doc_id)", "serial_label", "<SERIAL>"), ("', serial RS232 cable'", None, ""),
    ("concat(chr(10), 'host ')", None, ""), ("concat('10.', doc_id % 256, '.3.4')", "ip", "<IP>"), ("' and '", None, ""),
    ("concat('172.', doc_id % 32, '.1.1')", "ip", "<IP>"), ("' v1.2.3 firmware 1.0.21.3 '", None, ""), ("concat('nas', doc_id, '.corp')", "internal_host", "<HOST>"),
    ("' '", None, ""), ("'vpn-gw.internal'", "internal_host", "<HOST>"), ("' '", None, ""), ("'vpn.firma.com'", "internal_host", "<HOST>"),
    ("' '", None, ""), ("concat('nas', doc_id, '.corp.example.com')", "internal_host", "<HOST>"), ("', '", None, ""), ("concat('2001:db8::', doc_id % 10000)", "ip", "<IP>"), ("' at 12:34:56'", None, ""),
    ("concat(chr(10), 'id ')", None, ""), ("concat('110105', 1950 + doc_id % 50, '0', doc_id % 9 + 1, '12123X')", "national_id", "<ID_NUMBER>"),
    ("' card '", None, ""), ("'4111 1111 1111 1111'", "card", "<CARD>"), ("' and 4111111111111112'", None, ""),
    ("concat(chr(10), 'see https://docs.example.org/a', doc_id)", None, ""), ("concat('?token=s', doc_id, '&x=1')", "url_query", ""),
    ("' and '", None, ""), ("concat('https://firma.sharepoint.com/p/tok', doc_id, '/x')", "share_link", "<LINK>"),
    ("' and https://example.org/b#c torque 12.5 Nm'", None, ""),
]
PERSONAL = f"concat(text, {', '.join(piece for piece, _, _ in PIECES)})"

_W = r"\b"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# For the documents' own text, which holds e-mail addresses, numbers and keys, but none of the labels.
RULES_RE2: dict[str, tuple[str, str]] = {
    "share_link": (rf"https?://(?:[A-Za-z0-9-]+\.)*(?:{'|'.join(h.replace('.', '[.]') for h in pii.SHARE_HOSTS)})(?:[/?#][^\s<>]*)?", "<LINK>"),
    "url_query": (r"(https?://[^\s?#<>]+)\?[^\s<>)]+", r"\1"),
    "email": (r"[\p{L}\p{N}._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<EMAIL>"),
    "national_id": (rf"{_W}[1-9]\d{{5}}(?:18|19|20)\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{{3}}[\dXx]{_W}", "<ID_NUMBER>"),
    "order_id": (rf"(?i)({_W}(?:order|contract|invoice))(\s?(?:no\.|no|number|id)\s?[:#]?\s?|\s?[:#]\s?)[A-Z-]*\d[A-Z0-9-]{{3,}}", r"\1\2<ORDER_ID>"),
    "serial_label": (rf"(?i)({_W}(?:serial number|serial no\.|serial|S/N))(\s?[:#]\s?)[A-Z0-9-]{{5,}}", r"\1\2<SERIAL>"),
    "serial": (rf"{_W}SN-[A-Z0-9]+(?:-[A-Z0-9]+)*", "<SERIAL>"),
    "ip": (rf"{_W}{_OCTET}(?:\.{_OCTET}){{3}}{_W}", "<IP>"),
    "internal_host": (rf"(?i){_W}[a-z0-9][a-z0-9.-]*\.(?:corp|internal|intranet|lan|local|vpn){_W}", "<HOST>"),
    "messenger": (rf"(?i)({_W}(?:wechat|weixin|qq|telegram))(\s?(?:id|no)?\s?:\s?)@?[A-Za-z0-9_-]{{4,}}", r"\1\2<ACCOUNT>"),
    "phone_label": (rf"(?i)({_W}(?:phone|tel|fax|mobile|whatsapp))(\s?[.:]?\s?)\+?\d(?:[ ()-]{{0,3}}\d){{5,}}", r"\1\2<PHONE>"),
    "phone_international": (r"\+(?:[ .()-]{0,2}\d){7,}\)?", "<PHONE>"),
    "phone_mobile": (rf"{_W}1[3-9]\d{{9}}{_W}", "<PHONE>"),
}


def _sql_rule(name: str, x: str) -> str:
    pattern, replacement = RULES_RE2[name]
    return f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')"


def _sql_hits(name: str, x: str) -> str:
    return f"len(regexp_extract_all({x}, '{RULES_RE2[name][0]}'))"


_CARD = rf"{_W}\d(?:[ -]?\d){{12,18}}{_W}"
_DIGITS = "string_split(reverse(regexp_replace(c, '[ -]', '', 'g')), '')"
_DOUBLED = f"list_transform({_DIGITS}, lambda d, i: CASE WHEN i % 2 = 0 THEN (d::INT * 2) // 10 + (d::INT * 2) % 10 ELSE d::INT END)"
_VALID = f"list_filter(list_distinct(regexp_extract_all(x, '{_CARD}')), lambda c: list_sum({_DOUBLED}) % 10 = 0)"


def _sql_cards(x: str) -> str:
    """Replace every card candidate whose digits pass the Luhn sum."""
    cards = _VALID.replace("(x,", f"({x},")
    longest_first = f"list_reverse_sort(list_transform({cards}, lambda c: {{'n': len(c), 'c': c}}))"
    texts = f"list_transform({longest_first}, lambda s: s.c)"
    return f"list_reduce(list_concat([{x}], {texts}), lambda acc, c: replace(acc, c, '<CARD>'))"


def _sql_scrub(x: str) -> str:
    for name in RULES_RE2:
        x = _sql_rule(name, x)
    return x


def _expected(rules, text: str = "text") -> str:
    """The text after the rules: their patterns on the document's own text, the pieces by hand."""
    rules = list(rules)
    for name in rules:
        text = _sql_cards(text) if name == "card" else _sql_rule(name, text)
    pieces = [f"'{mark}'" if rule in rules else piece for piece, rule, mark in PIECES]
    return f"concat({text}, {', '.join(pieces)})"


def _documents(t: Tables):
    return t.spread("documents").select("doc_id", F.expr(PERSONAL).alias("md"))


def _by_rules(query_name: str, *rules: pii.Rule):
    @query(query_name, f"SELECT doc_id, {_expected([r.name for r in rules])} AS md FROM documents")
    def run(t: Tables):
        return P.scrub(_documents(t), "md", rules, cards=False)


_by_rules("p1_email", pii.EMAIL)
_by_rules("p2_phone", pii.PHONE_LABEL, pii.PHONE_INTERNATIONAL, pii.PHONE_MOBILE)
_by_rules("p3_messenger", pii.MESSENGER)
_by_rules("p4_order_id", pii.ORDER)
_by_rules("p5_serial", pii.SERIAL_LABEL, pii.SERIAL)


@query(
    "p6_ip_and_host",
    f"""SELECT doc_id, {_expected(['ip', 'internal_host'])} AS md, n_private + 1 + (doc_id % 32 >= 16)::INT AS n_private_ip,
               n_total - n_private + (doc_id % 32 < 16)::INT + 1 AS n_public_ip
        FROM (SELECT *, {_sql_hits('ip', 'text')} AS n_total,
                     len(list_filter(regexp_extract_all(text, '{RULES_RE2['ip'][0]}'),
                         lambda a: a LIKE '10.%' OR a LIKE '192.168.%' OR regexp_matches(a, '^172\\.(1[6-9]|2\\d|3[01])\\.'))) AS n_private
              FROM documents)""",
)
def p6(t: Tables):
    return P.scrub(P.classify_ips(_documents(t), "md"), "md", (pii.IP, pii.INTERNAL_HOST), cards=False)


@query("p7_card_and_id", f"SELECT doc_id, {_expected(['card', 'national_id'])} AS md FROM documents")
def p7(t: Tables):
    return P.scrub(_documents(t), "md", (pii.NATIONAL_ID,), cards=True)


# Names in every position; a name inside a word or a compound is none.
_NAMED = """concat(text, chr(10), 'Dear Dr. ', source, ' Weber and ', lang, ' Desk, regards ', source, chr(10), 'Weber, Jo. Li: Lidar and Li-ion, Limit; J')"""
_NAMED_SQL = "concat(text, chr(10), 'Dear <NAME> and <NAME>, regards <NAME>, Jo. <NAME>: Lidar and Li-ion, Limit; <NAME>')"


@query("p8_header_names", f"SELECT doc_id, {_NAMED_SQL} AS md FROM documents")
def p8(t: Tables):
    headed = t.documents.select(
        "doc_id",
        F.expr(_NAMED).alias("md"),
        F.expr("""concat('"Dr. ', source, ' Weber" <w@example.org>, ', source, ' Weber <x@example.org>, Li <l@example.org>')""").alias("from_addr"),
        F.expr("concat(lang, ' Desk <d@example.org>, bare@example.org')").alias("to_addr"),
        F.lit("J <j@example.org>").alias("cc_addr"),
    )
    return P.scrub_header_names(headed, "md").select("doc_id", "md")


_CUSTOMER = "concat('Customer#', lpad(CAST(doc_id * 3 AS {string}), 9, '0'))"
_CUSTOMER_NAMED = f"concat(text, chr(10), 'Contact ', {_CUSTOMER.format(string='STRING')}, ', (Customer#000000007). Jo and John met Johanna; Anna', chr(10), 'Maria 张伟先生，李明，东海公司')"


@query(
    "p8_dictionary",
    f"""SELECT doc_id, concat(text, chr(10), 'Contact ', CASE WHEN {_CUSTOMER.format(string='VARCHAR')} IN (SELECT c_name FROM customer) THEN '<NAME>' ELSE {_CUSTOMER.format(string='VARCHAR')} END,
               ', (<NAME>). <NAME> and John met Johanna; <NAME> <NAME>先生，<NAME>，<ORG>') AS md FROM documents""",
)
def p8_dictionary(t: Tables):
    docs = t.spread("documents").select("doc_id", F.expr(_CUSTOMER_NAMED).alias("md"))
    more = t.spark.createDataFrame([("Jo", None), ("Anna Maria", None), ("李明", None), ("张伟", None), ("东海公司", "<ORG>")], "name string, mark string")
    names = t.customer.select(F.col("c_name").alias("name"), F.lit("<NAME>").alias("mark")).unionByName(more)
    return P.scrub_dictionary(docs, names, "md", key="doc_id", placeholder_col="mark")


@query("p9_link_queries", f"SELECT doc_id, {_expected(['share_link', 'url_query'])} AS md FROM documents")
def p9(t: Tables):
    return _documents(t).select("doc_id", pii.strip_link_queries(F.col("md")).alias("md"))


@query("p10_scrub_all", f"SELECT doc_id, {_expected(['card', *RULES_RE2])} AS md FROM documents")
def p10(t: Tables):
    return P.scrub(_documents(t), "md")


# How often each rule hits the pieces: a number behind 电话 is a mobile number as well.
_INJECTED = {name: sum(rule == name for _, rule, _ in PIECES) for name in RULES_RE2} | {"phone_mobile": 2}
_AUDIT = " UNION ALL ".join(
    f"""SELECT '{n}' AS rule, sum({_sql_hits(n, 'text')} + {k})::BIGINT AS hits_before,
               {'0::BIGINT' if n in ('email', 'ip') else f"sum({_sql_hits(n, 'clean')} + {k})::BIGINT"} AS hits_after,
               {'0::BIGINT' if n in ('email', 'ip') else 'count(*)'} AS docs_with_residue FROM scrubbed"""
    for n, k in _INJECTED.items()
)


@query(
    "p11_leak_audit",
    f"WITH scrubbed AS (SELECT text, {_sql_rule('ip', _sql_rule('email', 'text'))} AS clean FROM documents) {_AUDIT}",
)
def p11(t: Tables):
    docs = _documents(t)
    docs = P.scrub(docs.withColumn("clean", F.col("md")), "clean", (pii.EMAIL, pii.IP), cards=False)
    return P.leak_audit(docs, "md", "clean")


_KEY = "concat('doc-', doc_id, '.md')"


@query(
    "p12_scrub_request",
    f"""SELECT doc_id, 'system' AS role1, 'Remove personal data.' AS content1, 'user' AS role2,
               concat('<document name="', {_KEY}, '">', chr(10), text, chr(10), '</document>', chr(10),
                      'Return it without personal data, as JSON: {{"markdown": "..."}}') AS content2
        FROM documents""",
)
def p12(t: Tables):
    docs = t.documents.select("doc_id", F.expr(_KEY).alias("doc_key"), F.col("text").alias("markdown"))
    asked = R.scrub_request(docs, "Remove personal data.")
    first, second = F.col("messages")[0], F.col("messages")[1]
    return asked.select(
        "doc_id", first["role"].alias("role1"), first["content"].alias("content1"),
        second["role"].alias("role2"), second["content"].alias("content2"),
    )


# Answers of every kind, made of the documents themselves.
def _answers(t: Tables):
    text = "to_json(struct(text AS markdown))"
    return t.documents.select(
        "doc_id",
        F.expr(
            f"""CASE doc_id % 9 WHEN 0 THEN {text} WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN concat('{{"markdown":', n_chars, '}}')
                WHEN 4 THEN concat('[', {text}, ']') WHEN 5 THEN concat({text}, ' done') WHEN 6 THEN '{{"markdown":""}}'
                WHEN 7 THEN to_json(struct(text AS md)) ELSE concat('  ', {text}, chr(10)) END"""
        ).alias("response"),
    )


@query(
    "p13_scrub_response",
    """SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN 'ok' WHEN 1 THEN 'empty' WHEN 2 THEN 'empty' WHEN 3 THEN 'no_markdown' WHEN 4 THEN 'not_object'
                WHEN 5 THEN 'bad_json' WHEN 6 THEN 'ok' WHEN 7 THEN 'no_markdown' ELSE 'ok' END AS status,
              CASE doc_id % 9 WHEN 0 THEN text WHEN 8 THEN text WHEN 6 THEN '' ELSE NULL END AS markdown FROM documents""",
)
def p13(t: Tables):
    return A.scrubbed_text(_answers(t)).select("doc_id", "status", "markdown")


@query(
    "p14_gate",
    "SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)",
)
def p14(t: Tables):
    results = t.labels.select(
        F.col("doc_id").cast("string").alias("doc_key"), F.when(F.col("toxic") == 0, "ok").otherwise("bad_json").alias("status")
    )
    return L.gate(t.documents.select("doc_id", "text"), L.entries(results, "scrub"), "scrub", key="doc_id")


@query(
    "p14_gate_by_text",
    """SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)
       AND (doc_id % 3 <> 0 OR coalesce(text, '') = coalesce(translate(text, 'abc', 'xyz'), ''))""",
)
def p14_by_text(t: Tables):
    """Every third document is offered raw under a key whose scrub has passed: it stays out."""
    key, clean = F.col("doc_id").cast("string").alias("doc_key"), F.translate("text", "abc", "xyz")
    status = F.when(F.col("toxic") == 0, "ok").otherwise("bad_json").alias("status")
    scrubbed = t.documents.join(t.labels.select("doc_id", "toxic"), "doc_id").select(key, clean.alias("markdown"), status)
    ledger = L.entries(L.with_hash(scrubbed, "markdown"), "scrubbed")
    offered = t.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(clean).alias("markdown"))
    return L.gate(L.with_hash(offered, "markdown"), ledger, "scrubbed", key="doc_id").select("doc_id")


def echo_client():
    """A stand-in for a model: upper-cases ASCII letters of the document and answers in JSON."""
    import json

    def answer(messages, model, temperature, json_mode):
        text = messages[1]["content"].split(">\n", 1)[1].rsplit("\n</document>", 1)[0]
        table = {i: i - 32 for i in range(97, 123)}
        return json.dumps({"markdown": text.translate(table)}, ensure_ascii=False)

    return answer


@query(
    "x1_call_model",
    """SELECT doc_id, 'ok' AS status, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS markdown, 1 AS attempts FROM documents""",
)
def x1(t: Tables):
    docs = t.documents.select("doc_id", F.expr(_KEY).alias("doc_key"), F.col("text").alias("markdown"))
    asked = R.scrub_request(docs, "Remove personal data.")
    answered = M.call_model(
        asked, echo_client, model="upper", json_mode=True, concurrency=None, threads=4, tier="raw", public_endpoint=False,
        answers_path=work_dir(t.spark, "x1"),
    )
    answered = answered.withColumnRenamed("status", "call_status").drop("markdown")
    return A.scrubbed_text(answered).select("doc_id", "status", "markdown", "attempts")


def first_half_client():
    """Answers short texts; the connection is lost at the others, and with it the run."""

    def answer(messages, **_):
        if len(messages[1]["content"]) % 2:
            raise ConnectionError("lost")
        return "first run"

    return answer


def second_run_client():
    return lambda messages, **_: "second run"


@query(
    "x1_resumed_answers",
    "SELECT doc_id, 'ok' AS status, CASE WHEN length(text) % 2 = 1 THEN 'second run' ELSE 'first run' END AS response FROM documents",
)
def x1_resumed(t: Tables):
    """Two runs over one answer log: the second calls what the first has no answer for."""
    asked = t.documents.select("doc_id", R.messages("", F.col("text")).alias("messages"))
    log = work_dir(t.spark, "answers")
    M.call_model(asked, first_half_client, model="m", log=log)
    return M.call_model(asked, second_run_client, model="m", log=log).select("doc_id", "status", "response")


def flaky_client():
    """Fails on the first two tries of each request of three, for good on every fourth length."""
    from collections import Counter

    tries: Counter = Counter()

    def answer(messages, model, temperature, json_mode):
        text = messages[1]["content"]
        tries[text] += 1
        if len(text) % 4 == 0:
            raise ValueError("refused")
        if len(text) % 4 == 1 and tries[text] < 3:
            raise ConnectionError("lost")
        if len(text) % 4 == 2:
            raise ConnectionError("lost")
        return text

    return answer


@query(
    "x2_retries",
    """SELECT doc_id, CASE length(text) % 4 WHEN 0 THEN 'error' WHEN 2 THEN 'error' ELSE 'ok' END AS status,
              CASE length(text) % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 3 ELSE 1 END AS attempts,
              CASE length(text) % 4 WHEN 0 THEN 'ValueError: refused' WHEN 2 THEN 'ConnectionError: lost' ELSE NULL END AS error FROM documents""",
)
def x2(t: Tables):
    asked = t.documents.select("doc_id", R.messages("", F.col("text")).alias("messages"))
    answered = M.call_model(asked, flaky_client, model="m", policy=M.distil_policy(), dedupe=True)  # the client fails by text, so copies must be one call
    return answered.select("doc_id", "status", "attempts", "error")


@query(
    "x5_distinct_calls",
    "SELECT doc_id, concat(lang, ' ', source) AS response FROM documents",
)
def x5(t: Tables):
    asked = t.documents.select("doc_id", R.messages("", F.concat_ws(" ", "lang", "source")).alias("messages"))
    return M.call_model(asked, last_message_client, model="m", concurrency=4, dedupe=True).select("doc_id", "response")


def last_message_client():
    return lambda messages, **_: messages[-1]["content"]


def logging_client():
    """Answers with the microseconds at which the call began and ended."""
    import time

    def answer(messages, **_):
        begun = time.time_ns() // 1000
        time.sleep(0.001)
        return f"{begun} {time.time_ns() // 1000}"

    return answer


@query("x3_bounded_calls", "SELECT doc_id, 'ok' AS status, TRUE AS within_bound FROM documents")
def x3(t: Tables):
    """Six calls at once over all tasks.  The sweep goes through slots of 50 ms, each with the calls
    that reach into it, and looks at how many are under way when one begins."""
    slot = 50_000
    asked = t.spread("documents", "doc_id", "text").select("doc_id", R.messages("", F.col("text")).alias("messages"))
    calls = M.call_model(asked, logging_client, model="m", threads=2, in_flight=6)
    times = F.split("response", " ").cast("array<bigint>")
    calls = calls.select("doc_id", "status", times[0].alias("begun"), times[1].alias("ended"))
    at = calls.withColumn("slot", F.explode(F.expr(f"sequence(begun div {slot}, ended div {slot})")))
    began = F.struct(F.greatest("begun", F.col("slot") * slot).alias("time"), F.lit(1).alias("step"))
    over = F.struct(F.col("ended").alias("time"), F.lit(-1).alias("step"))
    events = at.select("*", F.inline(F.array(began, over)))
    swept = W.partitionBy("slot").orderBy("time", "step").rowsBetween(W.unboundedPreceding, W.currentRow)
    events = events.withColumn("running", F.sum("step").over(swept))
    events = events.where(f"step = 1 AND slot = begun div {slot}")
    return events.select("doc_id", "status", F.col("running").between(1, 6).alias("within_bound"))


def slow_client():
    """Hangs on every text of a certain length."""
    import time

    def answer(messages, **_):
        time.sleep(60 if len(messages[1]["content"]) % 500 == 7 else 0)
        return "done"

    return answer


@query(
    "x4_time_limit",
    """SELECT doc_id, CASE WHEN length(text) % 500 = 7 THEN 'timeout' ELSE 'ok' END AS status, CASE WHEN length(text) % 500 <> 7 THEN 'done' END AS response FROM documents""",
)
def x4(t: Tables):
    asked = t.documents.select("doc_id", R.messages("", F.col("text")).alias("messages"))
    answered = M.call_model(asked, slow_client, model="m", policy=M.CallPolicy(timeout=4.0), threads=8)
    return answered.select("doc_id", "status", "response")
