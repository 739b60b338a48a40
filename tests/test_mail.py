"""Mail parsing, body choice, headers and dates."""

from __future__ import annotations

from email.message import EmailMessage
from email.utils import parsedate_to_datetime

from pyspark.sql import functions as F

from mailspark.functions import dates
from mailspark.functions.html import html_to_markdown
from mailspark.operators import markdown as D
from mailspark.operators import mime
from mailspark.plans.stages import mail_to_markdown


def _mail(body="hello\n", subtype="plain", **headers) -> EmailMessage:
    message = EmailMessage()
    for name, value in headers.items():
        message[name] = value
    message.set_content(body, subtype=subtype)
    return message


def _frame(spark, *raw):
    rows = [(f"m{i}", bytearray(r if isinstance(r, bytes) else bytes(r))) for i, r in enumerate(raw)]
    return spark.createDataFrame(rows, "doc_key string, content binary")


def _markdown(spark, *raw, **flags):
    return [r["markdown"] for r in mail_to_markdown(_frame(spark, *raw), **flags).orderBy("doc_key").collect()]


def _bodies(spark, *raw):
    rows = mime.best_body(mime.parse_mail(_frame(spark, *raw))).orderBy("doc_key").collect()
    return [(r["body_kind"], r["body"]) for r in rows]


def test_plain_mail(spark):
    mail = _mail(
        "Robot tilts.\n\n---\n\nReply:\nPlease recalibrate.\n\nBest Regards,\nDesk\n",
        Subject=" Tilt ", From='"Li Ming" <li@example.org>', To='"Dr. Aris" <a@example.com>', Date="Mon, 03 Mar 2025 09:15:22 +0800",
    )
    assert _markdown(spark, mail) == [
        '# Tilt\n\n- From: Li Ming <li@example.org>\n- To: "Dr. Aris" <a@example.com>\n'
        "- Date: 2025-03-03T09:15:22+08:00\n\n---\n\nRobot tilts.\n\n---\n\nReply:\nPlease recalibrate.\n"
    ]


def test_flags(spark):
    mail = _mail("text\n-- \nme\nFrom: old\nx", Subject="S")
    assert _markdown(spark, mail, headers=False) == ["text\n"]
    assert _markdown(spark, mail, headers=False, keep_signature=True) == ["text\n--\nme\n"]
    assert _markdown(spark, mail, headers=False, keep_signature=True, keep_quoted=True) == ["text\n--\nme\nFrom: old\nx\n"]


def test_subject_counts_as_content_above(spark):
    mail = _mail("From: someone\nold\nTo: other\n", Subject="S")
    assert _markdown(spark, mail) == ["# S\n"]
    assert _markdown(spark, mail, headers=False) == ["From: someone\nold\n"]


def test_no_headers_at_all(spark):
    assert _markdown(spark, b"\r\njust text\r\n") == ["\njust text\n"]
    assert _markdown(spark, b"Date: soon\r\n\r\nx") == ["- Date: soon\n\n---\n\nx\n"]


def test_best_body(spark):
    both = _mail("plain text\n")
    both.add_alternative("<p>html</p>", subtype="html")
    blank = _mail(" \n")
    blank.add_alternative("<p>html</p>", subtype="html")
    attached = EmailMessage()
    attached.make_mixed()
    attached.add_attachment("secret", subtype="plain", filename="n.txt")
    attached.add_attachment(b"\x00\x01", maintype="application", subtype="octet-stream")
    inner = _mail("inner body\n", Subject="inner")
    forwarded = EmailMessage()
    forwarded.make_mixed()
    forwarded.attach(inner)
    got = _bodies(spark, both, blank, attached, forwarded, _mail("<b>x</b>", subtype="html"))
    assert [(k, b.strip()) for k, b in got] == [
        ("plain", "plain text"), ("html", "<p>html</p>"), ("plain", ""), ("plain", "inner body"), ("html", "<b>x</b>"),
    ]


def test_attached_message_is_walked_into(spark):
    outer = EmailMessage()
    outer.set_content("   \n")
    outer.add_attachment(_mail("<i>deep</i>", subtype="html"))
    # The attached message itself is skipped as an attachment, its parts are not.
    assert _bodies(spark, outer)[0] == ("html", "<i>deep</i>\n")


def test_odd_bytes(spark):
    latin = b"Content-Type: text/plain; charset=latin-1\r\n\r\nM\xfcller"
    unknown = "Content-Type: text/plain; charset=x-none\r\n\r\nMüller".encode()
    broken = b"Content-Type: text/plain; charset=utf-8\r\n\r\nM\xffller"
    image = b"Content-Type: image/png\r\nContent-Transfer-Encoding: base64\r\n\r\nTcO8bGxlcg=="
    got = _bodies(spark, latin, unknown, broken, image)
    assert [b for _, b in got] == ["Müller", "Müller", "M�ller", "Müller"]


def test_bad_mail_stays_in_its_row(spark, monkeypatch):
    rows = _frame(spark, _mail("ok"), b"x").withColumn("content", F.when(F.col("doc_key") == "m1", None).otherwise(F.col("content")))
    got = mail_to_markdown(rows).orderBy("doc_key").collect()
    assert [r["status"] for r in got] == ["ok", "error"]
    assert got[1]["markdown"] is None and "TypeError" in got[1]["error"]


def test_encoded_words_and_folding(spark):
    raw = (
        b"Subject: =?utf-8?B?5L2g5aW9?= =?utf-8?q?_Welt?=\r\nFrom: =?utf-8?q?M=C3=BCller=2C_J=2E?= <m@example.org>\r\n"
        b"To: a@example.org,\r\n b@example.org\r\nsubject: second\r\n\r\nx"
    )
    row = mime.parse_mail(_frame(spark, raw)).first()
    assert row["subject"] == "你好 Welt"
    assert row["from_addr"] == '"Müller, J." <m@example.org>'
    assert row["to_addr"] == "a@example.org, b@example.org"
    assert row["cc_addr"] == "" and row["date_raw"] == ""


def test_headers_equal_the_modern_policy(spark):
    from email import message_from_bytes, policy

    samples = [
        b"From: \"A & B\" <x@example.org>, C <y@example.org>\r\nTo: undisclosed-recipients:;\r\nDate: Thu, 6 Mar 25 1:02 GMT\r\n\r\n",
        b"Subject:\r\n folded start\r\nCc: (comment) z@example.org\r\nDate: nonsense\r\n\r\n",
        "Subject: rohe Umläute\r\nFrom: Jürgen <j@example.org>\r\nDate: Mon, 3 Mar 2025 10:00:00 -0000\r\n\r\n".encode(),
        b"Content-Type: text/html; charset=\"utf-8\"; x\r\nContent-Disposition: inline\r\n\r\n<p>",
    ]
    rows = mime.parse_mail(_frame(spark, *samples)).orderBy("doc_key").collect()
    for row, raw in zip(rows, samples):
        message = message_from_bytes(raw, policy=policy.default)
        for column, name in [("subject", "Subject"), ("from_addr", "From"), ("to_addr", "To"), ("cc_addr", "Cc"), ("date_raw", "Date")]:
            want = str(message.get(name) or "").strip().encode("utf-8", "replace").decode()
            assert row[column] == want
        assert row["parts"][0]["content_type"] == message.get_content_type()


def test_dates(spark):
    texts = [
        "Mon, 03 Mar 2025 09:15:22 +0000", "3 Mar 2025 09:15 -0330", "Tue, 04 Mar 2025 00:00:00 -0000", "04 mar 2025 1:02:03 EST",
        "Tue, 04 Mar 2025 10:00:00 +1100 (AEDT)", "Wed, 05 Mar 2025 10:00:00 GMT",
    ]
    bad = ["", "soon", "Mon, 31 Feb 2025 10:00:00 +0000", "Mon, 03 Mar 2025 25:00:00 +0000", None]
    df = spark.createDataFrame(list(enumerate(texts + bad)), "i int, d string")
    got = df.select("i", dates.rfc2822_to_iso(F.col("d")).alias("iso"), dates.sent_at(F.col("d")).alias("at")).orderBy("i").collect()
    assert [r["iso"] for r in got] == [parsedate_to_datetime(t).isoformat() for t in texts] + [None] * 5
    assert str(got[1]["at"]) == "2025-03-03 12:45:00"
    assert all(r["at"] is None for r in got[-5:])


def test_header_block_variants(spark):
    rows = [("", "", "", "", ""), ("S", "", "", "", ""), ("", "f", "", "", ""), ("S", "f", "t", "c", "soon")]
    df = spark.createDataFrame(rows, "subject string, from_addr string, to_addr string, cc_addr string, date_raw string")
    got = [r["header"] for r in D.render_header(D.project_headers(df)).collect()]
    assert got == ["", "# S\n", "- From: f\n\n---\n", "# S\n\n- From: f\n- To: t\n- Cc: c\n- Date: soon\n\n---\n"]


def test_html(spark):
    pages = {
        "<h1>A</h1><p>b <b>c</b> <i>d</i><br>e</p>": "# A\n\nb **c** *d*\ne\n",
        "<ul><li>one</li><li>two <a href='x'>l</a> <a href=\"/y\">m</a></li></ul>": "- one\n- two [l](x) [m](/y)\n",
        "<p>&lt;tag&gt; &amp;amp; &#65;&#x4F60; &#0; &nbsp;x</p>": "<tag> &amp; A你 �  x\n",
        "a<!-- b --><script>c</script>d<style>e": "ad\n",
        "<img src=\"i.png\"><hr>x<header>y</header>": "![](i.png)\n\n---\n\nx\n\ny\n",
    }
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = [r["m"] for r in df.select("i", html_to_markdown(F.col("h")).alias("m")).orderBy("i").collect()]
    assert got == list(pages.values())


def test_html_is_linear(spark):
    hostile = ["<a href=\"x\">" * 20_000, "<!--" * 50_000, "<script>" * 50_000, "<" * 200_000, " " * 300_000 + "x"]
    df = spark.createDataFrame(list(enumerate(hostile)), "i int, h string")
    assert df.select(html_to_markdown(F.col("h")).alias("m")).count() == 5
    assert df.select(F.length(html_to_markdown(F.col("h"))).alias("m")).agg(F.sum("m")).first()[0] > 0
