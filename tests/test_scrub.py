"""Rules on single lines, what they must leave alone, dictionaries and the audit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mailspark.functions import pii
from mailspark.operators import scrub as P

CASES = {
    "mail a.b+c@sub.example.co.uk, müller@firma.de!": "mail <EMAIL>, <EMAIL>!",
    "call +49 30 1234 567 or 电话13812345678。": "call <PHONE> or 电话<PHONE>。",
    "Tel: 030 123456; fax.(030) 555 12": "Tel: 030 123456; fax.(030) 555 12".replace("030 123456", "<PHONE>"),
    "WeChat: wx_1234 QQ号：123456 telegram id:@robot_bot": "WeChat: <ACCOUNT> QQ号：<ACCOUNT> telegram id:<ACCOUNT>",
    "Order No. AB-20240, invoice #7001, 合同编号：HT99001": "Order No. <ORDER_ID>, invoice #<ORDER_ID>, 合同编号：<ORDER_ID>",
    "SN-HR-2024-001 and serial number: X1000Z": "<SERIAL> and serial number: <SERIAL>",
    "ping 192.168.1.10, 8.8.8.8:53 nas1.corp": "ping <IP>, <IP>:53 <HOST>",
    "id 11010519900307123X": "id <ID_NUMBER>",
    "请将日志发送到support@firma.de谢谢": "请将日志发送到<EMAIL>谢谢",
    "serial: " + "A1" * 30 + "; fax " + "7" * 60: "serial: <SERIAL>; fax <PHONE>",
    "微信 wx_abc123, WeChat ID is wx_12345, telegram: " + "ab1_" * 15: "微信 <ACCOUNT>, WeChat ID is <ACCOUNT>, telegram: <ACCOUNT>",
    "Order No. ABCDE-20240 发票号码：12345678 订单号是：A-123456 order no. " + "1" * 50: "Order No. <ORDER_ID> 发票号码：<ORDER_ID> 订单号是：<ORDER_ID> order no. <ORDER_ID>",
    "vpn.firma.com and " + "a" * 300 + ".corp": "<HOST> and <HOST>",
    "card 4111 1111 1111 1111 and 4111111111111112": "card <CARD> and 4111111111111112",
    "https://docs.example.org/a?token=s&x=1 https://example.org/b": "https://docs.example.org/a https://example.org/b",
    "phone: (555) 123 4567, Tel. 030/1234567, Phone: 555.123.4567, +49/30/1234567.": "phone: <PHONE>, Tel. <PHONE>, Phone: <PHONE>, <PHONE>.",
    "info@müller.de; o'brien@x.de a=b@x.de 'quoted@x.de'": "<EMAIL>; <EMAIL> <EMAIL> '<EMAIL>'",
    "order no. AB12345/0815, Order ID ORD_2024_77, contract C_77123, invoice: INV.2024.55.": "order no. <ORDER_ID>, Order ID <ORDER_ID>, contract <ORDER_ID>, invoice: <ORDER_ID>.",
    "S/N A1B2C3D4, SN: ABC12345, serial number ABC12345": "S/N <SERIAL>, SN: <SERIAL>, serial number <SERIAL>",
    "QQ 123456789, Telegram @somebody": "QQ <ACCOUNT>, Telegram <ACCOUNT>",
    "2001:db8::1, nas.corp.example.com, fe80::1ff:fe23:4567:890a 2001:0db8:85a3:0000:0000:8a2e:0370:7334": "<IP>, <HOST>, <IP> <IP>",
    "see https://firma.sharepoint.com/p/tok123/x": "see <LINK>",
    "plain line\nOrder no.\n12345\nplain line\nTel.\n030 123456\nx\nWeChat\nid\n:\nabcdef\ny": "plain line\nOrder no.\n<ORDER_ID>\nplain line\nTel.\n<PHONE>\nx\nWeChat\nid\n:\n<ACCOUNT>\ny",
    "\0\nmail a@b.de\n\0": "\0\nmail <EMAIL>\n\0",
}

KEPT = [
    "version 1.2.3 torque 12.5 Nm at 24 V, order 5 units",
    "error 0x80070005 at line 1234567890",
    "2025-03-03T09:15:22 port 8080 baud 115200",
    "```\nsudo apt install ros-humble-desktop=0.10.0-1\n```",
    "https://github.com/example/repo/issues/12",
    "max 256.300.1.1 is no address, 1.2.3 neither",
    "serial port /dev/ttyUSB0",
    "Intel 13900 24 cores, the recorder 12345, in order 2024-01-01, invoice 2024Q3",
    "firmware 1.0.21.3, version: 2.4.6.8, WeChat works, telegram 2024",
    "QQ group, 12:34:56, a::b, std::add, 00:1A:2B:3C:4D:5E, serial RS232 cable, order RTX-4090",
]


def _scrub(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, md string")
    return [r["md"] for r in P.scrub(df, "md").orderBy("i").collect()]


def test_rules(spark):
    assert _scrub(spark, list(CASES)) == list(CASES.values())


def test_technical_text_survives(spark):
    assert _scrub(spark, KEPT) == KEPT


def test_blanked_lines_change_nothing(spark):
    """Reading only the lines that matter gives what the rules give on the whole text."""
    texts = ["\n".join(x) for x in zip([*CASES, *KEPT], [*KEPT, *CASES] * 2, ["plain words.", ""] * 40)] + ["", "\n", "a\n\nb"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, md string")
    whole = [r["md"] for r in df.select("i", P.scrub_expression(F.col("md")).alias("md")).orderBy("i").collect()]
    assert _scrub(spark, texts) == whole


def test_idempotent(spark):
    once = _scrub(spark, list(CASES))
    assert _scrub(spark, once) == once


def test_long_runs_are_linear(spark):
    hostile = ["a" * 400_000, "1" * 400_000, "a." * 200_000, "https://" * 50_000, "+1 " * 100_000]
    assert len(_scrub(spark, hostile)) == 5


def test_keep_hosts(spark):
    df = spark.createDataFrame([("https://docs.example.org/a?v=2 https://x.example/b?t=1",)], "md string")
    got = df.select(pii.strip_link_queries(F.col("md"), keep_hosts=["docs.example.org"])).first()[0]
    assert got == "https://docs.example.org/a?v=2 https://x.example/b"


def test_ip_classes(spark):
    df = spark.createDataFrame([("10.0.0.1 172.16.0.1 172.32.0.1 192.168.0.9 8.8.8.8",)], "md string")
    row = P.classify_ips(df, "md").first()
    assert (row["n_private_ip"], row["n_public_ip"]) == (3, 2)


def test_header_names(spark):
    df = spark.createDataFrame(
        [("Hi Li Ming, Dr. Aris and J here", "Li Ming <a@x.org>", '"Dr. Aris" <b@x.org>, J <c@x.org>', "")],
        "md string, from_addr string, to_addr string, cc_addr string",
    )
    assert P.scrub_header_names(df, "md").first()["md"] == "Hi <NAME>, <NAME> and <NAME> here"
    df = spark.createDataFrame([("Li, Lidar, Li-ion, Limit, Li\u00a0Ming, O\\E (x)", "Li <a@x.org>", "O\\E (x) <b@x.org>", "")], "md string, from_addr string, to_addr string, cc_addr string")
    assert P.scrub_header_names(df, "md").first()["md"].startswith("<NAME>, Lidar, Li-ion, Limit, <NAME>")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_dictionary(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        texts = [(f"d{i}", t) for i, t in enumerate(["Ask Acme Robotics about it.", "ACME only", "Call Weber, (Weber) or Weberei", "Ann Lee Weber", ""])]
        docs = spark.createDataFrame(texts, "doc_key string, md string")
        names = spark.createDataFrame([("Acme Robotics",), ("Weber",), ("Ann Lee Weber",), (" ",), (None,)], "name string")
        got = [r["md"] for r in P.scrub_dictionary(docs, names, "md").orderBy("doc_key").collect()]
        assert got == ["Ask <NAME> about it.", "ACME only", "Call <NAME>, (<NAME>) or Weberei", "<NAME>", ""]
        assert P.scrub_dictionary(docs, names.filter("false"), "md").filter("md LIKE '%NAME%'").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dictionary_names_with_signs_and_mixed_scripts(spark):
    names = ["Acme Inc.", "J. R. Smith", "Smith Jr.", "Meyer, Schulz & Co", "A/S Jensen", "C+D GmbH", "ABC公司", "张伟Robotics", "李明", "Weber", "राम", "***", "Li"]
    texts = {
        "From Acme Inc., by J. R. Smith.": "From <NAME>, by <NAME>.",
        "Smith Jr. met Meyer, Schulz & Co": "<NAME> met <NAME>",
        "(A/S Jensen) and C+D GmbH.": "(<NAME>) and <NAME>.",
        "请联系ABC公司谢谢，张伟Robotics的李明，电话Weber先生": "请联系<NAME>谢谢，<NAME>的<NAME>，电话<NAME>先生",
        "Weber's, #Weber, Weber.Thanks and राम": "<NAME>'s, #<NAME>, <NAME>.Thanks and <NAME>",
        "Acme Incorporated, J R Smithson, XABC公司, 李，明, Li-ion, Weberei, *** A, S": "Acme Incorporated, J R Smithson, XABC公司, 李，明, Li-ion, Weberei, *** A, S",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_key int, md string")
    for carried in (P.CARRIED, 3):  # as a table of slots, and through the join
        got = P.scrub_dictionary(docs, spark.createDataFrame([(n,) for n in names], "name string"), "md", carried=carried).orderBy("doc_key")
        assert [r["md"] for r in got.collect()] == list(texts.values())


def test_dictionary_bit_table(spark):
    rows = spark.range(500).select(F.xxhash64("id").alias("hash"))
    df = spark.range(4000).withColumn("bits", P._bit_table(rows, 64).scalar())
    seen = {r["id"] for r in df.where(P._has_bit(F.col("bits"), F.xxhash64("id"), 64)).select("id").collect()}
    assert seen >= set(range(500)) and len(seen) < 1200


def test_audit(spark):
    df = spark.createDataFrame([("a@b.de a@b.de 8.8.8.8", "<EMAIL> a@b.de 8.8.8.8"), ("x", "x")], "before string, after string")
    rows = {r["rule"]: tuple(r)[1:] for r in P.leak_audit(df, "before", "after").collect()}
    assert rows["email"] == (2, 1, 1) and rows["ip"] == (1, 1, 1) and rows["order_id"] == (0, 0, 0)
    empty = {r["rule"]: tuple(r)[1:] for r in P.leak_audit(df.filter("false"), "before", "after").collect()}
    assert empty["email"] == (0, 0, 0)


def test_dictionary_tables_stay_out_of_the_rows(spark):
    """A bit table as a column of the texts is copied into every row, and a test for phrases ahead of them cuts each text anew."""
    docs = spark.createDataFrame([(1, "Ask Ann Lee Weber or Weber"), (2, "nobody"), (3, None)], "doc_key int, text string")
    docs = docs.select("doc_key", F.concat("text", F.lit(".")).alias("md"))
    names = spark.createDataFrame([("Weber",), ("Ann Lee Weber",)], "name string")
    for carried in (P.CARRIED, 1):
        got = P.scrub_dictionary(docs, names, "md", carried=carried)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert " AS _bits#" not in plan and " AS _table#" not in plan
        of_texts = [line for line in plan.splitlines() if "regexp_extract_all(" in line and "_marked#" in line]
        assert len(of_texts) == 1 and of_texts[0].count("regexp_extract_all(") == 1
        assert plan.count("regexp_extract_all(concat(text") + plan.count("regexp_extract_all(md") == 1
        assert [r["md"] for r in got.orderBy("doc_key").collect()] == ["Ask <NAME> or <NAME>.", "nobody.", None]
