"""Line cuts and trims against a plain line-by-line reading in Python."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from mailspark.functions import text as X

PIECES = [
    "hello", "From: a", "from:\tb", "From:", " To: x", "> On x wrote:", "On Monday, X wrote:", "On Monday, X wrote: y", "", " ", "\t",
    "　", "\x85", "-- ", "--", "--x", "  Best Regards, ", "best regards", "谢谢！", "此致，　敬礼", "发件人：x", "主题:", "在昨天写道：",
    "---------- Forwarded message ----------", "-----转发的邮件信息---", "OFFICE: +1", "Regards", "regards\x85", "Email: support_x", "日期：",
    "😀 smile", "Subject:　wide", "a b", "x\r", "\x1c", "tail  ",
]


def _random_texts(n: int = 1500) -> list[str]:
    rng = random.Random(7)
    return ["\n".join(rng.choice(PIECES) for _ in range(rng.randint(0, 7))) for _ in range(n)]


def _evaluate(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, md string")
    return [r["out"] for r in df.select("i", expression(F.col("md")).alias("out")).orderBy("i").collect()]


def _cut_by_lines(text, markers, flags, trim):
    pattern = re.compile("|".join(f"(?:{m})" for m in markers), flags)
    lines = text.split("\n")
    seen = False
    for i, line in enumerate(lines):
        if seen and pattern.search(line.strip() if trim else line):
            return "\n".join(lines[:i]).rstrip()
        seen = seen or bool(line.strip())
    return text.rstrip()


def _forward_by_lines(text):
    forward = re.compile("|".join(X.FORWARD_MARKERS))
    contact = re.compile("|".join(X.CONTACT_MARKERS), re.IGNORECASE)
    lines = text.split("\n")
    hits = [i for i, line in enumerate(lines) if forward.search(line) or contact.search(line)]
    if not hits:
        return text
    kept = lines[: hits[0]]
    while kept and not kept[-1].strip():
        kept.pop()
    return "\n".join(kept) + "\n"


def test_white_space_set_is_pythons():
    assert X.WS_CHARS == "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    assert len(X.WS_CHARS) == 29


def test_strip_quoted(spark):
    texts = _random_texts()
    expected = [_cut_by_lines(t, X.QUOTE_MARKERS, re.IGNORECASE, False) for t in texts]
    assert _evaluate(spark, texts, X.strip_quoted) == expected


def test_strip_signature(spark):
    texts = _random_texts()
    expected = [_cut_by_lines(t, X.SIGNATURE_MARKERS, 0, True) for t in texts]
    assert _evaluate(spark, texts, X.strip_signature) == expected


def test_cut_forwarded(spark):
    texts = _random_texts()
    assert _evaluate(spark, texts, X.cut_forwarded) == [_forward_by_lines(t) for t in texts]


@pytest.mark.parametrize("quoted", [True, False])
@pytest.mark.parametrize("signature", [True, False])
def test_postprocess(spark, quoted, signature):
    def expected(text):
        out = re.sub(r"[ \t]+\n", "\n", text.replace("\r\n", "\n").replace("\r", "\n").replace("\0", ""))
        if quoted:
            out = _cut_by_lines(out, X.QUOTE_MARKERS, re.IGNORECASE, False)
        if signature:
            out = _cut_by_lines(out, X.SIGNATURE_MARKERS, 0, True)
        return out.rstrip()

    texts = [t.replace("hello", "a\0 \r\nb \t\rc") for t in _random_texts(600)]
    got = _evaluate(spark, texts, lambda c: X.postprocess(c, quoted=quoted, signature=signature))
    assert got == [expected(t) for t in texts]


def test_oneline(spark):
    texts = [t + end for t in _random_texts(300) for end in ("", "\n", "\r\n", "\n\n", "\x0b", "\x1e")]
    assert _evaluate(spark, texts + [None], X.oneline) == [" ".join(t.splitlines()) for t in texts] + [""]


def test_cuts_are_idempotent_and_prefixes(spark):
    texts = _random_texts(400)
    once = _evaluate(spark, texts, X.strip_quoted)
    assert all(t.startswith(o) for t, o in zip(texts, once))
    cleaned = _evaluate(spark, texts, X.clean_text)
    assert _evaluate(spark, cleaned, X.clean_text) == cleaned


def test_divider_of_a_thread_survives(spark):
    text = "question?\n\n---\n\nReply:\nanswer"
    assert _evaluate(spark, [text], X.postprocess) == [text]


def test_long_documents_are_linear(spark):
    long_blank = "a" + " " * 300_000 + "b\nRegards"
    long_line = "x" * 300_000 + "\n" + "On " + "y " * 100_000 + "\nSubject: z"
    many_lines = "\n".join(["", "word"] * 100_000) + "\n-- \nme"
    got = _evaluate(spark, [long_blank, long_line, many_lines], X.postprocess)
    assert got[0].endswith("b") and got[1].endswith("y") and got[2].endswith("word")


def test_caller_markers(spark):
    got = _evaluate(spark, ["text\nACME Robotics | Support\nx"], lambda c: X.cut_forwarded(c, contact=[r"^Acme Robotics \|"]))
    assert got == ["text\n"]
