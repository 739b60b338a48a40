"""Raw mail to columns, and the choice of the body.

Taking a MIME message apart needs the codec library, so that one step runs as
``mapInPandas`` over the binary column.  It only lists what the message holds; which
part becomes the body is decided by column expressions.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from email import message_from_bytes
from email.policy import default as default_policy
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailspark.functions.text import is_blank

PART = T.StructType(
    [
        T.StructField("part_no", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("disposition", T.StringType()),
        T.StructField("charset", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

MAIL_FIELDS = [
    T.StructField("subject", T.StringType()),
    T.StructField("from_addr", T.StringType()),
    T.StructField("to_addr", T.StringType()),
    T.StructField("cc_addr", T.StringType()),
    T.StructField("date_raw", T.StringType()),
    T.StructField("is_multipart", T.BooleanType()),
    T.StructField("parts", T.ArrayType(PART)),
    T.StructField("parse_error", T.StringType()),
]


@lru_cache(maxsize=512)
def _codec(charset: str | None) -> str:
    """The text codec of a charset label; UTF-8 for none, for an unknown one and for one that
    is no text codec."""
    try:
        found = codecs.lookup(charset or "utf-8")
    except LookupError:
        return "utf-8"
    return found.name if found._is_text_encoding else "utf-8"


def _text(raw: bytes | None, charset: str | None) -> str:
    """Decoded text; what cannot be decoded, or held by a UTF-8 column, becomes a mark."""
    decoded = codecs.decode(raw or b"", _codec(charset), "replace")
    return decoded.encode("utf-8", "replace").decode("utf-8")


@lru_cache(maxsize=20_000)
def _header_text(name: str, raw: str) -> str:
    """A header as the standard library's modern policy renders it: encoded words decoded,
    addresses and dates normalised.  Senders and desks repeat, hence the cache."""
    value = str(default_policy.header_fetch_parse(name, raw)).strip()
    return value.encode("utf-8", "replace").decode("utf-8")


def _disposition(part) -> str:
    raw = str(part.get("Content-Disposition") or "")
    return (_header_text("Content-Disposition", raw) if "=?" in raw else raw).lower()


_HEADERS = {"subject": "subject", "from": "from_addr", "to": "to_addr", "cc": "cc_addr", "date": "date_raw"}


def _mail_row(raw: bytes) -> dict:
    """Headers and the flat list of parts of one message; an error stays in its row.

    The structure is read with the plain policy, which costs a fifth of the modern one;
    only the five headers that are wanted go through the modern one.
    """
    row = dict.fromkeys(f.name for f in MAIL_FIELDS)
    try:
        message = message_from_bytes(bytes(raw))
        for name, value in message.raw_items():
            column = _HEADERS.get(name.lower())
            if column is not None and row[column] is None:
                row[column] = _header_text(name.lower(), value)
        row["is_multipart"] = message.is_multipart()
        parts = []
        for number, part in enumerate(message.walk()):
            content_type = part.get_content_type().lower()
            disposition = _disposition(part)
            # A lone body is decoded whatever its type; of a multipart only texts can be chosen.
            wanted = not row["is_multipart"] or (
                content_type in ("text/plain", "text/html") and "attachment" not in disposition
            )
            parts.append(
                {
                    "part_no": number,
                    "content_type": content_type,
                    "disposition": disposition,
                    "charset": part.get_content_charset(),
                    "text": _text(part.get_payload(decode=True), part.get_content_charset()) if wanted else None,
                }
            )
        row["parts"] = parts
        for column in _HEADERS.values():
            row[column] = row[column] or ""
    except Exception as error:
        row = dict.fromkeys(row)
        row["parse_error"] = f"{type(error).__name__}: {error}"
    return row


def parse_mail(df: DataFrame, raw_col: str = "content") -> DataFrame:
    """Replace the raw column by header columns, ``is_multipart``, ``parts`` and
    ``parse_error``.  One bad message gives one row with an error, never a failed job."""
    keep = [c for c in df.columns if c != raw_col]
    schema = T.StructType([df.schema[c] for c in keep] + MAIL_FIELDS)
    names = schema.fieldNames()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([_mail_row(raw) for raw in batch[raw_col]], columns=[f.name for f in MAIL_FIELDS])
            yield pd.concat([batch[keep].reset_index(drop=True), rows], axis=1)[names]

    return df.select(*keep, raw_col).mapInPandas(parse, schema)


def content_parts(parts: Column) -> Column:
    """Parts in depth-first order without containers and without attachments."""
    return F.filter(
        parts,
        lambda p: ~p["content_type"].startswith("multipart/")
        & ~F.contains(F.lower(F.coalesce(p["disposition"], F.lit(""))), F.lit("attachment")),
    )


def explode_parts(df: DataFrame) -> DataFrame:
    """One row per content part."""
    keep = [c for c in df.columns if c != "parts"]
    return df.select(*keep, F.explode(content_parts(F.col("parts"))).alias("part")).select(*keep, "part.*")


def _first_text(content_type: str) -> Column:
    parts = F.filter(content_parts(F.col("parts")), lambda p: p["content_type"] == content_type)
    return F.try_element_at(parts, F.lit(1))["text"]


def best_body(df: DataFrame) -> DataFrame:
    """Add ``body_kind`` and ``body``.

    Multipart: the first plain part unless blank, else the first html part unless blank,
    else nothing.  A blank first plain part is not replaced by a later plain part.
    Single part: its text, html only if it says so.
    """
    plain, html = _first_text("text/plain"), _first_text("text/html")
    single = F.try_element_at(F.col("parts"), F.lit(1))
    lone_kind = F.when(single["content_type"] == "text/html", "html").otherwise("plain")
    kind = (
        F.when(~F.col("is_multipart"), lone_kind)
        .when(~is_blank(plain), "plain")
        .when(~is_blank(html), "html")
        .otherwise("plain")
    )
    body = (
        F.when(~F.col("is_multipart"), F.coalesce(single["text"], F.lit("")))
        .when(~is_blank(plain), plain)
        .when(~is_blank(html), html)
        .otherwise("")
    )
    failed = F.col("parse_error").isNotNull()
    return df.withColumns({"body_kind": F.when(~failed, kind), "body": F.when(~failed, body)}).drop("parts")
