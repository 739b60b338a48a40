"""Header projection, header block and the Markdown document of a mail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.functions import dates
from mailspark.functions.html import html_to_markdown as html_expression
from mailspark.functions.text import clean_text, postprocess, strip

HEADERS = ("subject", "from_addr", "to_addr", "cc_addr", "date_raw")


def project_headers(df: DataFrame) -> DataFrame:
    """Trim the five header columns, missing becomes empty, and read the date."""
    df = df.withColumns({c: strip(F.coalesce(F.col(c), F.lit(""))) for c in HEADERS})
    return df.withColumns(
        {
            "date_iso": dates.rfc2822_to_iso(F.col("date_raw")),
            "sent_at": dates.sent_at(F.col("date_raw")),
            "tz_offset_min": dates.tz_offset_minutes(F.col("date_raw")),
        }
    )


def header_block() -> Column:
    """Title, list of the headers that are present, rule.  Lines that do not apply are
    null, which ``concat_ws`` skips."""

    def item(label: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(f"- {label}: "), value))

    has_subject = F.col("subject") != ""
    date = F.coalesce(F.col("date_iso"), F.col("date_raw"))
    items = [
        item("From", F.col("from_addr")),
        item("To", F.col("to_addr")),
        item("Cc", F.col("cc_addr")),
        item("Date", date),
    ]
    has_items = F.coalesce(*items).isNotNull()
    return F.concat_ws(
        "\n",
        F.when(has_subject, F.concat(F.lit("# "), F.col("subject"))),
        F.when(has_subject, ""),
        *items,
        *[F.when(has_items, line) for line in ("", "---", "")],
    )


def render_header(df: DataFrame) -> DataFrame:
    return df.withColumn("header", header_block())


def to_markdown(
    df: DataFrame, headers: bool = True, keep_quoted: bool = False, keep_signature: bool = False
) -> DataFrame:
    """Add ``markdown``: header block, blank line, body; cleaned and cut; one final line feed.

    Needs the projected headers and ``body_kind`` / ``body``.
    """
    body = F.col("body")
    body = F.when(F.col("body_kind") == "html", html_expression(body)).otherwise(clean_text(body))
    document = F.concat(header_block(), F.lit("\n"), body) if headers else body
    document = postprocess(document, quoted=not keep_quoted, signature=not keep_signature)
    return df.withColumn("markdown", F.concat(document, F.lit("\n")))


def html_to_markdown(df: DataFrame, col: str, out: str = "markdown") -> DataFrame:
    """HTML column to Markdown column (see ``functions.html`` for the subset)."""
    return df.withColumn(out, html_expression(F.col(col)))
