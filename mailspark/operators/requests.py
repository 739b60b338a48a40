"""Requests for the three model stages: ``messages ARRAY<STRUCT<role, content>>``.

The system prompt is the caller's text.  The user message wraps the document in a tag that
names it and states the shape of the answer; ``template`` replaces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCRUB_TEMPLATE = '<document name="{name}">\n{text}\n</document>\nReturn it without personal data, as JSON: {{"markdown": "..."}}'
DISTIL_TEMPLATE = (
    '<thread name="{name}">\n{text}\n</thread>\n'
    'Return JSON only: {{"items": [...]}}, each item with category, model, issue, resolution and code_snippet.'
)
REWRITE_TEMPLATE = "<record>\n{text}\n</record>\nReturn this record as JSON, with the same keys and better wording."


def fill(template: str, **values: Column) -> Column:
    """``str.format`` with columns: the literal pieces and the values, concatenated."""
    from string import Formatter

    pieces = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is not None:
            pieces.append(values[field])
    return F.concat(*pieces)


def messages(system: str, user: Column) -> Column:
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(system)), message("user", user))


def _text_request(df, system, template, key, text) -> DataFrame:
    user = fill(template, name=F.col(key), text=F.col(text))
    return df.withColumn("messages", messages(system, user))


def scrub_request(df: DataFrame, system: str, template: str = SCRUB_TEMPLATE, key="doc_key", text="markdown") -> DataFrame:
    return _text_request(df, system, template, key, text)


def distil_request(df: DataFrame, system: str, template: str = DISTIL_TEMPLATE, key="doc_key", text="markdown") -> DataFrame:
    return _text_request(df, system, template, key, text)


def minimal_record() -> Column:
    """The six keys a rewrite sees, as JSON: texts never null, category and model as they are."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    record = F.struct(
        text("file"), F.col("category"), F.col("model"), text("issue"), text("resolution"), text("code_snippet")
    )
    return F.to_json(record, {"ignoreNullFields": "false"})


def rewrite_request(df: DataFrame, system: str, template: str = REWRITE_TEMPLATE) -> DataFrame:
    return df.withColumn("messages", messages(system, fill(template, text=minimal_record())))
