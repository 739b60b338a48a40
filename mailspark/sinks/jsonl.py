"""QA records as JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

QA_FIELDS = ("file", "category", "model", "issue", "resolution", "code_snippet")


def write_jsonl(df: DataFrame, path: str, append: bool = True) -> None:
    """One JSON object per row; null fields are kept as ``null`` and text is not escaped."""
    mode = "append" if append else "overwrite"
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_qa(df: DataFrame, path: str, append: bool = True) -> None:
    write_jsonl(df.select(*QA_FIELDS), path, append)


def write_rewritten(df: DataFrame, path: str, resumed: bool) -> None:
    """Rewrite output: added to what is there when resuming, else started afresh."""
    write_jsonl(df, path, append=resumed)
