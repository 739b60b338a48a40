"""Conversation turns seen as mail, and the way from there to the QA mix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailspark.functions.text import postprocess
from mailspark.operators.markdown import header_block
from mailspark.operators.reports import qa_mix
from mailspark.operators.scrub import scrub
from mailspark.operators.turns import pair_turns
from mailspark.operators.vocabulary import category_rules, normalise_model


def clean_turns(turns: DataFrame) -> DataFrame:
    """Each turn as the Markdown of one mail, cut and scrubbed.  Row by row, no shuffle."""
    headed = turns.withColumns(
        {
            "subject": F.concat(F.lit("Thread "), F.col("conv_id").cast("string")),
            "from_addr": F.concat(F.col("role"), F.lit("@example.org")),
            "to_addr": F.lit(""),
            "cc_addr": F.lit(""),
            "date_iso": F.lit(None).cast("string"),
            "date_raw": F.lit(""),
        }
    )
    document = F.concat(header_block(), F.lit("\n"), F.col("text"))
    return scrub(headed.select(*turns.columns, postprocess(document).alias("markdown")), "markdown")


def turns_to_qa(turns: DataFrame) -> DataFrame:
    """Threads to QA records with rule-based category and model."""
    paired = pair_turns(clean_turns(turns), text="markdown").where("status = 'question'")
    return paired.select(
        F.concat(F.lit("thread-"), F.col("conv_id").cast("string"), F.lit(".md")).alias("file"),
        F.col("turn").alias("item_no"),
        category_rules(F.concat_ws("\n", "issue", "resolution")).alias("category"),
        normalise_model(F.col("issue")).alias("model"),
        "issue",
        "resolution",
        F.lit("").alias("code_snippet"),
        "n_answers",
    )


def turns_to_mix(turns: DataFrame) -> DataFrame:
    """The report at the end of the way: records by category and model."""
    return qa_mix(turns_to_qa(turns))
