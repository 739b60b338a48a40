"""Questions and answers out of threads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.functions.text import strip

DIVIDER = r"(?dm)^---[ \t]*\n(?:[ \t]*\n)*+Reply:[ \t]*\n?"


def split_reply(col: Column) -> tuple[Column, Column]:
    """Question and answer of a document that parts them by a rule and a ``Reply:`` line;
    without a divider all is question and the answer is null."""
    has_divider = col.rlike(DIVIDER)
    question = F.when(has_divider, F.regexp_replace(col, DIVIDER + r"[\s\S]*+\z", "")).otherwise(col)
    answer = F.when(has_divider, F.regexp_replace(col, r"(?s)\A.*?" + DIVIDER, ""))
    return strip(question), strip(answer)


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: Column,
    out: str,
    upto: int = 0,
    width: int = 1024,
    levels: int = 2,
) -> DataFrame:
    """Add the running maximum of ``value`` along ``pos`` within ``keys``; ``upto=-1`` leaves
    the row itself out.

    No window spans a whole group.  Rows are scanned within blocks of ``width`` positions;
    the block maxima, one row per block, get their own running maximum in the same way,
    ``levels`` deep; the two meet in a join on group and block.  A group that holds a third
    of all rows is thus spread over all tasks, and the rows themselves move only once:
    the window and the join share one hash partitioning.
    """
    if levels == 0:
        window = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, upto)
        return df.withColumn(out, F.max(value).over(window))
    block, before = f"_block{levels}", f"_before{levels}"
    blocked = df.withColumn(block, F.floor(F.col(pos) / width))
    totals = blocked.groupBy(*keys, block).agg(F.max(value).alias("_top"))
    totals = running_max(totals, keys, block, F.col("_top"), before, -1, width, levels - 1)
    window = Window.partitionBy(*keys, block).orderBy(pos).rowsBetween(Window.unboundedPreceding, upto)
    inner = blocked.withColumn(out, F.max(value).over(window))
    joined = inner.join(totals.select(*keys, block, before), [*keys, block], "left")
    return joined.withColumn(out, F.greatest(out, before)).drop(block, before)


def answer_turns(
    df: DataFrame,
    thread: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    question_role: str = "user",
    answer_role: str = "assistant",
) -> DataFrame:
    """Every turn with the question it belongs to: ``thread, turn, text, question_turn, status``.

    ``status`` is ``question``, ``answer``, ``orphan_answer`` (before the first question) or
    ``other_role``; the last two have no question.  No group of a thread is formed."""
    rows = df.select(thread, turn, role, text)
    is_question = F.coalesce(F.col(role) == question_role, F.lit(False))
    rows = running_max(rows, [thread], turn, F.when(is_question, F.col(turn)), "question_turn")
    is_answer = F.coalesce(F.col(role) == answer_role, F.lit(False))
    status = F.when(is_question, "question").when(~is_answer, "other_role").when(F.col("question_turn").isNull(), "orphan_answer").otherwise("answer")
    rows = rows.withColumn("status", status)
    belongs = F.col("status").isin("question", "answer")
    return rows.select(thread, turn, text, F.when(belongs, F.col("question_turn")).alias("question_turn"), "status")


def pair_turns(
    df: DataFrame,
    thread: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    question_role: str = "user",
    answer_role: str = "assistant",
) -> DataFrame:
    """One row per question, whatever the number of its answers: ``thread, turn, status, issue,
    resolution, n_answers``, the answers joined in order.

    Turns that belong to no question keep a row of their own with their text as
    ``resolution``.  A thread whose answers do not fit one cell is for ``answer_turns``.
    """
    rows = answer_turns(df, thread, turn, role, text, question_role, answer_role)
    paired = rows.where(F.col("question_turn").isNotNull())
    answer = F.when(F.col("status") == "answer", F.struct(F.col(turn).alias("turn"), F.col(text).alias("text")))
    grouped = paired.groupBy(thread, F.col("question_turn").alias(turn)).agg(
        F.max(F.when(F.col("status") == "question", F.col(text))).alias("issue"),
        F.array_sort(F.collect_list(answer)).alias("_answers"),
    )
    joined = F.array_join(F.col("_answers")["text"], "\n\n")
    questions = grouped.select(
        thread, turn, F.lit("question").alias("status"), "issue",
        F.when(F.size("_answers") > 0, joined).alias("resolution"),
        F.size("_answers").cast("bigint").alias("n_answers"),
    )
    alone = rows.where(F.col("question_turn").isNull()).select(
        thread, turn, "status", F.lit(None).cast("string").alias("issue"), F.col(text).alias("resolution"), F.lit(0).cast("bigint").alias("n_answers")
    )
    return questions.unionByName(alone)
