"""JSON records to one table: QA rows in fixed shape, other rows as they come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailspark.functions.jsontext import as_text, is_type
from mailspark.functions.text import oneline
from mailspark.sinks.jsonl import QA_FIELDS

SQUEEZED = ("issue", "resolution", "code_snippet")


def is_qa(record: Column) -> Column:
    """All six QA keys are present, whatever their values."""
    keys = F.map_keys(record)
    return F.forall(F.array(*[F.lit(k) for k in QA_FIELDS]), lambda k: F.array_contains(keys, k))


def cell(value: Column) -> Column:
    """A JSON value as cell text: booleans with a capital letter, nested values as JSON."""
    return F.when(is_type(value, "BOOLEAN"), F.initcap(as_text(value))).otherwise(as_text(value))


def tabular_rows(df: DataFrame) -> DataFrame:
    """Add ``is_qa``, ``keys ARRAY<STRING>`` and ``cells MAP<STRING, STRING>`` to parsed lines.

    QA rows keep their six columns only, the three texts on one line; other rows keep all
    keys and squeeze only what was a string.
    """
    record = F.col("record")
    qa_keys = F.array(*[F.lit(k) for k in QA_FIELDS])
    df = df.withColumn("is_qa", is_qa(record))
    df = df.withColumn("keys", F.when(F.col("is_qa"), qa_keys).otherwise(F.map_keys(record)))
    qa_cells = []
    for name in QA_FIELDS:
        value = cell(F.try_element_at(record, F.lit(name)))
        qa_cells += [F.lit(name), oneline(value) if name in SQUEEZED else value]
    free = F.transform_values(
        record, lambda _, v: F.when(is_type(v, "STRING"), oneline(as_text(v))).otherwise(cell(v))
    )
    return df.withColumn("cells", F.when(F.col("is_qa"), F.create_map(*qa_cells)).otherwise(free))


def column_order(rows: DataFrame) -> DataFrame:
    """All keys in order of first appearance: ``column_name, position`` from 0.

    Rows are first reduced to distinct key lists with their first line, which map-side
    combining makes tiny; only these lists are taken apart.  The final ranking sees one row
    per column of the result.
    """
    shapes = rows.groupBy("keys").agg(F.min("line_key").alias("line_key"))
    # The outer form, so that no filter on the keys is inferred, which would parse every line twice.
    seen = shapes.select("line_key", F.posexplode_outer("keys").alias("pos", "column_name"))
    first = seen.filter("column_name IS NOT NULL").groupBy("column_name").agg(F.min(F.struct("line_key", "pos")).alias("first"))
    position = F.row_number().over(Window.orderBy("first")) - 1
    return first.select("column_name", position.cast("bigint").alias("position"))


def column_list(rows: DataFrame) -> list[str]:
    """The header of the table.  A schema lives on the driver, so this is the one collect."""
    return [r["column_name"] for r in column_order(rows).orderBy("position").collect()]


def to_table(rows: DataFrame, columns: list[str] | None = None, keep_key: bool = False) -> DataFrame:
    """One column per key; a missing or null cell is empty."""
    columns = column_list(rows) if columns is None else columns
    cells = [F.coalesce(F.try_element_at("cells", F.lit(c)), F.lit("")).alias(c) for c in columns]
    return rows.select(*(["line_key"] if keep_key else []), *cells)
