"""What the operators of this package share: words, tables in the shared folder, packed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.session import configure, materialise

#: A word is a run of anything but the ASCII white space characters.
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    text = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\f\r":  # one literal separator is cut several times faster than a class
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def written(df: DataFrame) -> DataFrame:
    """The same rows read from a new table in the shared folder: computed once, kept when
    executors are lost."""
    return materialise(df)


def packed(docs: DataFrame, name: str = "row", columns: list[str] | None = None) -> Column:
    """All columns (or those named) as one struct, so that names made by an operator cannot clash with them."""
    return F.struct(*[docs[f"`{c.replace('`', '``')}`"] for c in (docs.columns if columns is None else columns)]).alias(name)


def unpacked(df: DataFrame, columns: list[str], results: dict[str, Column], name: str = "row") -> DataFrame:
    """The packed columns and the results; a result replaces an input column of its name."""
    own = {c.lower() for c in results}
    kept = [F.col(name).getField(c).alias(c) for c in columns if c.lower() not in own]
    return df.select(*kept, *[value.alias(c) for c, value in results.items()])


def narrowed(columns: list[str], name: str = "row") -> Column:
    """Only the named columns of the packed ones.  Without columns there is one of its own, since a struct needs a field."""
    kept = [F.col(name).getField(c).alias(c) for c in columns]
    return F.struct(*(kept or [F.lit(0).alias("_")])).alias(name)
