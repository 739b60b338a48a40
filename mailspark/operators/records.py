"""The alternative QA record: ``question, answer, product, tags[], source_note``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("file", "item_no", "question", "answer", "product", "tags", "source_note")


def alternative_records(df: DataFrame, file: str = "doc_key") -> DataFrame:
    """Exploded items (``item_no, item, item_status``) to alternative records."""

    def text(name: str) -> Column:
        return F.try_variant_get("item", f"$.{name}", "string").alias(name)

    tags = F.try_variant_get("item", "$.tags", "array<string>")
    return df.filter("item_status = 'ok'").select(
        F.col(file).alias("file"),
        "item_no",
        text("question"),
        text("answer"),
        text("product"),
        F.coalesce(tags, F.array().cast("array<string>")).alias("tags"),
        text("source_note"),
    )


def to_alternative(qa: DataFrame, tags: Column | None = None, source_note: Column | None = None) -> DataFrame:
    """QA records in the alternative shape; the category is the only tag by default."""
    default_tags = F.filter(F.array("category"), lambda t: t.isNotNull())
    return qa.select(
        "file",
        "item_no",
        F.col("issue").alias("question"),
        F.col("resolution").alias("answer"),
        F.col("model").alias("product"),
        (default_tags if tags is None else tags).alias("tags"),
        (F.lit(None).cast("string") if source_note is None else source_note).alias("source_note"),
    )


def from_alternative(alt: DataFrame, category: Column | None = None) -> DataFrame:
    """Alternative records as QA records; the first tag is the category by default."""
    first_tag = F.try_element_at("tags", F.lit(1))
    return alt.select(
        "file",
        "item_no",
        (first_tag if category is None else category).alias("category"),
        F.col("product").alias("model"),
        F.col("question").alias("issue"),
        F.col("answer").alias("resolution"),
        F.lit("").alias("code_snippet"),
    )
