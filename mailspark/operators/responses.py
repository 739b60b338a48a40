"""What to make of a model's answer.  Nothing here raises; every answer gets a status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.functions.jsontext import as_text, kind, parse_json, parse_object
from mailspark.functions.text import is_blank

LIST_KEYS = ("items", "qa", "qas", "data")


def scrubbed_text(df: DataFrame, col: str = "response") -> DataFrame:
    """Add ``markdown`` and ``status`` from a ``{"markdown": "..."}`` answer.

    Only a JSON string counts, a number or null does not; an empty string is a success.
    """
    df = df.withColumn("_answer", parse_json(F.col(col)))
    value = F.try_variant_get("_answer", "$.markdown", "variant")
    is_text = kind(value) == "string"
    status = (
        F.when(F.coalesce(F.col(col), F.lit("")) == "", "empty")
        .when(F.col("_answer").isNull(), "bad_json")
        .when(kind(F.col("_answer")) != "object", "not_object")
        .when(is_text, "ok")
        .otherwise("no_markdown")
    )
    return df.withColumns({"status": status, "markdown": F.when(is_text, as_text(value))}).drop("_answer")


def extract_items(df: DataFrame, col: str = "response") -> DataFrame:
    """Add ``items ARRAY<VARIANT>`` and ``status``.

    The list is the answer itself, or the first of items / qa / qas / data that holds a
    list; a key with something else in it is passed over.
    """
    df = df.withColumn("_answer", parse_json(F.col(col)))
    paths = ["$"] + [f"$.{k}" for k in LIST_KEYS]
    items = F.coalesce(*[F.try_variant_get("_answer", p, "array<variant>") for p in paths])
    status = (
        F.when(F.coalesce(F.col(col), F.lit("")) == "", "empty")
        .when(F.col("_answer").isNull(), "bad_json")
        .when(F.col("items").isNull(), "no_list")
        .when(F.size("items") == 0, "no_items")
        .otherwise("ok")
    )
    return df.withColumn("items", items).withColumn("status", status).drop("_answer")


def explode_items(df: DataFrame) -> DataFrame:
    """One row per item in order: ``item_no, item, item_status``; rows without items go."""
    keep = [c for c in df.columns if c != "items"]
    rows = df.select(*keep, F.posexplode("items").alias("item_no", "item"))
    return rows.withColumn("item_status", F.when(kind(F.col("item")) == "object", "ok").otherwise("not_object"))


def _field(name: str) -> Column:
    return F.try_variant_get("item", f"$.{name}", "string").alias(name)


def _code_snippet() -> Column:
    """Null, false, zero, an empty text, list or object all become the empty text."""
    value = F.try_variant_get("item", "$.code_snippet", "variant")
    text = as_text(value)
    empty = (
        text.isNull()
        | ((kind(value) == "number") & (F.try_variant_get(value, "$", "double") == 0))
        | ((kind(value) != "string") & text.isin("false", "[]", "{}"))
    )
    return F.when(empty, "").otherwise(text)


def qa_records(df: DataFrame, file: str = "doc_key") -> DataFrame:
    """Exploded items to the six-field record plus ``item_no``; items that are no objects
    are left out (count them by ``item_status`` before)."""
    return df.filter("item_status = 'ok'").select(
        F.col(file).alias("file"),
        "item_no",
        _field("category"),
        _field("model"),
        _field("issue"),
        _field("resolution"),
        _code_snippet().alias("code_snippet"),
    )


def distil_response(df: DataFrame, col: str = "response", file: str = "doc_key") -> DataFrame:
    """Answers to QA records in one go."""
    return qa_records(explode_items(extract_items(df, col)), file)


def merge_maps(base: Column, patch: Column) -> Column:
    """Right-biased merge that keeps the key order: own keys in place with the patch's value
    (also null) where it has one, then the patch's new keys."""
    kept = F.transform_values(base, lambda k, v: F.when(F.map_contains_key(patch, k), F.try_element_at(patch, k)).otherwise(v))
    added = F.map_filter(patch, lambda k, _: ~F.map_contains_key(base, k))
    return F.map_concat(kept, added)


def merge_record(df: DataFrame, base: str = "record", response: str = "response", out: str = "record") -> DataFrame:
    """Merge a rewrite answer into its record; the record stays as it was, with the reason
    in ``status``, where the answer is missing, blank or no JSON object."""
    df = df.withColumn("_patch", parse_object(F.col(response)))
    status = (
        F.when(F.col("_patch").isNotNull(), "rewritten")
        .when(F.col(response).isNull(), "kept_no_answer")
        .when(is_blank(F.col(response)), "kept_blank")
        .otherwise("kept_bad_json")
    )
    merged = F.when(F.col("_patch").isNull(), F.col(base)).otherwise(merge_maps(F.col(base), F.col("_patch")))
    return df.withColumns({"status": status, out: merged}).drop("_patch")
