"""Strict JSON over text columns.

Spark's JSON functions stop at the end of the first value and ignore what follows.
A document counts as JSON here only if it is ONE value and nothing else.  Wrapping the
text in an array turns trailing text into a syntax error; a text that closes that array
itself (it needs a ``]`` for this) cannot at the same time close an object, so a second
look inside an object wrapper settles those rare texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_STRICT = {"allowSingleQuotes": "false"}


def _whole(col: Column) -> Column:
    boxed = F.from_json(F.concat(F.lit('{"v":'), col, F.lit("}")), "map<string,variant>", _STRICT)
    return (~F.contains(col, F.lit("]"))) | F.coalesce(F.size(boxed) == 1, F.lit(False))


def _only(values: Column, element: str, col: Column) -> Column:
    """The single element of an array, null where there are none or several.  A fold names
    the array once, so it is parsed once."""
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast(element).alias("value"))
    return F.aggregate(
        values,
        start,
        lambda acc, x: F.struct((acc["n"] + 1).alias("n"), x.alias("value")),
        lambda acc: F.when((acc["n"] == 1) & _whole(col), acc["value"]),
    )


def parse_json(col: Column) -> Column:
    """VARIANT of a strictly valid JSON text of any shape, else null.

    Duplicate keys need ``spark.sql.variant.allowDuplicateKeys`` (see ``session``).
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), col, F.lit("]")))
    return _only(F.try_variant_get(boxed, "$", "array<variant>"), "variant", col)


def _last_wins(record: Column) -> Column:
    """A map without repeated keys: each key where it first stood, with its last value."""
    keys = F.array_distinct(F.map_keys(record))
    entries = F.map_entries(record)
    unique = F.transform(
        keys, lambda k: F.struct(k, F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"])
    )
    return F.when(F.size(keys) < F.size(record), F.map_from_entries(unique)).otherwise(record)


def parse_object(col: Column) -> Column:
    """MAP<STRING, VARIANT> of a strictly valid JSON object, keys in text order and the
    last of duplicate keys winning; null for anything else."""
    kind_of_map = "map<string,variant>"
    listed = F.from_json(F.concat(F.lit("["), col, F.lit("]")), f"array<{kind_of_map}>", _STRICT)
    return _only(F.transform(listed, _last_wins), kind_of_map, col)


_KINDS = {"VOID": "null", "STRING": "string", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"}


def kind(value: Column) -> Column:
    """Type of a VARIANT: one of null, string, boolean, number, array, object."""
    name = F.regexp_extract(F.coalesce(F.schema_of_variant(value), F.lit("VOID")), "^[A-Z]+", 0)
    names = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, name), F.lit("number"))


def is_type(value: Column, name: str) -> Column:
    """Whether a VARIANT has a plain type such as STRING or BOOLEAN."""
    return F.coalesce(F.schema_of_variant(value) == name, F.lit(False))


def as_text(value: Column) -> Column:
    """A VARIANT as text: strings as they are, null as null, the rest as JSON."""
    return F.try_variant_get(value, "$", "string")
