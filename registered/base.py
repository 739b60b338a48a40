"""Registry, table access and the SQL fragments several checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mailspark.session import configure, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# White space for RE2, spelled out (the same set as mailspark.functions.text.WS_CHARS).
S = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
H = r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


class Tables:
    """The parquet tables of one scale factor folder.

    ``parts`` is the number of partitions that ``spread`` deals a table into; where it is not given, it
    is the session's number of shuffle partitions, which a cluster sets for its size.
    """

    def __init__(self, spark: SparkSession, folder: str, parts: int | None = None):
        self.spark = configure(spark)
        ship(spark, __package__)
        self.folder = folder.rstrip("/")
        self.parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, *columns: str) -> DataFrame:
        """A table (or some of its columns) dealt over all cores, for queries that cost much per row: a file of one
        row group is one task, however large.  Operators leave partitions as they are."""
        table = getattr(self, name)
        return (table.select(*columns) if columns else table).repartition(self.parts)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its SQL check if there is one."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def sql_rtrim(x: str) -> str:
    return f"regexp_replace({x}, '[{S}]+$', '')"


def sql_clean(x: str) -> str:
    """Line ends to LF, NUL away, blanks before LF away."""
    unix = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    return f"regexp_replace(replace({unix}, chr(0), ''), '[ \\t]+\\n', chr(10), 'g')"


def sql_lines(x: str) -> str:
    return f"string_split({x}, chr(10))"


def sql_first(lines: str, condition: str) -> str:
    """Number (from 1) of the first line that meets a condition over ``l`` and ``i``."""
    test = condition.replace("{line}", f"{lines}[i]")
    return f"list_min(list_filter(range(1, len({lines}) + 1), lambda i: {test}))"


def sql_cut(source: str, column: str, marker: str, trimmed: bool = False) -> str:
    """Guarded cut as a chain of CTE bodies: takes ``source`` with ``column``, gives ``cut``."""
    line = f"regexp_replace(regexp_replace({{line}}, '^[{S}]+', ''), '[{S}]+$', '')" if trimmed else "{line}"
    first_text = sql_first("l", f"regexp_matches({{line}}, '[^{S}]')")
    hit = sql_first("l", f"i > first_text AND regexp_matches({line}, '{marker}')")
    return f"""
      SELECT * EXCLUDE (l, first_text, hit),
             {sql_rtrim(f"CASE WHEN hit IS NULL THEN {column} ELSE array_to_string(l[1:hit - 1], chr(10)) END")} AS cut
      FROM (SELECT *, {hit} AS hit
            FROM (SELECT *, {first_text} AS first_text
                  FROM (SELECT *, {sql_lines(column)} AS l FROM {source})))"""
