"""Mail dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone names of RFC 822 with their offsets in minutes.
ZONE_MINUTES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -240, "ADT": -180,
    "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420,
}

_DATE = (
    r"(?i)^\s*(?:[a-z]+,?\s+)?(\d{1,2})\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+(\d{4})"
    r"\s+(\d{1,2}:\d{2}(?::\d{2})?)(?:\s+([+-]\d{4}|[a-z]+))?\s*(?:\([^)]*\))?\s*$"
)


def _local(col: Column) -> Column:
    """The sender's clock as a UTC timestamp, null where the date does not exist."""
    plain = F.regexp_replace(col, _DATE, "$1 $2 $3 $4")
    return F.try_to_timestamp(plain, F.lit("d MMM yyyy H:mm[:ss]"))


def tz_offset_minutes(col: Column) -> Column:
    """The sender's offset; null where unknown (``-0000``, no zone, unlisted zone name)."""
    zone = F.nullif(F.upper(F.regexp_extract(col, _DATE, 5)), F.lit("-0000"))
    named = F.create_map(*[F.lit(x) for pair in ZONE_MINUTES.items() for x in pair])
    # "-0330" is the number -330: hours and minutes carry the sign each.
    number = zone.try_cast("int")
    numeric = (number / 100).cast("int") * 60 + number % 100
    return F.coalesce(numeric, F.try_element_at(named, zone)).cast("int")


def rfc2822_to_iso(col: Column) -> Column:
    """ISO 8601 text that keeps the sender's offset; null where the date is unreadable."""
    offset = tz_offset_minutes(col)
    clock = F.date_format(F.timestamp_seconds(F.abs(offset) * 60), "HH:mm")
    suffix = F.concat(F.when(offset < 0, "-").otherwise("+"), clock)
    return F.concat(F.date_format(_local(col), "yyyy-MM-dd'T'HH:mm:ss"), F.coalesce(suffix, F.lit("")))


def sent_at(col: Column) -> Column:
    """The instant as TIMESTAMP; an unknown offset is read as UTC."""
    offset = F.coalesce(tz_offset_minutes(col), F.lit(0))
    return F.timestamp_seconds(F.unix_timestamp(_local(col)) - offset * 60)
