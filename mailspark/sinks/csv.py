"""CSV for spreadsheets: every field quoted, inner quotes doubled, UTF-8 with BOM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOM = "\ufeff"


def quoted(col: Column) -> Column:
    doubled = F.replace(F.coalesce(col.cast("string"), F.lit("")), F.lit('"'), F.lit('""'))
    return F.concat(F.lit('"'), doubled, F.lit('"'))


def csv_line(columns: Sequence[str]) -> Column:
    return F.concat_ws(",", *[quoted(F.col(f"`{c}`")) for c in columns])


def csv_header(columns: Sequence[str]) -> str:
    return ",".join('"' + c.replace('"', '""') + '"' for c in columns)


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, bom: bool = True, single_file: bool = False
) -> None:
    """Write a folder of CSV files, each with its own header (and BOM), so that every file
    opens on its own and no task has to hold the whole result.

    ``single_file`` puts all rows into one file; that is one task, for small results only.
    """
    columns = list(columns or df.columns)
    if single_file:
        df = df.coalesce(1)
    # The running number starts at zero in each partition, hence in each file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit((BOM if bom else "") + csv_header(columns) + "\r\n")
    line = F.when(first, F.concat(header, F.col("_line"))).otherwise(F.col("_line"))
    lines = df.select(csv_line(columns).alias("_line")).select(line.alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\r\n").option("maxRecordsPerFile", 0).text(path)
