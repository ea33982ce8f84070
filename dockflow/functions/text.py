"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_label(name: Column | str, longest: int = 40, keep: int = 37) -> Column:
    """Names over ``longest`` characters are cut to ``keep`` and an ellipsis."""
    name = F.col(name) if isinstance(name, str) else name
    cut = F.concat(F.substring(name, 1, keep), F.lit("..."))
    return F.when(F.length(name) > longest, cut).otherwise(name)


def name_contains(col: Column | str, part: str) -> Column:
    """Substring search, written as LIKE so that it can reach the scan."""
    col = F.col(col) if isinstance(col, str) else col
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return col.like(f"%{escaped}%")


def month_in_path(path: Column | str) -> tuple[Column, Column]:
    """(year, month) from the first YYYYMM in a file name; Spark's own part
    files carry no month, so their folder is looked at instead."""
    path = F.col(path) if isinstance(path, str) else path
    # Cut at slashes first: a pattern over the whole path costs far more per row.
    file_name = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    stamp = F.regexp_extract(F.when(file_name.startswith("part-"), folder).otherwise(file_name), r"(\d{4}\d{2})", 1)
    return F.substring(stamp, 1, 4).try_cast("int"), F.substring(stamp, 5, 2).try_cast("int")
