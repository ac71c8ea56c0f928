"""Surrogate keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit separator: keeps ("AB", "C") and ("A", "BC") apart in the text form of a key.
SEPARATOR = "\u001f"


def _text(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def surrogate_key(*columns: Column | str, method: str = "xxhash64") -> Column:
    """A bigint key over the given columns; NULL counts as blank.

    ``xxhash64``  64 bits, chained over the columns, stays inside generated code. The default.
    ``md5``       60 bits of the md5 of the separated text; any engine can recompute it.
    ``narrow``    low 32 bits over the unseparated text. Kept for users who need the narrow form:
                  it merges ("AB", "C") with ("A", "BC") and collides early.
    """
    parts = [_text(c) for c in columns]
    if method == "xxhash64":
        return F.xxhash64(*parts)
    if method == "md5":
        digest = F.md5(F.concat_ws(SEPARATOR, *parts))
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    if method == "narrow":
        return F.xxhash64(F.concat(*parts)).bitwiseAND(F.lit(0xFFFFFFFF))
    raise ValueError(f"unknown key method: {method}")


def date_key(day: Column | str) -> Column:
    """Calendar day as the integer yyyymmdd."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day: Column | str) -> Column:
    """Calendar month as the integer yyyymm, the partition column of dated tables."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 100 + F.month(day)).cast("int")
