"""Cleaning expressions. All of them are built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number, and how a rejected value is reported.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER_PATTERN = r"^[+-]?\d+$"
BAD_NUMBER_REASON = "could not convert string to float: '%s'"
BAD_INTEGER_REASON = "invalid literal for int() with base 10: '%s'"

# The characters a trim removes.
WHITESPACE = (
    " \t\n\r\u000b\u000c\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(column, F.lit(WHITESPACE))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and leave the others as they are."""
    return df.select(
        *[
            strip(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def is_blank(column: Column) -> Column:
    return F.coalesce(strip(column), F.lit("")) == ""


def with_ticker(df: DataFrame, column: str) -> DataFrame:
    """Rows that have a ticker, one that is neither NULL nor blank."""
    return df.where(~is_blank(F.col(column)))


def amount_text(column: Column) -> Column:
    """An amount without thousands separators and currency signs."""
    return strip(F.regexp_replace(column, "[,$]", ""))


def parse_amount(column: Column, numeric: bool = False) -> Column:
    """Amount in billions to millions: blank is 0.0, text that is no number is NULL."""
    if numeric:
        return F.coalesce(column.cast("double") * 1000, F.lit(0.0))
    text = amount_text(column)
    return F.when(is_blank(column), F.lit(0.0)).when(
        text.rlike(NUMBER_PATTERN), text.try_cast("double") * 1000
    )


def parse_rank(column: Column) -> Column:
    text = strip(column)
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))


def or_default(column: Column, kind: str, default: object) -> Column:
    """Cast with a default for NULL or text that does not convert."""
    return F.coalesce(column.try_cast(kind), F.lit(default).cast(kind))


def nan_to_null(column: Column, kind: str = "double") -> Column:
    """NaN and NULL become NULL, everything else is cast; casting to bigint truncates."""
    number = column.cast("double")
    return F.when(~F.isnan(number), number.cast(kind))


def year_from_file(file_name: Column) -> Column:
    """The year a file's name ends in, as in ``..._2025.csv``, also for a folder of part files."""
    return F.regexp_extract(file_name, r"_(\d{4})\.[^./]+(/[^/]*)?$", 1).try_cast("int")
