"""Masking expressions for readers with limited access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published masks.
MASK_TAIL = "***"
VISIBLE_CHARACTERS = 3
RARE_LABEL = "Other"
RARE_BELOW = 10
RANGE_WIDTH = 100
RANGE_DASH = "–"


def mask_prefix(column: Column, visible: int = VISIBLE_CHARACTERS) -> Column:
    return F.concat(F.substring(column, 1, visible), F.lit(MASK_TAIL))


def mask_range(column: Column, width: int = RANGE_WIDTH) -> Column:
    """The bucket a non-negative number falls into, as 'low–high'."""
    number = column.cast("bigint")
    low = number - number % width
    return F.concat(low.cast("string"), F.lit(RANGE_DASH), (low + (width - 1)).cast("string"))
