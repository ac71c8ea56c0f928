"""Data-quality checks. Each returns the offending rows, so an empty result means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pinned
from .joins import lookup_join

# Fixed value: bytes in a currency code.
CURRENCY_BYTES = 3

PRICE_COLUMNS = ("OpenPrice", "ClosePrice", "HighPrice", "LowPrice", "MarketCap", "Dividend")


def _any(conditions: list[Column]) -> Column:
    return F.coalesce(reduce(or_, conditions), F.lit(False))


def any_null(*columns: str) -> Column:
    return _any([F.col(c).isNull() for c in columns])


def ticker_null() -> Column:
    return any_null("TickerKey", "Currency")


def fact_null() -> Column:
    return any_null("CompanyKey", "TickerKey", "TradingDate")


def currency_malformed() -> Column:
    """Not exactly three bytes long; blank and NULL count, multi-byte letters count as two."""
    return _any([F.col("Currency").isNull(), F.octet_length("Currency") != CURRENCY_BYTES])


def in_future(today: object) -> Column:
    """On or after the given day."""
    # The bare comparison, so that a filter by it reaches the scan; an unknown day is dropped or not counted either way.
    return F.col("TradingDate") >= F.lit(today).cast("date")


def nonpositive(columns: Sequence[str] = PRICE_COLUMNS) -> Column:
    """Any measure at or below zero. Missing dividends are stored as zero and so are reported."""
    return _any([F.coalesce(F.col(c) <= 0, F.lit(False)) for c in columns])


def orphans(
    fact: DataFrame, dimensions: Mapping[str, DataFrame]
) -> DataFrame:
    """Keys of a fact that its dimensions lack, with the number of rows that carry each.

    Fact keys are counted before the shuffle, so a key with many rows costs one row per task.
    """
    found = []
    for key, dimension in dimensions.items():
        used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
        lost = used.join(dimension.select(key).distinct(), key, "left_anti")
        found.append(
            lost.select(F.lit(key).alias("foreign_key"), F.col(key).cast("bigint").alias("key"), "n_rows")
        )
    return reduce(DataFrame.unionByName, found)


def orphan_rows(fact: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    """The rows of a fact whose key the dimension lacks."""
    used = fact.where(F.col(key).isNotNull()).select(key).distinct()
    lost = pinned(used.join(dimension.select(key).distinct(), key, "left_anti"), "orphans")
    return lookup_join(fact, lost, [key], "left_semi")


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def summary(checks: Sequence[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """One row per check with its number of failures; nothing is raised.

    All checks of one table are counted in a single scan of it.
    """
    rows = []
    for df, conditions in checks:
        counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
        pairs = F.array(
            *[F.struct(F.lit(n).alias("test_name"), F.col(n).alias("failures")) for n in conditions]
        )
        rows.append(counted.select(F.explode(pairs).alias("_t")).select("_t.*"))
    return reduce(DataFrame.unionByName, rows)
