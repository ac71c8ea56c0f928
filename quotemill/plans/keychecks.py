"""Key checks on gold, kept up to date: a run counts the keys of the months it changed, never the whole fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.months import MonthTable
from ..schemas import MONTH, STOCK_KEYS
from .warehouse import Warehouse

# Declared keys of the tables, and the dimension each foreign key of a fact refers to.
PRIMARY_KEYS = {
    "DimCompany": ("CompanyKey", "ValidFrom"),
    "DimTicker": ("TickerKey", "ValidFrom"),
    "DimDate": ("DateKey",),
    "FactFinancials": ("CompanyKey", "Year"),
    "FactForbesRank": ("CompanyKey", "Year"),
    "FactStock": STOCK_KEYS,
}
FOREIGN_KEYS = {
    "FactStock": {"CompanyKey": "DimCompany", "TickerKey": "DimTicker", "DateKey": "DimDate"},
    "FactFinancials": {"CompanyKey": "DimCompany"},
    "FactForbesRank": {"CompanyKey": "DimCompany"},
}

COUNTS = T.StructType(
    [T.StructField("key_name", T.StringType()), T.StructField("key", T.LongType()), T.StructField("n_rows", T.LongType())]
)
#: In place of a foreign key's name: the number of primary keys that occur more than once.
REPEATED = "primary key"


def kept(warehouse: Warehouse) -> MonthTable:
    """Counts of the fact's keys by month."""
    return warehouse.months("quality", "FactStock_keys", COUNTS)


def count_keys(fact: DataFrame, primary: Sequence[str] = STOCK_KEYS, foreign: Sequence[str] = tuple(FOREIGN_KEYS["FactStock"])) -> DataFrame:
    """key_name, key, n_rows by month of a fact with its month column.

    Of each foreign key the rows that carry it; one row more tells how many primary keys of the month repeat, which is
    all there is to know, as the primary key has the day in it. Both are counted before the shuffle, each foreign key by
    itself, because one aggregation over all of them holds three rows for every row of the fact, names included.
    """
    counted = []
    for k in foreign:
        own = fact.select(MONTH, F.col(k).cast("long").alias("key")).where("key IS NOT NULL")
        own = own.groupBy(MONTH, "key").agg(F.count(F.lit(1)).alias("n_rows"))
        counted.append(own.select(MONTH, F.lit(k).alias("key_name"), "key", "n_rows"))
    used = reduce(DataFrame.unionByName, counted)
    one = fact.groupBy(MONTH, *primary).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = one.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_rows"))
    return used.unionByName(repeated.select(MONTH, F.lit(REPEATED).alias("key_name"), F.lit(None).cast("long").alias("key"), "n_rows"))


def refresh(warehouse: Warehouse, months: Sequence[int]) -> None:
    """Count the keys of these months of the fact anew."""
    if months:
        kept(warehouse).replace(count_keys(warehouse.months("gold", "FactStock").read(months)), months)


def _orphans(used: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    """Rows that carry a key the dimension lacks."""
    known = dimension.select(F.col(key).cast("long").alias("key")).distinct()
    lost = used.where(F.col("key_name") == key).groupBy("key").agg(F.sum("n_rows").alias("n_rows")).join(known, "key", "left_anti")
    return lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("failures"))


def failures(gold: Mapping[str, DataFrame], counts: DataFrame) -> DataFrame:
    """test_name, failures: for each table the primary keys that repeat, for each foreign key the rows without a match.

    Of the fact only its counts are read.
    """
    found = []
    for name, key in PRIMARY_KEYS.items():
        if name == "FactStock":
            told = counts.where(F.col("key_name") == REPEATED).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("failures"))
        else:
            told = gold[name].groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("failures"))
        found.append(told.select(F.lit(f"{name}_repeated_key").alias("test_name"), "failures"))
    for name, keys in FOREIGN_KEYS.items():
        for key, dimension in keys.items():
            used = counts
            if name != "FactStock":
                used = gold[name].select(F.lit(key).alias("key_name"), F.col(key).cast("long").alias("key")).where("key IS NOT NULL")
                used = used.groupBy("key_name", "key").agg(F.count(F.lit(1)).alias("n_rows"))
            found.append(_orphans(used, key, gold[dimension]).select(F.lit(f"{name}_{key}_orphan").alias("test_name"), "failures"))
    return reduce(DataFrame.unionByName, found)
