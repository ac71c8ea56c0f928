"""Load modes as DataFrame operators, and their application to tables stored by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.keys import month_key
from ..schemas import MONTH
from ..session import pinned
from .dedup import keep_first, last_version
from .joins import lookup_join


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def insert_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str], mostly_once: bool = False
) -> DataFrame:
    """Batch rows to insert: the first of each key, unless the target already holds the key."""
    fresh = keep_first(batch, keys, order, mostly_once)
    return lookup_join(fresh, _keys_of(target, keys), keys, "left_anti", unique=True)


def skip_loaded_days(target: DataFrame, batch: DataFrame, day: str = "trading_day") -> DataFrame:
    """Batch rows of days of which the target has no row at all.

    A batch of one day is therefore taken whole or skipped whole.
    """
    return lookup_join(batch, _keys_of(target, [day]), [day], "left_anti")


def day_is_loaded(target: DataFrame, day: object, column: str = "trading_day") -> bool:
    """Whether any row of ``day`` is in the target; reads at most one row."""
    return not target.where(F.col(column) == F.lit(day)).limit(1).isEmpty()


def delete_keys(
    target: DataFrame, keys: DataFrame, on: Sequence[str], unique: bool = False
) -> DataFrame:
    """Target without the rows whose key is listed; ``unique`` when that is the target's own key."""
    return lookup_join(target, _keys_of(keys, on), on, "left_anti", unique)


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the batch's keys, plus the batch. The keys are the target's primary key."""
    return delete_keys(target, batch, keys, unique=True).unionByName(batch)


def upsert_whole(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Replace or add whole rows by key; the last row of a key within the batch wins."""
    return delete_insert(target, last_version(batch, keys, order), keys)


def newer_than(batch: DataFrame, target: DataFrame, day: str = "TradingDate") -> DataFrame:
    """Batch rows after the latest day of the target; all of them when the target is empty.

    Rows that arrive late, on or before that day, are left out. Use ``delete_insert`` alone to
    take them in.
    """
    latest = latest_day(target, day)
    return batch if latest is None else batch.where(F.col(day) > F.lit(latest))


def latest_day(target: DataFrame, day: str = "TradingDate") -> object:
    return target.agg(F.max(day).alias("d")).first().d


# --- tables stored as parquet, partitioned by month ---------------------------------------------


def with_month(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(MONTH, month_key(day))


def write_months(df: DataFrame, path: str, day: str, sort: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write partitioned by month of ``day``; only months present in ``df`` are replaced.

    The rebalance hint lets Spark split a month that is too large for one task and pack small ones
    together, so file sizes follow the data instead of the calendar.
    """
    out = with_month(df, day).hint("rebalance", MONTH)
    if sort:
        out = out.sortWithinPartitions(MONTH, *sort)
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def copy_months(df: DataFrame, path: str, sort: Sequence[str], months: Sequence[int] | None = None) -> None:
    """Copy a table that is stored by month, partition column included, or some of its months.

    Files hold one month each, so tasks already write to few partitions and nothing is shuffled.
    """
    if months is not None:
        df = df.where(F.col(MONTH).isin(list(months)))
    (
        df.sortWithinPartitions(MONTH, *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_months(
    spark: SparkSession, path: str, months: Sequence[int] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Read a month-partitioned table, or only the given months of it.

    ``schema``, without the partition column, saves opening files to find it out.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())]))
    df = reader.parquet(path)
    if months is not None:
        df = df.where(F.col(MONTH).isin(list(months)))
    return df.drop(MONTH)


def months_of(df: DataFrame, day: str) -> list[int]:
    """The distinct months of a frame, at most twelve per calendar year."""
    return sorted(r[0] for r in df.select(month_key(day)).where(F.col(day).isNotNull()).distinct().collect())


def delete_insert_months(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], day: str, sort: Sequence[str] = ()
) -> None:
    """Delete-and-insert into a month-partitioned table, rewriting only the months touched.

    ``keys`` must determine ``day``, which a key with the date in it does. The batch is written
    first: it is used twice, and its months decide what is read. Running it again changes nothing.
    """
    batch = pinned(batch, "batch")
    months = months_of(batch, day)
    if not months:
        return
    merged = delete_insert(read_months(spark, path, months, batch.schema), batch, keys)
    write_months(merged, path, day, sort)


def append_absent_months(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    day: str,
    order: Sequence[str],
    target_exists: bool = True,
    doubtful: Column | None = None,
    written: bool = False,
) -> list[int] | None:
    """Append the batch's rows whose key is not stored yet, reading only the batch's months.

    ``doubtful`` holds for the rows whose key may be stored; the others are known to be new, each key once, and are
    appended without a look at the table. ``written`` says that the batch is read from files, so that it need not be written
    to be used twice. Returns the months that were read, or None for a table that was new.
    """
    months = None
    if target_exists:
        batch = batch if written else pinned(batch, "batch")
        asked, new = (batch, None) if doubtful is None else (batch.where(doubtful), batch.where(~doubtful))
        months = months_of(asked, day)
        if months or new is None:
            stored = read_months(spark, path, months, batch.schema)
            asked = insert_absent(stored, asked, keys, order, mostly_once=True)
            batch = asked if new is None else asked.unionByName(new)
    else:
        batch = keep_first(batch, keys, order, mostly_once=True)
    with_month(batch, day).hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(path)
    return months
