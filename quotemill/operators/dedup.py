"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import pinned

# Up to this many repeated keys are told to every task, eight bytes each.
TOLD_KEYS = 1_000_000


def _one_per_key(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # A filter on row_number() = 1 is applied by Spark before the shuffle as well, so a key that
    # holds a large share of the rows sends at most one row per map task.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def _one_per_repeated_key(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    """The same where most keys come once: only rows of keys that come again are sorted and shuffled.

    A first pass counts hashes of the keys. Rows whose hash comes once stay where they are; that several keys share a hash
    only sends their rows the long way. Where too many hashes repeat to tell every task, all rows go that way. The pass
    runs at once and ``df`` is computed anew after it, so its keys must not change from one reading to the next.
    """
    key_hash = F.xxhash64(*keys).alias("_hash")
    counted = df.select(key_hash).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = pinned(counted.where(F.col("_n") > 1).select("_hash"), "repeated")
    n = repeated.count()
    if n == 0:
        return df
    if n > TOLD_KEYS:
        return _one_per_key(df, keys, order)
    hashed, told = df.select("*", key_hash), F.broadcast(repeated)
    once, again = (hashed.join(told, "_hash", how).select(*df.columns) for how in ("left_anti", "left_semi"))
    return once.unionByName(_one_per_key(again, keys, order))


def last_version(
    df: DataFrame, keys: Sequence[str], version: Sequence[str], ties: Sequence[str] | None = None, mostly_once: bool = False
) -> DataFrame:
    """The row with the highest version of each key.

    Equal versions are settled by ``ties``, by default every other column, so that the outcome
    never depends on the order of arrival. ``mostly_once`` says that few keys have several rows; the
    outcome is the same, what is shuffled is less.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c not in version]
    reduced = _one_per_repeated_key if mostly_once else _one_per_key
    return reduced(df, keys, [F.col(c).desc_nulls_last() for c in [*version, *ties]])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], mostly_once: bool = False) -> DataFrame:
    """The first row of each key in the given input order."""
    reduced = _one_per_repeated_key if mostly_once else _one_per_key
    return reduced(df, keys, [F.col(c).asc_nulls_last() for c in order])


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of the input order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
