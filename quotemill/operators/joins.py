"""Joins of large tables with lookups, safe when a few keys hold most rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup is broadcast by hint only when it is known to have at most this many rows.
BROADCAST_ROWS = 100_000

# Keys tracked per pass; a key with less than 1/HEAVY_KEYS of the rows is never called heavy.
HEAVY_KEYS = 1024

_SALT = "_salt"


def broadcast_within(lookup: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast when ``rows``, a proven upper bound of the lookup's size, is small."""
    return F.broadcast(lookup) if rows <= BROADCAST_ROWS else lookup


def _key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c).cast("string") for c in on])


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _broadcast_limit(spark: SparkSession) -> int:
    """The threshold as Spark itself parses it, with whatever unit it was set."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df``, the figure its broadcast decision uses."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def will_broadcast(lookup: DataFrame) -> bool:
    """Whether Spark, by its own size check, is going to broadcast the lookup."""
    return planned_bytes(lookup) <= _broadcast_limit(lookup.sparkSession)


def heavy_keys(df: DataFrame, on: Sequence[str]) -> tuple[list[int], float]:
    """Hashes of the keys that would overload one shuffle partition, and the largest share.

    One pass over the key columns with a mergeable sketch; the result is a single row of at most
    ``HEAVY_KEYS`` entries however large the input is.
    """
    top = F.expr(f"approx_top_k(h, {HEAVY_KEYS}, {16 * HEAVY_KEYS})")
    row = df.select(_key_hash(on).alias("h")).agg(top.alias("top"), F.count("h").alias("n")).first()
    if not row.n:
        return [], 0.0
    floor = row.n * max(1 / HEAVY_KEYS, 2 / _shuffle_partitions(df.sparkSession))
    heavy = [entry for entry in row.top if entry["count"] >= floor]
    share = max((entry["count"] / row.n for entry in heavy), default=0.0)
    return [entry["item"] for entry in heavy], share


def spread_join(
    large: DataFrame, lookup: DataFrame, on: Sequence[str], how: str, hashes: list[int], spread: int
) -> DataFrame:
    """Join with the rows of the given keys spread over ``spread`` partitions each.

    Only the lookup rows of those keys are repeated. The salt depends on a row's content and its
    input partition alone, never on row order, so a recomputed task makes the same choice.
    """
    heavy = _key_hash(on).isin(hashes)
    content = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in large.columns]), F.lit(spread))
    salt = F.pmod(content + F.spark_partition_id(), F.lit(spread)).cast("int")
    all_salts = F.sequence(F.lit(0), F.lit(spread - 1))
    salted = large.withColumn(_SALT, F.when(heavy, salt).otherwise(F.lit(0)))
    repeated = lookup.withColumn(
        _SALT, F.explode(F.when(heavy, all_salts).otherwise(F.array(F.lit(0))))
    )
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def lookup_join(
    large: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", unique: bool = False
) -> DataFrame:
    """Join a table that may be skewed on ``on`` with a lookup.

    ``unique`` says that ``on`` is a key of the large side too, which therefore has no heavy keys.

    ``how`` is inner, left, left_semi or left_anti. When Spark will broadcast the lookup by its
    own size check, nothing else is needed. Otherwise heavy keys of the large side are found in
    one narrow pass and spread in proportion to their share of the rows.
    """
    if unique or will_broadcast(lookup):
        return large.join(lookup, list(on), how)
    hashes, share = heavy_keys(large, on)
    if not hashes:
        return large.join(lookup, list(on), how)
    spread = max(2, math.ceil(share * _shuffle_partitions(large.sparkSession)))
    return spread_join(large, lookup, on, how, hashes, spread)


def map_left(rows: DataFrame, mapping: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach a mapping on several keys, keeping rows that have none."""
    return lookup_join(rows, mapping, on, "left")


def unresolved(rows: DataFrame, mapping: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose keys the mapping does not contain."""
    return lookup_join(rows, mapping.select(*on).distinct(), on, "left_anti")


def existing(rows: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose keys the target already holds.

    The target's keys are made distinct first, before the shuffle and after it, so neither a
    target key with many versions nor the join itself gathers them in one task.
    """
    return lookup_join(rows, target.select(*on).distinct(), on, "left_semi")
