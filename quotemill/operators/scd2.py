"""Slowly changing dimensions: every version of a key with the time it was valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import date_key

VALID_FROM, VALID_TO = "valid_from", "valid_to"

# Open versions live in a partition of their own, closed ones in that of the day they closed.
CLOSED_ON = "closed_on"
OPEN = 0


def one_per_key(
    staged: DataFrame, key: str, check: Sequence[str], on_conflict: str = "raise"
) -> DataFrame:
    """Staged rows reduced to one per key.

    Rows of a key that differ in a checked column cannot both be current. ``raise`` fails the job
    naming the key; ``latest`` keeps the greatest in column order. Columns that are not checked
    take the greatest row's value.
    """
    rest = [c for c in staged.columns if c != key]
    ordered = [c for c in check if c != key] + [c for c in rest if c not in check]
    picked = F.struct(*[F.col(c) for c in ordered])
    checked = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in check])
    # Repeats are dropped by hash first: what is left to sort is one row per distinct state.
    one = staged.distinct().groupBy(key).agg(
        F.max(picked).alias("_row"), F.min(checked).alias("_lo"), F.max(checked).alias("_hi")
    )
    row: Column = F.col("_row")
    if on_conflict == "raise":
        clash = F.concat(F.lit("conflicting staged rows for key "), F.col(key).cast("string"))
        row = F.when(F.col("_lo") == F.col("_hi"), row).otherwise(F.raise_error(clash))
    elif on_conflict != "latest":
        raise ValueError(f"unknown conflict rule: {on_conflict}")
    return one.select(key, row.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def _moment(as_of: object) -> Column:
    return F.lit(as_of).cast("timestamp")


def merge_open(
    open_rows: DataFrame, staged: DataFrame, key: str, check: Sequence[str], as_of: object
) -> DataFrame:
    """Versions that result from comparing the open rows with a staged snapshot.

    A key unseen so far opens a version; a changed one closes its version at ``as_of`` and opens a
    new one; a key that vanished stays open. Both sides have one row per key, so the join is even.
    """
    columns = [c for c in open_rows.columns if c not in (VALID_FROM, VALID_TO)]
    old = open_rows.select(
        F.struct(*columns, VALID_FROM, F.col(VALID_TO)).alias("_old"), F.col(key).alias("_k")
    )
    new = staged.select(F.struct(*columns).alias("_new"), F.col(key).alias("_nk"))
    moment = _moment(as_of)
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            start.cast("timestamp").alias(VALID_FROM),
            end.cast("timestamp").alias(VALID_TO),
        )

    started = F.col(f"_old.{VALID_FROM}")
    nothing = F.lit(None)
    kept = version("_old", started, nothing)
    closed = version("_old", started, moment)
    opened = version("_new", moment, nothing)
    versions = (
        F.when(F.col("_k").isNull(), F.array(opened))
        .when(F.col("_nk").isNull() | same, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    return (
        old.join(new, F.col("_k") == F.col("_nk"), "full_outer")
        .select(F.explode(versions).alias("_v"))
        .select("_v.*")
    )


def first_snapshot(staged: DataFrame, as_of: object) -> DataFrame:
    """Every staged row as an open version."""
    return staged.withColumn(VALID_FROM, _moment(as_of)).withColumn(
        VALID_TO, F.lit(None).cast("timestamp")
    )


def snapshot(
    versions: DataFrame | None,
    staged: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: object,
    on_conflict: str = "raise",
) -> DataFrame:
    """All versions after one more snapshot; closed versions pass through untouched."""
    staged = one_per_key(staged, key, check, on_conflict)
    if versions is None:
        return first_snapshot(staged, as_of)
    is_open = F.col(VALID_TO).isNull()
    closed = versions.where(~is_open)
    return closed.unionByName(merge_open(versions.where(is_open), staged, key, check, as_of))


def store_snapshot(
    spark: SparkSession,
    path: str,
    staged: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: object,
    first: bool = False,
    on_conflict: str = "raise",
) -> None:
    """Apply a snapshot to a stored dimension, rewriting its open versions only.

    History is never read back or rewritten, apart from versions closed earlier on the same day:
    these share the partition that this run replaces. One job replaces both partitions. Running it
    again with the same input changes nothing.
    """
    if first:
        out = first_snapshot(one_per_key(staged, key, check, on_conflict), as_of)
    else:
        columns = first_snapshot(staged, as_of).schema.fields
        schema = T.StructType([*columns, T.StructField(CLOSED_ON, T.IntegerType())])
        stored = spark.read.schema(schema).parquet(path)
        today = int(str(as_of)[:10].replace("-", ""))
        open_rows = stored.where(F.col(CLOSED_ON) == OPEN).drop(CLOSED_ON)
        same_day = stored.where(F.col(CLOSED_ON) == today).drop(CLOSED_ON)
        staged = one_per_key(staged, key, check, on_conflict)
        out = merge_open(open_rows, staged, key, check, as_of).unionByName(same_day)
    closed_on = F.when(F.col(VALID_TO).isNull(), F.lit(OPEN)).otherwise(date_key(VALID_TO))
    (
        out.withColumn(CLOSED_ON, closed_on)
        .hint("rebalance", CLOSED_ON)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(CLOSED_ON)
        .parquet(path)
    )


def read_snapshot(spark: SparkSession, path: str, current_only: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    if current_only:
        df = df.where(F.col(CLOSED_ON) == OPEN)
    return df.drop(CLOSED_ON)


def expose(versions: DataFrame, columns: Sequence[str], current_only: bool = False) -> DataFrame:
    """A dimension's columns with ValidFrom and ValidTo; all versions unless told otherwise."""
    if current_only:
        versions = versions.where(F.col(VALID_TO).isNull())
    return versions.withColumnsRenamed({VALID_FROM: "ValidFrom", VALID_TO: "ValidTo"}).select(*columns)
