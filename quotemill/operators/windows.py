"""Window computations that do not put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import pinned
from .joins import lookup_join


def _tag(column: str) -> Column:
    """A grouping value as text that keeps NULL apart from every value and can be joined on."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def rolling_mean(
    df: DataFrame,
    partition: Sequence[str],
    bucket: str,
    order: Sequence[str],
    value: str,
    rows: int,
    out: str,
) -> DataFrame:
    """Mean of ``value`` over the current and the ``rows - 1`` preceding rows of each partition.

    Rows are ordered by ``bucket``, which has no NULL, and then ``order``, which must be unique
    within a bucket or break ties by the value itself. A window over the whole partition would sort
    a group such as one large industry in one task. Here each (partition, bucket) is its own
    window, and only the first rows of a bucket need values from before it: each bucket is handed
    the last ``rows - 1`` rows that precede it. Those grow with the number of buckets, not rows.

    Rows are shuffled by (partition, bucket), and the join of what buckets hand on keeps that
    partitioning. Pass only the columns named here and Spark uses the same shuffle for both sides.
    """
    reach = rows - 1
    tags = [f"_t{i}" for i in range(len(partition))]
    group = [*tags, bucket]
    tagged = df.select("*", *[_tag(c).alias(t) for c, t in zip(partition, tags)])
    number = F.col(value)
    inside = Window.partitionBy(*group).orderBy(*order)
    frame = inside.rowsBetween(-reach, Window.currentRow)
    placed = tagged.select(
        "*",
        F.row_number().over(inside).alias("_at"),
        F.sum(number).over(frame).alias("_sum"),
        F.count(number).over(frame).alias("_n"),
    )

    size = F.count(F.lit(1)).over(Window.partitionBy(*group))
    # The same columns in the same order as above, so that Spark sees one shuffle for both.
    kept = [c for c in tagged.columns if c in {*partition, *group, *order, value}]
    last = tagged.select(
        *kept, F.row_number().over(inside).alias("_at"), size.alias("_size")
    ).where(F.col("_at") > F.col("_size") - reach)
    earlier = Window.partitionBy(*partition).orderBy(bucket, "_at")
    carried = (
        last.select(
            *group,
            F.collect_list(F.struct(number.cast("double").alias("v"))).over(earlier.rowsBetween(-reach, -1)).alias("_carry"),
            F.lag(bucket).over(earlier).alias("_before"),
        )
        .where(F.col("_before").isNotNull() & (F.col("_before") != F.col(bucket)))
        .drop("_before")
    )

    wanted = F.least(F.lit(reach + 1) - F.col("_at"), F.size("_carry"))
    borrowed = F.when(wanted > 0, F.slice("_carry", F.size("_carry") - wanted + 1, wanted))
    total = F.aggregate(borrowed, F.lit(0.0), lambda acc, item: acc + F.coalesce(item["v"], F.lit(0.0)))
    count = F.size(F.filter(borrowed, lambda item: item["v"].isNotNull()))
    lent = borrowed.isNotNull()
    whole = F.coalesce(F.col("_sum").cast("double"), F.lit(0.0)) + F.when(lent, total).otherwise(F.lit(0.0))
    number_of = F.col("_n") + F.when(lent, count).otherwise(F.lit(0))
    return placed.join(carried, group, "left").select(*df.columns, F.try_divide(whole, number_of).alias(out))


def growth(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Relative change from the previous row; NULL without one or when it is zero.

    For rows that are already aggregated, such as one per industry and year.
    """
    before = F.lag(value).over(Window.partitionBy(*partition).orderBy(*order))
    return df.withColumn("_before", before).withColumn(
        out, F.try_divide(F.col(value) - F.col("_before"), F.col("_before"))
    ).drop("_before")


def group_count(df: DataFrame, group: Sequence[str], out: str) -> DataFrame:
    """Size of its group on every row.

    The counts are aggregated before the shuffle and joined back, because a window would hold each
    whole group in one task. They are written first, so the join broadcasts them when they are
    small and spreads heavy groups otherwise. NULL is a group of its own.
    """
    keyed = [f"_k{i}" for i in range(len(group))]
    tags = [_tag(c).alias(k) for c, k in zip(group, keyed)]
    counts = df.groupBy(*tags).agg(F.count(F.lit(1)).alias(out))
    return lookup_join(df.select("*", *tags), pinned(counts, "counts"), keyed, "left").drop(*keyed)
