"""Mixing sources to target weights.

Documents of a source stand in the order of a hash-random key. Their running word counts are distributed prefix
sums: the key's leading digits cut every source into ranges, sums run inside each range, and the totals of earlier
ranges are added. A source's budget is cut at the exact word; a budget over the source's size takes whole epochs
first. Everything is SQL on built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, spare, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
#: Hex digits of the key that name a range, two at least: 256 ranges of each source, and 16 times as many whenever a range
#: of a source of all rows would hold more than RANGE_ROWS. Moves work only; no result depends on it.
RANGE_DIGITS = 2
RANGE_ROWS = 1 << 20


def range_digits(rows: int) -> int:
    """Digits that keep the ranges of so many rows small."""
    digits = RANGE_DIGITS
    while rows > RANGE_ROWS << 4 * digits:
        digits += 1
    return digits


def budgets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most_epochs: int = 3) -> DataFrame:
    """source, source_size -> the same with weight, target (double) and budget (long).

    Sources by code point, null last, take the weights in turn and share ``share`` of all sizes. A target stops at
    ``most_epochs`` times the source's size and the excess goes to the others by weight. The fixed point has one
    level L with target = min(cap, L x weight): with sources in order of cap / weight, L follows from running
    sums. The table has one row per source, which is what the single-task windows see; never documents.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    weighed = sources.select("source", "source_size", weight.alias("weight")).withColumn(
        "cap", F.col("source_size") * F.lit(float(most_epochs))
    )
    climb = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = climb.rowsBetween(Window.unboundedPreceding, -1)
    after = climb.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("full"),
        F.sum("weight").over(after).alias("open_weight"),
    )
    # The level that holds if exactly the sources before this one are full; it is right where this one is not.
    level = (F.col("total") - F.col("full")) / F.col("open_weight")
    right = F.when(level * F.col("weight") <= F.col("cap"), level)
    leveled = levels.withColumn("level", F.max(right).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return leveled.select("source", "source_size", "weight", target.alias("target")).withColumn(
        "budget", F.least(F.round("target").cast("long"), F.col("source_size") * most_epochs)
    )


def sizes(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, text_hash, size and the hash-random key of each row."""
    rows = documents(docs, "source")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    sized = rows.select("doc_id", "source", digest.alias("text_hash"), word_count(F.col("text")).alias("size"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_hash").cast("binary"))
    return sized.withColumn("key", key)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target and taken (long), one row per row of ``docs``.

    A null text has size 0 and is never taken; a null source is a source of its own. Rows that agree in all of
    id, source and text stand next to each other in the order; they are told apart by nothing, so which of them is
    cut does not change the result as a set. An empty table gives no rows.
    """
    rows = written(sizes(docs, seed), "sizes")  # used three times; a few bytes a document, without texts
    plan = budgets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights=weights, share=share, most_epochs=most_epochs
    )
    ranged = rows.withColumn("range", F.substring("key", 1, range_digits(rows.count())))
    in_range = Window.partitionBy("source", "range").orderBy("key", "doc_id")
    summed = ranged.withColumn(
        "ahead", F.coalesce(F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("source", "range")
        .agg(F.sum("size").alias("range_size"))
        .select(
            F.col("source").alias("of_source"),
            F.col("range").alias("of_range"),
            F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("offset"),
        )
    )
    # Per source and range: what stands before it and what the source may take.
    limits = offsets.join(
        plan.withColumnRenamed("source", "plan_source"), F.col("of_source").eqNullSafe(F.col("plan_source"))
    ).drop("plan_source")
    placed = summed.join(
        limits, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("range") == F.col("of_range"))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long")
    left = F.col("budget") - epochs * F.col("source_size") - F.col("offset") - F.col("ahead")
    last = F.greatest(F.lit(0).cast("long"), F.least("size", left))
    return placed.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", (epochs * F.col("size") + last).alias("taken")
    )


def repeat_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as the mix takes it.

    The texts stay whole, so the one document that a budget cuts is taken if at least half of its words are.
    Documents without words are no part of a mix and go.
    """
    id_, source, digest, times, number = names = spare(docs, "mix_id", "mix_source", "mix_text", "mix_times", "mix_number")
    decided = mix(docs, weights=weights, share=share, most_epochs=most_epochs, seed=seed).where("size > 0")
    decided = decided.groupBy("doc_id", "source", "text_hash").agg(
        F.sum("taken").alias("taken"), F.min("size").alias("size"), F.count("*").alias("rows")
    )
    copies = F.floor(F.col("taken") / (F.col("size") * F.col("rows")) + F.lit(0.5)).cast("int")
    decided = decided.select(
        F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("text_hash").alias(digest), copies.alias(times)
    ).where(F.col(times) > 0)
    hashed = F.md5(F.coalesce(F.col("`text`").cast("string"), F.lit("")).cast("binary"))
    joined = docs.join(
        decided,
        F.col("`doc_id`").cast("long").eqNullSafe(F.col(id_))
        & F.col("`source`").cast("string").eqNullSafe(F.col(source))
        & (hashed == F.col(digest)),
    )
    repeated = joined.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.drop(*names)
