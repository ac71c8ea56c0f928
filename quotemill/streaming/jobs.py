"""The two loads as streaming jobs that end when their input is read, with the batch results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import versions
from ..operators.upsert import append_absent_months, delete_insert_months
from ..plans.warehouse import Warehouse
from ..schemas import SWITCHED
from ..session import pinned

#: Columns that travel with an arriving row: its time of arrival and the start of the span of arrival.
ARRIVED, SPAN = "_arrived", "_span_start"
_MARK = "since long, lead long"  # seconds


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(source).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _run(stream: DataFrame, apply, checkpoint: str, mode: str = "append") -> None:
    query = (
        stream.writeStream.foreachBatch(apply)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def first_arrivals(stream: DataFrame, keys: Sequence[str], order: Sequence[str], recent: str) -> DataFrame:
    """The first row in ``order`` of every key that did not arrive before in the current span of ``recent``.

    Keys are counted by span of arrival. Arrival only moves forward, so the watermark on it drops no row, however old its
    quote, and Spark forgets a span's keys when it is over. (`dropDuplicatesWithinWatermark` would keep whichever of a
    batch's copies a task meets first; the smallest by ``order`` is the same on every attempt.) Two more columns tell when
    the span began and when the row arrived.
    """
    columns = [F.col(c) for c in stream.columns]
    place = [part for c in order for part in (F.col(c).isNull(), F.col(c))]
    counted = (
        stream.withColumn(ARRIVED, F.current_timestamp())
        .withWatermark(ARRIVED, recent)
        .groupBy(F.window(ARRIVED, recent).alias("_span"), *[F.col(k).alias(f"_key_{k}") for k in keys])
        .agg(
            F.min_by(F.struct(*columns), F.struct(*place, F.xxhash64(*columns))).alias("_row"),
            F.min(ARRIVED).alias("_first"),
            F.max(ARRIVED).alias(ARRIVED),
        )
    )
    # A batch has one time of arrival; a key of an earlier batch is updated in the state and goes no further.
    return counted.where(F.col("_first") == F.col(ARRIVED)).select("_row.*", F.col("_span.start").alias(SPAN), ARRIVED)


def _marked(spark: SparkSession, folder: str) -> Row | None:
    return spark.read.schema(_MARK).parquet(folder).first() if versions.exists(spark, f"{folder}/_SUCCESS") else None


def ingest_bronze(
    stream: DataFrame,
    warehouse: Warehouse,
    table: str,
    keys: Sequence[str],
    day: str,
    order: Sequence[str],
    checkpoint: str,
    recent: str = "1 day",
) -> None:
    """Append quotes whose key is not stored yet, batch by batch. ``keys`` hold ``day``, the time of the quote.

    State under a watermark knows the keys that arrived in the current span (`first_arrivals`) and stops their copies.
    What passes is compared with the table only where the key can have arrived earlier: quotes from before the span or
    before this stream began. The margin for sources whose clocks run ahead is the longest lead of a quote over its
    arrival seen so far. Late quotes are therefore never dropped, and a batch of new quotes reads nothing. Rows without
    ``day`` are compared each time.

    Before a batch is appended it is marked, with the stream's start and that lead. A batch that is marked already is a
    second attempt: all of its rows are compared, and what was stored adds nothing. From its start on the stream must be
    the only writer of quotes newer than that. A lost mark means that a batch is compared whole and the start moves to it.
    """
    path = warehouse.path("bronze", table)
    marks = f"{checkpoint.rstrip('/')}-marks"

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = pinned(batch, "arrivals")
        quoted, arrived = F.col(day).cast("timestamp").cast("long"), F.col(ARRIVED).cast("long")
        seen = batch.select(
            F.max(arrived).alias("arrived"), F.max(F.col(SPAN).cast("long")).alias("span"), F.max(quoted - arrived).alias("lead")
        ).first()
        if seen.arrived is None:
            return
        earlier = _before(spark, marks, number)
        again = _marked(spark, f"{marks}/{number}")
        last = again or next((m for m in (_marked(spark, f"{marks}/{n}") for n in earlier) if m), None)
        since, lead = last or (seen.arrived, 0)
        spark.createDataFrame([(since, max(lead, (seen.lead or 0) + 1))], _MARK).coalesce(1).write.mode("overwrite").parquet(f"{marks}/{number}")
        doubtful = F.lit(True) if again or last is None else F.coalesce(quoted <= max(seen.span, since) + lead, F.lit(True))
        exists = warehouse.exists("bronze", table)
        fields = [c for c in batch.columns if c not in (SPAN, ARRIVED)]
        append_absent_months(spark, path, batch.select(*fields), keys, day, order, target_exists=exists, doubtful=doubtful)
        for old in earlier[1:]:
            versions.remove(spark, f"{marks}/{old}")

    _run(first_arrivals(stream, keys, order, recent), apply, checkpoint, mode="update")


def _before(spark: SparkSession, marks: str, number: int) -> list[int]:
    """Marked batches before this one, the latest first."""
    return sorted((int(n) for n in versions.children(spark, marks) if n.isdigit() and int(n) < number), reverse=True)


def upsert_gold(
    stream: DataFrame,
    warehouse: Warehouse,
    table: str,
    keys: Sequence[str],
    day: str,
    checkpoint: str,
    sort: Sequence[str] = (),
) -> None:
    """Delete-and-insert every batch into a gold table stored by month.

    The fact's months are switched in the catalog, so a batch that fails midway changes nothing and is taken again.
    """
    path = warehouse.path("gold", table)

    def apply(batch: DataFrame, _: int) -> None:
        if ("gold", table) in SWITCHED:
            replace(warehouse.months("gold", table), spark=batch.sparkSession).delete_insert(batch, keys)
        else:
            delete_insert_months(batch.sparkSession, path, batch, keys, day, sort)

    _run(stream, apply, checkpoint)
