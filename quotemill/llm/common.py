"""Helpers that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pinned

#: Rows in an Arrow batch. Whole texts travel in these batches, so fewer rows bound a worker's memory.
BATCH_ROWS = 1000

#: Six ASCII white-space bytes; bytes.split() cuts at exactly these.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most BATCH_ROWS rows in this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, with the shuffle files of its making dropped.

    Spark drops them at the end of the write under the setting below, or once the driver's JVM collects garbage,
    which a driver with little to do would put off.
    """
    spark = df.sparkSession
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        out = pinned(df, label)
    finally:
        spark.conf.set(name, before)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


#: What a worker remembers from task to task, each with a method clear().
REMEMBERING: list = []


def release(own: object = None) -> None:
    """Let go of what this worker remembers but for ``own``, and give freed memory back to the system: Spark keeps workers,
    and their next task may be another's."""
    import ctypes

    import pyarrow as pa

    for memory in REMEMBERING:
        if memory is not own:
            memory.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's own, where it has one
    if trim:
        trim(0)


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that other columns cannot clash with its own names."""
    small_batches(docs.sparkSession)
    kinds = {"doc_id": "long"}
    return docs.select(*[F.col(f"`{c}`").cast(kinds.get(c, "string")).alias(c) for c in ("doc_id", "text", *more)])


def spare(df: DataFrame, *names: str) -> list[str]:
    """These names, changed until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32(column: str) -> Column:
    """crc32 of a column's text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def word_count(text: Column) -> Column:
    """Number of words, as a long; 0 for null."""
    trimmed = F.regexp_replace(text, f"^[{BLANK}]+", "")
    marks = F.length(F.regexp_replace(trimmed, f"{WORD}[{BLANK}]*", "x"))
    return F.coalesce(marks, F.lit(0)).cast("long")


def spread(text: Column, most: int, pieces: int) -> Column:
    """A text of up to ``most`` characters whole; of a longer one ``pieces`` pieces of equal size, at equal distances
    from its first to its last character, with a blank between."""
    size = most // pieces
    gap = (F.length(text) - size) / (pieces - 1)
    parts = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring(text, F.floor(i * gap).cast("int") + 1, F.lit(size)))
    return F.when(F.length(text) <= most, text).otherwise(F.array_join(parts, " "))


def texts_of(column) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), one range after the other."""
    if not len(lengths):
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def slices(items: Sequence, sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items with sizes up to ``most`` in sum; a larger item stands alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(items):
        yield start, len(items)
