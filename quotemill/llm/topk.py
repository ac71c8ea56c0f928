"""Exact top-k search by distributed histogram selection.

Queries go in blocks of bounded size against all vectors. For a block, every vector is scored in each pass; passes
refine a global histogram of the scores of each query until a bin holds one score, which is the k-th best. A last
pass keeps the scores above it and, of those equal to it, the smallest ids. A task need not report bins below its own
k-th best, as the global k-th best cannot lie there, so it reports at most k bins a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import small_batches, written

#: Bits of the score that one pass settles; queries of a block; vectors scored at once.
RADIX = 10
BLOCK = 4096
ROWS = 1024

ANSWER = "query_id long, rank int, vec_id long, score long"


def scaled(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component, as longs.

    Left out: null vectors, vectors with a null or non-finite component, empty vectors, and rows without id.
    """
    small_batches(vectors.sparkSession)
    x = F.col(f"`{vector_column}`").cast("array<double>")
    held = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL AND size(x) > 0")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return held.where(finite).select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in float64 where all partial sums fit its 53 bits, else in int64."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if largest < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def _blocks(batches: Iterator, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the vectors of one dimension."""
    for batch in batches:
        column = batch.column("v")
        sizes = np.diff(column.offsets.to_numpy())
        ids = batch.column("vec_id").to_numpy()
        rows = np.flatnonzero(sizes == dim)
        if not len(rows):
            continue
        flat = column.flatten().to_numpy()
        starts = column.offsets.to_numpy()[:-1] - column.offsets.to_numpy()[0]
        matrix = flat[starts[rows][:, None] + np.arange(dim)]
        for at in range(0, len(rows), ROWS):
            yield ids[rows][at : at + ROWS], matrix[at : at + ROWS]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best other vectors, all if fewer.

    is_query: a condition on `vec_id`. Ties go to smaller ids. Vectors of another dimension than the query's are no
    candidates. Rows that repeat an id are candidates each; they ask once, with the smallest of their vectors, and
    never find each other. A table without queries or vectors gives no rows.
    """
    rows = written(scaled(vectors, id_column, vector_column, scale), "vectors")
    spark = vectors.sparkSession
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = written(asked.withColumn("dim", F.size("v")), "queries")
    path = fresh_path(spark, "best")
    spark.createDataFrame([], ANSWER).write.parquet(path)
    for dim, count in sorted((r["dim"], r["n"]) for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        own = asked.where(F.col("dim") == dim)
        cuts = -(-count // block)
        for i in range(cuts):
            chosen = own if cuts == 1 else own.where(F.pmod(F.xxhash64("vec_id"), F.lit(cuts)) == i)
            table = chosen.select("vec_id", "v").orderBy("vec_id").toArrow()
            if table.num_rows:
                ids = table.column("vec_id").to_numpy()
                matrix = np.array(table.column("v").to_pylist(), np.int64)
                # Written at once: a plan would keep each block's queries on the driver until its end.
                _answer(rows, ids, matrix, k).write.mode("append").parquet(path)
    return spark.read.schema(ANSWER).parquet(path)


def _answer(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """The best of one block of queries of one dimension."""
    import pyarrow as pa

    dim = queries.shape[1]
    bound = rows.where(F.size("v") == dim).agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
    # Sums beyond 2^61 wrap around in any case, as longs do.
    reach = min(int(np.abs(queries.astype(np.float64)).sum(axis=1).max()) * int(bound), 1 << 61)
    shift = max(0, (2 * reach + 1).bit_length() - RADIX)
    low = np.full(len(ids), -reach, np.int64)  # the k-th best score lies in [low, low + width)
    high = np.full(len(ids), reach + 1, np.int64)
    above = np.zeros(len(ids), np.int64)  # scores known to lie above that range

    def histogram(low, high, above, shift):
        def counted(batches):
            held: dict[tuple[int, int], int] = {}
            for own, matrix in _blocks(batches, dim):
                scores = products(queries, matrix)
                scores[ids[:, None] == own[None, :]] = -reach - 1
                inside = (scores >= low[:, None]) & (scores < high[:, None])
                query, at = np.nonzero(inside)
                bins = (scores[query, at] - low[query]) >> shift
                keys, times = np.unique((query.astype(np.int64) << RADIX + 2) | bins, return_counts=True)
                for key, n in zip(keys.tolist(), times.tolist()):
                    held[key] = held.get(key, 0) + n
                if len(held) > 1 << 20:
                    held = _best_bins(held, k - above)
            held = _best_bins(held, k - above)
            key = np.fromiter(held.keys(), np.int64, len(held))
            yield pa.RecordBatch.from_arrays(
                [pa.array((key >> RADIX + 2).astype(np.int32)), pa.array((key & (1 << RADIX + 2) - 1).astype(np.int32)), pa.array(np.fromiter(held.values(), np.int64, len(held)))],
                names=["q", "bin", "n"],
            )

        return rows.mapInArrow(counted, "q int, bin int, n long")

    while True:
        bins = histogram(low, high, above, shift).groupBy("q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.col("bin").desc())
        summed = bins.withColumn("upto", F.sum("n").over(down))
        need = F.element_at(F.lit((k - above).tolist()), F.col("q") + 1)
        hit = summed.where((F.col("upto") - F.col("n") < need) & (F.col("upto") >= need))
        found = hit.select("q", "bin", (F.col("upto") - F.col("n")).alias("more")).toArrow()
        q, b, more = (found.column(c).to_numpy() for c in ("q", "bin", "more"))
        # Queries with fewer than k other vectors keep all of them: their range falls to the lowest score.
        short = np.ones(len(ids), bool)
        short[q] = False
        start = low.copy()
        low[q] = start[q] + (b.astype(np.int64) << shift)
        high[q] = np.minimum(high[q], low[q] + (1 << shift))
        above[q] += more
        low[short], high[short], above[short] = -reach, -reach + 1, 0
        if shift == 0:
            break
        shift = max(0, shift - RADIX)

    def kept(batches):
        best: dict[int, list[tuple[int, int]]] = {}
        for own, matrix in _blocks(batches, dim):
            scores = products(queries, matrix)
            scores[ids[:, None] == own[None, :]] = -reach - 1
            query, at = np.nonzero(scores >= low[:, None])
            for i, s, v in zip(query.tolist(), (-scores[query, at]).tolist(), own[at].tolist()):
                best.setdefault(i, []).append((s, v))
            for i in set(query.tolist()):
                if len(best[i]) > k:
                    best[i] = sorted(best[i])[:k]
        flat = [(int(ids[i]), v, -s) for i, found in best.items() for s, v in found]
        columns = list(zip(*flat)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    final = rows.mapInArrow(kept, "query_id long, vec_id long, score long")
    return final.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best_bins(held: dict[int, int], need: np.ndarray) -> dict[int, int]:
    """Of each query the highest bins that hold as many scores as are still needed."""
    out, query, count = {}, -1, 0
    for key in sorted(held, key=lambda x: (x >> RADIX + 2, -(x & (1 << RADIX + 2) - 1))):
        if key >> RADIX + 2 != query:
            query, count = key >> RADIX + 2, 0
        if count < need[query]:
            out[key] = held[key]
            count += held[key]
    return out
