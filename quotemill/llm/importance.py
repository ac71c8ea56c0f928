"""Importance resampling toward a target distribution, with bit-sliced sums.

Every run of one or more words is a feature, hashed into a bucket. A bucket's gain is the scaled logarithm of how much
more often it occurs in the target than in the documents; a document's weight is the mean gain of its features. A
Gumbel number from the id's hash is added to the weight, and the highest sums are drawn: sampling without replacement
in proportion to exp(weight).

The sums are bit-sliced. The bucket counts of a document become planes of one bit per bucket: plane j holds bit j of
every count. Gains become planes likewise, by sign. For each pair of planes the bits that both have are counted
(AND, popcount) and count for a power of two, so that sums are exact integers and no float enters them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, texts_of, written

BUCKETS = 10_000
SCALE = 1000
#: Documents whose planes are held at once, and words whose buckets a worker remembers. Matters of speed and memory alone.
ROWS = 128
REMEMBERED = 300_000

#: ASCII letters in lower case, digits, and all bytes of other characters; what else ASCII has ends a word.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_WORD).split() if raw else []


class _Buckets(dict):
    """Bucket of a feature."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        from zlib import crc32

        if len(self) > REMEMBERED:
            self.clear()
        found = self[feature] = crc32(feature) % self.buckets
        return found


def features(words: list[bytes], grams: int) -> list[bytes]:
    """All runs of 1 to ``grams`` consecutive words, joined by one blank, repeats included."""
    out = list(words)
    for n in range(2, grams + 1):
        out += map(b" ".join, zip(*[words[i:] for i in range(n)]))
    return out


def bit_planes(numbers: np.ndarray) -> np.ndarray:
    """Numbers >= 0 (rows, columns) -> (planes, rows, 64-bit words): plane j has bit j of every number."""
    depth = int(numbers.max(initial=0)).bit_length()
    out = np.zeros((depth, len(numbers), -(-numbers.shape[1] // 64) * 8), np.uint8)
    for j in range(depth):
        bits = np.packbits((numbers >> j & 1).astype(np.uint8), axis=1)
        out[j, :, : bits.shape[1]] = bits
    return out.view(np.uint64)


def sliced_sums(counts: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Per row the sum of count x gain. counts: planes of the rows; up, down: planes of the gains above and below zero."""
    total = np.zeros(counts.shape[1], np.int64)
    for j, plane in enumerate(counts):
        for gains, sign in ((up, 1), (down, -1)):
            for k, gain in enumerate(gains):
                total += sign * (np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) << j + k)
    return total


def bucket_counts(texts: DataFrame, grams: int = 1, buckets: int = BUCKETS, column: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. One row per task and bucket is shuffled."""
    import pyarrow as pa

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in texts_of(batch.column(0)):
                held = features(words_of(raw), grams)
                total += np.bincount(np.fromiter(map(known.__getitem__, held), np.int64, len(held)), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select(F.col(f"`{column}`").cast("string")).mapInArrow(counted, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(own: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Gain of each bucket: floor(scale x ln of the ratio of smoothed shares), in doubles."""
    buckets, all_own, all_target = len(own), float(own.sum()), float(target.sum())
    ratios = ((t + 1.0) * (all_own + buckets) / ((s + 1.0) * (all_target + buckets)) for s, t in zip(own.tolist(), target.tolist()))
    return np.array([floor(scale * log(r)) for r in ratios], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, grams: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain of the features, 0 without any); one row per input row."""
    import pyarrow as pa

    buckets = len(gains)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(buckets)
        up, down = (bit_planes(np.maximum(side, 0)[None, :])[:, 0] for side in (gains, -gains))
        for batch in batches:
            texts = texts_of(batch.column("text"))
            words, sizes, sums = [], [], []
            for at in range(0, len(texts), ROWS):
                places = []
                for i, raw in enumerate(texts[at : at + ROWS]):
                    own = words_of(raw)
                    held = features(own, grams)
                    words.append(len(own))
                    sizes.append(len(held))
                    places.append(np.fromiter(map(known.__getitem__, held), np.int64, len(held)) + i * buckets)
                counts = np.bincount(np.concatenate(places), minlength=len(places) * buckets).reshape(len(places), buckets)
                sums.append(sliced_sums(bit_planes(counts), up, down))
            n = np.array(sizes, np.int64)
            weight = np.concatenate(sums) // np.maximum(n, 1) if sums else n
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    return documents(docs).mapInArrow(summed, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int, scale: int = SCALE) -> Column:
    """floor(-scale x ln(-ln u)), u from the first 32 bits of a hash of seed and doc_id; a null id counts as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((bits + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, grams: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10, seed: int = 2024, target_column: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (from 1 by falling score; null if not drawn), one row per input row.

    Drawn are floor(percent x N / 100) of the N rows with at least ``least_words`` words. Ties go to smaller doc_id, null
    last; rows that repeat an id then stand by n_features and weight. Null and empty texts have no features and weight 0.
    Empty documents give no rows; an empty target makes all words equally rare there.

    Ranks need no global sort. Scores are integers of a range that does not grow with the table (gains are logarithms of
    counts, the Gumbel number has 32 random bits), so the rows before each score come from a histogram, and only rows
    of one score are ordered among each other; as the Gumbel number does not look at texts, one score holds less than a
    thousandth of all rows, whatever the texts are.
    """
    spark = docs.sparkSession
    gains = gains_of(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets, target_column))
    rows = weighed(docs, gains, grams).withColumn("score", F.col("weight") + gumbel(seed))
    rows = written(rows, "scores")
    able = rows.where(F.col("n_words") >= least_words)
    by_score = written(able.groupBy("score").agg(F.count("*").alias("n")), "score-histogram")
    draws = (by_score.agg(F.sum("n")).first()[0] or 0) * percent // 100
    falling = Window.partitionBy(F.lit(0)).orderBy(F.col("score").desc())
    starts = by_score.withColumn("ahead", F.sum("n").over(falling) - F.col("n")).where(F.col("ahead") < draws).select("score", "ahead")
    lowest = starts.agg(F.min("score")).first()[0]
    no_rank = F.lit(None).cast("long").alias("rank")
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    if lowest is None:
        return rows.select(*columns, no_rank)
    among = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    place = F.col("ahead") + F.row_number().over(among)
    reached = able.join(starts, "score").select(*columns, F.when(place <= draws, place).alias("rank"))
    rest = rows.where((F.col("n_words") < least_words) | (F.col("score") < F.lit(lowest)))
    return reached.unionByName(rest.select(*columns, no_rank))


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose doc_id ``resample`` draws. Rows that repeat a drawn id all stay."""
    found = resample(docs, target, **settings).where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(found, F.col("`doc_id`").cast("long").eqNullSafe(F.col("_drawn")), "left_semi")


def resample_sql() -> str:
    """The query in SQL, with the checksum of a word worked out byte by byte."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
f AS (SELECT doc_id, unnest(w) AS w FROM d),
m AS (SELECT unnest({words}) AS w FROM benchmark),
v AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM f UNION SELECT w FROM m)),
z AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n)) AS z),
b AS (SELECT w, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
             lambda c, x: xor(c // 256, z[1 + xor(c % 256, x)]), 4294967295), 4294967295) % 10000 AS bucket FROM v, z),
s AS (SELECT bucket, count(*) AS s FROM f JOIN b ON f.w = b.w GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM m JOIN b ON m.w = b.w GROUP BY bucket),
g AS (SELECT s.bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM s) + 10000 AS DOUBLE)
             / (CAST(s + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(t), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
      FROM s LEFT JOIN t ON s.bucket = t.bucket),
x AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS total FROM f JOIN b ON f.w = b.w JOIN g ON b.bucket = g.bucket GROUP BY doc_id),
y AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n, coalesce(total, 0) AS total, CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN x ON d.doc_id = x.doc_id),
k AS (SELECT doc_id, n, CASE WHEN n = 0 THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight, h FROM y),
r AS (SELECT doc_id, n AS n_features, CAST(weight AS BIGINT) AS weight, CAST(weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS BIGINT) AS score FROM k),
o AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
             10 * (SELECT count(*) FROM r WHERE n_features >= 20) // 100 AS draws FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= draws THEN CAST(place AS BIGINT) END AS rank FROM o"""
