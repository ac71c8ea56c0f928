"""Quality classifier with supervised subword embeddings.

A text is the mean of learned vectors of its words, of their character n-grams, and of one mark for each word that
repeats the word before it, all hashed into one table; a softmax over two classes follows. Training is stochastic gradient descent in numpy over a bounded sample of labelled
documents. The model is linear in the mean, so scoring needs one number per distinct word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, texts_of

#: Words whose numbers a worker remembers; when full, it starts afresh. A matter of speed alone.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Settings:
    """docs_per_class: the fit takes at most so many labelled documents of a class, whole texts of each. What reaches the
    driver of a document is one number per bucket it touches. Scoring covers whole texts of all documents."""

    docs_per_class: int = 1200
    buckets: int = 1 << 16
    dim: int = 16
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 4
    rate: float = 0.3
    seed: int = 7


DEFAULT = Settings()


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of a bucket: its vector's share in the logit of class 1
    bias: float
    settings: Settings


def features(word: bytes, settings: Settings) -> list[int]:
    """Buckets of a word: itself and its n-grams between word marks."""
    from zlib import crc32

    marked = b"<" + word + b">"
    size = settings.buckets
    out = [crc32(marked) % size]
    for n in settings.grams:
        out += [crc32(marked[i : i + n], n) % size for i in range(len(marked) - n + 1)]
    return out


def repeat_mark(settings: Settings) -> int:
    """Bucket of the mark; no word has this form."""
    from zlib import crc32

    return crc32(b"< >") % settings.buckets


def bag(raw: bytes | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, times) of a whole text: of its words' features and of the marks of words that repeat the one before."""
    words = raw.split() if raw else []
    times: Counter[int] = Counter()
    for word, n in Counter(words).items():
        for bucket in features(word, settings):
            times[bucket] += n
    repeats = sum(map(eq, words, words[1:]))
    if repeats:
        times[repeat_mark(settings)] += repeats
    buckets = sorted(times)
    return np.array(buckets, np.int32), np.array([times[b] for b in buckets], np.int64)


Example = tuple[np.ndarray, np.ndarray, int]


def sample(docs: DataFrame, labels: DataFrame, settings: Settings = DEFAULT) -> list[Example]:
    """(buckets, times, class) of the documents of the fit, the smallest hashes of ids first; the same on every run.

    Labels other than 0 and 1 and labels without id are passed over; an id with both is an example of each class. A
    null text is an empty one. Rows that repeat count once. Texts are counted in tasks.
    """
    import pyarrow as pa

    marks = labels.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`quality`").cast("int").alias("quality")).where("quality IN (0, 1) AND doc_id IS NOT NULL").distinct()
    zeros, ones = (marks.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.docs_per_class) for c in (0, 1))
    chosen = zeros.unionByName(ones)
    rows = documents(docs).where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = rows.join(F.broadcast(chosen), "doc_id").distinct()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [bag(t, settings) for t in texts_of(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("place"), batch.column("quality")]
            columns += [pa.array([b[i] for b in bags], pa.list_(kind)) for i, kind in ((0, pa.int32()), (1, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "quality", "buckets", "times"])

    placed = held.select("doc_id", F.xxhash64("text").alias("place"), "quality", "text")
    found = placed.mapInArrow(counted, "doc_id long, place long, quality int, buckets array<int>, times array<long>")
    table = found.orderBy(F.xxhash64("doc_id"), "doc_id", "place", "quality").toArrow()
    lists = (([x.as_py() for x in table.column("quality")]), *[[x.values.to_numpy() for x in table.column(c)] for c in ("buckets", "times")])
    return [(buckets, times, quality) for quality, buckets, times in zip(*lists)]


def train(examples: list[Example], settings: Settings = DEFAULT) -> Model:
    """Gradient descent, one document at a time, with a falling rate; classes weigh the same.

    Without examples of both classes every score is the share of class 1 among the examples, or one half.
    """
    classes = np.array([c for *_, c in examples], np.int64)
    ones = int(classes.sum())
    if ones in (0, len(examples)):
        return Model(np.zeros(settings.buckets), 0.0 if not examples else (9.0 if ones else -9.0), settings)
    bags = [(ids, (times / max(1, times.sum())).astype(np.float32)) for ids, times, _ in examples]
    rng = np.random.default_rng(settings.seed)
    table = rng.uniform(-1 / settings.dim, 1 / settings.dim, (settings.buckets, settings.dim)).astype(np.float32)
    out = np.zeros((settings.dim, 2), np.float32)
    shift = np.zeros(2, np.float32)
    weight = np.array([0.5 / (1 - ones / len(examples)), 0.5 / (ones / len(examples))], np.float32)
    steps, done = settings.epochs * len(bags), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(bags)):
            rate = settings.rate * (1 - done / steps)
            done += 1
            ids, share = bags[i]
            hidden = share @ table[ids]
            logits = hidden @ out + shift
            odds = np.exp(logits - logits.max())
            error = -odds / odds.sum()
            error[classes[i]] += 1
            error *= rate * float(weight[classes[i]])
            back = out @ error
            out += np.outer(hidden, error)
            shift += 0.1 * error
            # Steps in proportion to shares, scaled so that the mean itself moves by ``back``.
            if len(ids):
                table[ids] += (share / (share @ share))[:, None] * back
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float64), float(shift[1] - shift[0]), settings)


class _Known(dict):
    """Of a word: the sum of its features' weights, and as imaginary part their number."""

    def __init__(self, model: Model):
        self.weights, self.settings = model.weights.tolist(), model.settings
        self.mark = complex(self.weights[repeat_mark(model.settings)], 1)

    def __missing__(self, word: bytes) -> complex:
        ids = features(word, self.settings)
        value = self[word] = complex(sum(map(self.weights.__getitem__, ids)), len(ids))
        return value


def score_text(raw: bytes | None, known: _Known, bias: float) -> float:
    words = raw.split() if raw else []
    if len(known) > REMEMBERED:
        known.clear()
    total = sum(map(known.__getitem__, words), 0j) + known.mark * sum(map(eq, words, words[1:]))
    logit = bias + (total.real / total.imag if words else 0.0)
    return 1 / (1 + exp(-max(-40.0, min(40.0, logit))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, higher: class 1 likelier), predicted (1 if score >= 0.5), one row per input row.

    A null or empty text has the score of the model's bias alone. Repeated rows score alike; an empty table gives
    no rows.
    """
    import pyarrow as pa

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model)
        for batch in batches:
            found = np.array([score_text(t, known, model.bias) for t in texts_of(batch.column("text"))], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return documents(docs).mapInArrow(scored, "doc_id long, score double, predicted int")
