"""Exact deduplication of passages of words with FM-indexes.

What is removed: every word covered by a window of WINDOW consecutive words whose sequence also starts in a document
with a smaller doc_id.

How windows are dealt out. Each window has an anchor: of its runs of GRAM words the one with the smallest hash, leftmost
first. It depends on the window alone, so equal windows have equal anchors. Neighbouring windows with one anchor are a
context. Anchors of all documents are counted first; only contexts whose anchor occurs in several documents travel, to
the shard that the anchor's hash names, and equal contexts travel once per task with their smallest and largest document.

What happens there. A shard's contexts are indexed: Burrows-Wheeler transform and wavelet tree over their words. Every
context is then streamed backward through the index, which gives for each of its windows the interval of all its
occurrences and the smallest document among them; windows that a larger document holds too are reported as intervals
of the context. A join hands these to the places where the context occurs, and texts are cut where they lie.

Skew. A passage held by very many documents is one context per task. An anchor with more than OFTEN occurrences, which
may stand in many different contexts, sends its windows one by one, each to the shard its own words name; so what a
shard gathers for one anchor does not grow with the table. Joins on anchors and contexts spread heavy keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import documents, ranges, release, shuffle_partitions, slices, texts_of, written
from .fm_index import shared_windows

WINDOW = 13
GRAM = 5
#: Occurrences beyond which an anchor's windows are dealt one by one. Moves work only; no result depends on it.
OFTEN = 4096
#: Contexts of a shard, words of one index, contexts a task holds before it sends them, words whose hashes a worker remembers.
CONTEXTS = 1 << 16
INDEXED = 1 << 20
HELD = 1 << 16
REMEMBERED = 300_000

_NO_ID = (1 << 63) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Hashes(dict):
    """Hash of a word."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxh3_64_intdigest(word)
        return found


def anchors(hashes: np.ndarray, sizes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor) of the contexts of several texts, whose word hashes lie one after the other."""
    none = np.empty(0, np.int64)
    whole = sizes >= window
    if not whole.any():
        return none, none, none, none.astype(np.uint64)
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for i in range(gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(grams)]
    grams = _mixed(grams)
    # The smallest of the grams of each window, by doubling; of equal ones the leftmost, as places are compared next.
    spread = window - gram + 1
    best, at, width = grams, np.arange(len(grams)), 1
    while width < spread:
        shift = min(width, spread - width)
        left, right = best[:-shift], best[shift:]
        at = np.where(left <= right, at[:-shift], at[shift:])
        best = np.minimum(left, right)
        width += shift
    bases = np.cumsum(sizes) - sizes
    starts = ranges(bases[whole], sizes[whole] - window + 1)
    text = np.repeat(np.flatnonzero(whole), sizes[whole] - window + 1)
    place = at[starts]
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.append(head, len(starts)))
    return text[head], starts[head] - bases[text[head]], count, best[starts[head]]


def _keys(docs: DataFrame) -> DataFrame:
    """doc, tie, text. ``doc`` orders documents, null last; ``tie`` tells texts of one id apart."""
    text = F.coalesce("text", F.lit(""))
    return documents(docs).select(F.coalesce("doc_id", F.lit(_NO_ID).cast("long")).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"))


def _packed(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpacked(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(raw)


def _shards(held: dict[bytes, list[int]], shards: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(shard, numbers, contexts) of distinct contexts with [smallest document, largest document, key]."""
    names = list(held)
    numbers = np.array(list(held.values()), np.int64).reshape(-1, 3)
    shard = (numbers[:, 2].view(np.uint64) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], shard[order][1:] != shard[order][:-1]]))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
        own = order[a:b]
        # Contexts hold no line feed, as words hold no blanks.
        yield int(shard[own[0]]), _packed(numbers[own].tobytes()), _packed(b"\n".join([names[i] for i in own]))


def _digests(contexts: list[bytes]) -> np.ndarray:
    """128 bits that name a context, as two longs."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, contexts)), "<i8").reshape(-1, 2)


def lost_spans(contexts: list[bytes], low: np.ndarray, high: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(context, first word, end, smallest document) of the stretches of distinct contexts that later documents lose."""
    tokens = b" \n ".join([*contexts, b""]).split(b" ")[:-1]
    known: dict[bytes, int] = {b"\n": 0}
    text = np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int64, len(tokens))
    ends = np.flatnonzero(text == 0)
    begin = np.concatenate([[0], ends[:-1] + 1])
    context, first, least = shared_windows(text, len(known), begin, ends - begin, low, window)
    later = high[context] > least
    context, first, least = context[later], first[later], least[later]
    order = np.lexsort((first, context))
    context, first, least = context[order], first[order], least[order]
    if not len(context):
        return context, first, first, least
    # Neighbouring windows with one smallest document are one stretch.
    head = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (first[1:] != first[:-1] + 1) | (least[1:] != least[:-1])]))
    last = np.append(head[1:], len(context)) - 1
    return context[head], first[head], first[last] + window, least[head]


def _lost(packs: Iterator[tuple[bytes, bytes]], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(digest's halves, first word, end, smallest document) of what a shard's contexts lose, index by index."""
    merged: dict[bytes, list[int]] = {}
    for numbers, raw in packs:
        for name, (a, b, key) in zip(_unpacked(raw).split(b"\n"), np.frombuffer(_unpacked(numbers), np.int64).reshape(-1, 3).tolist()):
            old = merged.get(name)
            if old is None:
                merged[name] = [a, b, key]
            else:
                old[0], old[1] = min(old[0], a), max(old[1], b)
    names = sorted(merged, key=lambda n: (merged[n][2], n))
    numbers = np.array([merged[n] for n in names], np.int64).reshape(-1, 3)
    del merged
    # Contexts of one key stand in one index.
    head = np.flatnonzero(np.concatenate([[True], numbers[1:, 2] != numbers[:-1, 2]])) if len(names) else []
    tail = [*head[1:], len(names)]
    words = [sum(n.count(b" ") + 2 for n in names[a:b]) for a, b in zip(head, tail)]
    for i, j in slices(head, words, INDEXED):
        a, b = head[i], tail[j - 1]
        own = names[a:b]
        context, first, end, least = lost_spans(own, numbers[a:b, 0], numbers[a:b, 1], window)
        used, back = np.unique(context, return_inverse=True)
        digest = _digests([own[u] for u in used.tolist()])[back]
        yield digest[:, 0], digest[:, 1], first, end, least


def _cut(words: list[bytes], spans: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]], bytes]:
    """Words removed, maximal removed runs [first, end), and the text that is left."""
    runs: list[list[int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    kept, at = [], 0
    for a, b in runs:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words) - len(kept), [(a, b) for a, b in runs], b" ".join(kept)


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed runs of words: first, end), kept (the words left, joined by one blank) and
    kept_sha256, one row per input row.

    Null and empty texts have no words; documents of fewer than ``window`` words lose nothing. Rows that share a doc_id
    take nothing from each other, and those that agree in id and text get equal results. A row without doc_id counts as
    later than all with one. An empty table gives no rows.
    """
    import pandas as pd
    import pyarrow as pa

    if not 1 <= gram <= window < gram + 250:
        raise ValueError("an anchor has at least one word, and a window fewer than 250 more")
    spark = docs.sparkSession
    keyed = _keys(docs)

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            words = [t.split() for t in texts_of(batch.column("text"))]
            sizes = np.array([len(w) for w in words], np.int64)
            flat = np.fromiter((known[w] for own in words for w in own), np.uint64, int(sizes.sum()))
            text, first, count, anchor = anchors(flat, sizes, window, gram)
            doc, tie = (batch.column(c).to_numpy()[text] for c in ("doc", "tie"))
            columns = [pa.array(x) for x in (doc, tie, first << 8 | count, anchor.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "tie", "place", "anchor"])
        release()

    places = written(keyed.mapInArrow(anchored, "doc long, tie long, place long, anchor long"), "anchors")
    counted = places.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"))
    several = written(counted.where("low < high").select("anchor", (F.col("n") > OFTEN).alias("hot")), "shared-anchors")
    flags = lookup_join(places, several, ["anchor"]).groupBy("doc", "tie").agg(F.collect_set(F.struct("place", "anchor", "hot")).alias("flag"))
    flags = written(flags.select("doc", "tie", *[F.col(f"flag.{c}").alias(f"{c}s") for c in ("place", "anchor", "hot")]), "flags")
    shards = max(2 * shuffle_partitions(spark), -(-(flags.agg(F.sum(F.size("places"))).first()[0] or 0) // CONTEXTS))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of two kinds: packed contexts with the shard they go to, and places of contexts."""
        from xxhash import xxh3_64_intdigest

        names = ["shard", "numbers", "contexts", "d1", "d2", "doc", "tie", "first"]
        kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 5]

        def rows(columns: dict, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names=names)

        def flush() -> pa.RecordBatch:
            found = list(zip(*_shards(held, shards)))
            return rows(dict(zip(names, found)), len(found[0]))

        held: dict[bytes, list[int]] = {}
        for batch in batches:
            met: list[bytes] = []
            where: list[tuple[int, int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("doc", "tie", "places", "anchors", "hots")]
            for raw, doc, tie, *flagged in zip(texts_of(batch.column("text")), *columns):
                words = raw.split()
                for place, anchor, hot in zip(*flagged):
                    first, count = place >> 8, place & 255
                    for a, n in [(first + i, 1) for i in range(count)] if hot else ((first, count),):
                        context = b" ".join(words[a : a + n + window - 1])
                        old = held.get(context)
                        if old is None:
                            key = xxh3_64_intdigest(context) - (1 << 63) if hot else anchor
                            held[context] = [doc, doc, key]
                        elif doc < old[0]:
                            old[0] = doc
                        elif doc > old[1]:
                            old[1] = doc
                        met.append(context)
                        where.append((doc, tie, a))
            if met:
                digest, place = _digests(met), np.array(where, np.int64)
                yield rows({"d1": digest[:, 0], "d2": digest[:, 1], "doc": place[:, 0], "tie": place[:, 1], "first": place[:, 2]}, len(met))
            if len(held) >= HELD:
                yield flush()
                held.clear()
        if held:
            yield flush()
            held.clear()
        release()

    def lost(group: pd.DataFrame) -> pd.DataFrame:
        names = ("d1", "d2", "a", "b", "least")
        found = list(_lost(zip(group["numbers"], group["contexts"]), window))
        return pd.DataFrame({n: np.concatenate([np.empty(0, np.int64), *[f[i] for f in found]]) for i, n in enumerate(names)})

    kinds = "shard int, numbers binary, contexts binary, d1 long, d2 long, doc long, tie long, first long"
    sent = written(keyed.join(flags, ["doc", "tie"]).mapInArrow(contexts, kinds), "contexts")
    packed = sent.where("shard IS NOT NULL").select("shard", "numbers", "contexts")
    losses = written(packed.groupBy("shard").applyInPandas(lost, "d1 long, d2 long, a long, b long, least long"), "losses")
    met = sent.where("shard IS NULL").select("d1", "d2", "doc", "tie", "first")
    hit = lookup_join(met, losses, ["d1", "d2"]).where("doc > least")
    span = F.struct((F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("b")).alias("end"))
    covers = written(hit.groupBy("doc", "tie").agg(F.collect_set(span).alias("covers")), "covers")
    spans = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for raw, covered in zip(texts_of(batch.column("text")), batch.column("covers").to_pylist()):
                words = raw.split()
                removed, runs, kept = _cut(words, [(c["first"], c["end"]) for c in covered or ()])
                for column, value in zip(out, (len(words), removed, [{"first": a, "end": b} for a, b in runs], kept.decode(), hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), spans, pa.string(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], names=["doc", "n_words", "n_removed", "spans", "kept", "kept_sha256"])

    done = keyed.join(covers, ["doc", "tie"], "left").mapInArrow(
        cut, "doc long, n_words long, n_removed long, spans array<struct<first:long,end:long>>, kept string, kept_sha256 string"
    )
    return done.select(F.nullif("doc", F.lit(_NO_ID).cast("long")).alias("doc_id"), "n_words", "n_removed", "spans", "kept", "kept_sha256")


def removals_sql() -> str:
    """The query in SQL: the smallest document of every window, joined by words."""
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS earliest FROM g) WHERE earliest < doc_id),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM f, (SELECT unnest(range({WINDOW})) AS k)),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT u.doc_id, count(c.i) AS n_removed, string_agg(CASE WHEN c.i IS NULL THEN word END, ' ' ORDER BY u.i) AS kept
      FROM u LEFT JOIN c ON u.doc_id = c.doc_id AND u.i = c.i GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""
