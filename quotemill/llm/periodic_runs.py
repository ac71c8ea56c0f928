"""Periodic runs of words by seeding and extending diagonals.

A run of period q and at least max(LEAST, 2 q) words repeats itself at lag q over at least max(LEAST - q, q) words, hence
over GRAM = LEAST / 2 words whatever q is. So every run shows as two occurrences of one k-gram of GRAM words in the
same document, q apart. The k-grams of a document are indexed; occurrence pairs are seeds, taken by classes of lags
[k, 2k). A run of such a lag overlaps itself over k words or more, so pairs whose first member stands at every
(k - GRAM + 1)-th place are enough, which bounds a class at a few pairs per word however often a k-gram repeats. A seed
is extended along its diagonal to the whole stretch that agrees at that lag; a table of the furthest word covered at
each document's lag passes over seeds inside a stretch already found. Of stretches with one extent the smallest
lag is the run's period; the others are its multiples.

Extension takes hashes of 1, 2, 4, ... words and so a logarithmic number of steps; all seeds of a class advance together.
Found runs are compared word by word at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, crc32, documents, ranges, texts_of

LEAST = 12
#: Words worked on at once in one worker; a longer document stands alone. Needs about 8 bytes x log2(longest document) a word.
WORDS = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def power_hashes(ids: np.ndarray, longest: int, seed: int) -> list[np.ndarray]:
    """Hashes of the 1, 2, 4, ... words from each position, up to the last power within ``longest``."""
    out = [_mixed(ids.astype(np.uint64) * _ODD + np.uint64(seed))]
    while 2 << len(out) - 1 <= longest:
        last, width = out[-1], 1 << len(out) - 1
        out.append(_mixed(last[:-width] * _ODD + last[width:]) if len(last) > width else last[:0])
    return out


def gram_hashes(powers: list[np.ndarray], gram: int) -> np.ndarray:
    """Hash of the ``gram`` words from each position."""
    out, have = None, 0
    for level in reversed(range(gram.bit_length())):
        if gram >> level & 1:
            part = powers[level][have:]
            out = part if out is None else _mixed(out[: len(part)] * _ODD + part)
            have += 1 << level
    return out


def _agreeing(powers: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many words agree from positions a and b on, or in front of them."""
    done = np.zeros(len(a), np.int64)
    for level in reversed(range(len(powers))):
        own, width = powers[level], 1 << level
        if not len(own):
            continue
        x, y = (a - done - width, b - done - width) if back else (a + done, b + done)
        fits = (x >= 0) if back else (y < len(own))
        same = fits.copy()
        same[fits] = own[x[fits]] == own[y[fits]]
        done += same * width
    return done


def _class_pairs(where: np.ndarray, group: np.ndarray, low: int, high: int, step: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, lag) of occurrence pairs with a lag in [low, high) whose first member stands at a multiple of ``step``.

    where, group: positions of the index by group, ascending inside it.
    """
    names = group * (end + 1) + where
    chosen = np.flatnonzero(where % step == 0)
    first = where[chosen]
    base = group[chosen] * (end + 1)
    a = np.searchsorted(names, base + np.minimum(first + low, end))
    b = np.searchsorted(names, base + np.minimum(first + high, end))
    first = np.repeat(first, b - a)
    return first, where[ranges(a, b - a)] - first


def find_runs(ids: np.ndarray, doc: np.ndarray, longest: int, least: int = LEAST, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, words, period) of the runs of several documents, by first position and period.

    ids: word numbers of all documents, one after the other, each followed by a number that occurs nowhere else. doc: the
    document of each position. longest: words of the longest document.
    """
    none = np.empty(0, np.int64)
    gram = (least + 1) // 2
    if longest < least:
        return none, none, none
    powers = power_hashes(ids, max(longest, gram), seed)
    grams = gram_hashes(powers, gram)
    # A gram's key names its document too, so that occurrences in one index group share both.
    keys = _mixed(grams * _ODD + doc[: len(grams)].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    where = order[several].astype(np.int64)
    if not len(where):
        return none, none, none
    group = np.cumsum(np.concatenate([[True], ~same]))[several].astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    low, high, step = 1, 2 * gram, 1
    while low <= longest // 2:
        first, lag = _class_pairs(where, group, low, high, step, len(ids))
        order = np.lexsort((first, lag))
        first, lag = first[order], lag[order]
        own = doc[first]
        line = np.cumsum(np.concatenate([[0], (lag[1:] != lag[:-1]) | (own[1:] != own[:-1])])) if len(first) else none
        furthest = np.full(line[-1] + 1 if len(line) else 0, -1, np.int64)
        while len(first):
            head = np.concatenate([[True], line[1:] != line[:-1]])
            a, q = first[head], lag[head]
            begin = a - _agreeing(powers, a, a + q, back=True)
            end = a + _agreeing(powers, a, a + q, back=False)
            furthest[line[head]] = np.maximum(end, a + 1)
            long = end - begin >= np.maximum(least - q, q)
            found.append((begin[long], (end + q)[long], q[long]))
            left = first >= furthest[line]
            first, lag, line = first[left], lag[left], line[left]
        low, high, step = high, 2 * high, high - gram + 1
    begin, end, lag = (np.concatenate([f[i] for f in found]) for i in range(3)) if found else (none, none, none)
    order = np.lexsort((lag, end, begin))
    begin, end, lag = begin[order], end[order], lag[order]
    smallest = np.ones(len(begin), bool)
    smallest[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, lag = begin[smallest], end[smallest], lag[smallest]
    for b, e, q in zip(begin.tolist(), end.tolist(), lag.tolist()):
        if not np.array_equal(ids[b : e - q], ids[b + q : e]):  # two hashes met by chance
            return find_runs(ids, doc, longest, least, seed + 1)
    order = np.lexsort((lag, begin))
    return begin[order], (end - begin)[order], lag[order]


def _several(texts: list[bytes | None], least: int) -> tuple[list[list[tuple[int, int, int]]], list[str]]:
    """Of each text its runs (first word, words, period) and the text without what they repeat."""
    words = [t.split() if t else [] for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    known: dict[bytes, int] = {}
    flat: list[int] = []
    for i, own in enumerate(words):
        flat += [known.setdefault(w, len(known)) for w in own]
        flat.append(-1 - i)
    ids = np.array(flat, np.int64)
    del flat
    bases = np.cumsum(sizes + 1) - sizes - 1
    doc = np.repeat(np.arange(len(words)), sizes + 1)
    begin, length, period = find_runs(ids, doc, int(sizes.max(initial=0)), least)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, begin + period, 1)
    np.add.at(edges, begin + length, -1)
    kept = np.cumsum(edges)[:-1] == 0
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for d, b, n, q in zip(doc[begin].tolist(), (begin - bases[doc[begin]]).tolist(), length.tolist(), period.tolist()):
        runs[d].append((b, n, q))
    out = []
    for i, own in enumerate(words):
        if runs[i]:
            own = [own[j] for j in np.flatnonzero(kept[bases[i] : bases[i] + sizes[i]])]
        out.append(b" ".join(own).decode())
    return runs, out


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period; words count from 0), collapsed (the words
    that no run repeats, joined by one blank), one row per input row.

    A run is a stretch of words with smallest period q and at least max(least, 2 q) words that no neighbouring word extends
    keeping the period; what it repeats is all of it but its first q words. Null and empty texts have no runs and an empty
    collapsed text. Rows that repeat give equal results; an empty table gives no rows.
    """
    import pyarrow as pa

    if least < 2:
        raise ValueError("a run has at least two words")
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            begin, held = 0, 0
            for i, raw in enumerate(texts):
                held += len(raw or b"") // 4
                if held >= WORDS or i == len(texts) - 1:
                    own = texts[begin : i + 1]
                    runs, collapsed = _several(own, least)
                    columns = [
                        batch.column("doc_id")[begin : i + 1],
                        pa.array([len(t.split()) if t else 0 for t in own], pa.int64()),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], kind),
                        pa.array(collapsed, pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])
                    begin, held = i + 1, 0

    return documents(docs).mapInArrow(told, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: texts of which one in ten, by the checksum of the id, goes on periodically from some word on.

    With h the checksum of the id, g = h // 10 and n words, where h % 10 = 0 each word i from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). Rows without id or words stay as they are.
    """
    rows = documents(docs).withColumn("h", crc32("doc_id"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    a = F.when(F.col("n") > 0, F.col("g") % F.col("n"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    told = rows.withColumn("words", words).withColumn("n", n).withColumn("g", g).withColumn("a", a).withColumn("p", p)

    def moved(i: Column) -> Column:
        return F.element_at("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int") + 1)

    again = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), moved), " ")
    return told.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the longest run, and hashes of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("slow"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    best = found.select("*", longest.alias("best"))
    length, period = F.col("best.length"), -F.col("best.slow")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.slow").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
