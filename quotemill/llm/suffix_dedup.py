"""Exact substring deduplication with enhanced suffix arrays.

What is removed: every byte covered by a string of LENGTH bytes that also starts in a document with a smaller doc_id.

How suffixes are dealt out. Each window of LENGTH bytes has an anchor: of its strings of GRAM bytes the one with the
smallest hash, leftmost first. The anchor depends on the window alone, so equal windows have equal anchors, and
suffixes that agree in LENGTH bytes meet where their anchor's hash sends them. Windows next to each other share
anchors; such a run is one context (LENGTH - GRAM + 1 windows at most). Contexts travel only if their anchor occurs
in another document, and equal contexts travel once per task.

What happens there. The suffixes of all contexts of an anchor are sorted with their common-prefix lengths. A stack
scan walks the tree of common-prefix intervals and reports every interval of LENGTH bytes or more whose occurrences
are preceded by different bytes: the maximal repeat groups, with all their occurrences and the smallest document.
Equal contexts travel as one with their smallest and largest document; in the tree its suffixes are leaves of several
occurrences. Groups are maximal within contexts. Occurrences in later documents are removed. Windows partition over
anchors, so the union over all places is exact.

Skew. Exact copies of whole documents are settled by their SHA-256 beforehand, in a join that spreads texts of many
copies. A task sends one entry for an anchor that several of its documents share. Anchors in more than HOT_SHARE of the
documents are too many contexts for one place; their windows are dealt one by one by their own bytes. There are at most
(anchors per document) / HOT_SHARE of them, whatever the input's size, and being on that list changes where work is
done, never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import documents, ranges, release, shuffle_partitions, slices, spare, texts_of, written

LENGTH = 50
GRAM = 20
HOT_SHARE = 0.005
HOT_LEAST = 512
#: Text bytes of one hashing step, of one flush of a task, and of one group of anchors; suffixes sorted at once.
STEP = 1 << 19
FLUSH = 1 << 23
GROUP = 1 << 26
SUFFIXES = 1 << 15

_NO_ID = (1 << 63) - 1
_DIVERSE = -1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = _mixed(np.arange(1001, 1033, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position, by doubling; len(data) - gram + 1 of them."""
    power, width, done = _BYTE[data], 1, None
    have, left = 0, gram
    while True:
        if left & 1:
            if done is None:
                done, have = power, width
            else:
                n = len(data) - have - width + 1
                done = done[:n] * _STEP[16 + width.bit_length()] + power[have : have + n]
                have += width
        left >>= 1
        if not left:
            return _mixed(done)
        power = power[:-width] * _STEP[width.bit_length()] + power[width:]
        width *= 2


def anchor_runs(parts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (part, first window, windows, anchor's offset from there, hash)."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    bases = np.cumsum(sizes) - sizes
    hashes = gram_hashes(data, gram)
    low = np.uint64((1 << 21) - 1)
    best = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    spread, width = length - gram + 1, 1
    while width * 2 <= spread:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < spread:
        best = np.minimum(best[: len(best) - (spread - width)], best[spread - width :])
    at = (best & low).astype(np.int64)
    valid = np.zeros(len(at), bool)
    whole = sizes >= length
    valid[ranges(bases[whole], sizes[whole] - length + 1)] = True
    start = valid.copy()
    start[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    first = np.flatnonzero(start)
    ordinal = np.cumsum(start) - 1
    count = np.bincount(ordinal[valid], minlength=len(first))
    part = np.searchsorted(bases, first, side="right") - 1
    # Empty parts share a base with the next; the last of them is the one that holds the window.
    return part, first - bases[part], count, at[first] - first, hashes[at[first]]


def cut(raw: bytes, length: int, step: int = STEP) -> Iterator[tuple[int, bytes]]:
    """A text in pieces of at most ``step`` bytes that overlap so that each window lies in one of them."""
    for at in range(0, max(1, len(raw) - length + 1), step - length + 1):
        yield at, raw[at : at + step]


def _packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpacked(raw: bytes, *kinds: str) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(raw)
    n = len(data) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(data[at : at + size], kind))
        at += size
    return out


_ENTRY = ("<u4", "<u1", "<i8", "<i8")  # low 40 bits of the hash in two parts, change of doc, place; the bucket tells the rest
_WINDOW = 255  # in place of an anchor's offset: a lone window
_CONTEXT = ("<u1", "<u2", "<i8", "<i8")  # anchor's offset, bytes, smallest document, distance to the largest
_HOT = -1  # in place of a document: the row names a frequent anchor


def _place(first: np.ndarray, count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << 16 | count.astype(np.int64) << 8 | offset.astype(np.int64)


def anchor_rows(texts: list[bytes], ids: np.ndarray, buckets: int, length: int, gram: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, entries to compare, entries already known to be shared) of some documents."""
    pieces = [(i, at, piece) for i, raw in enumerate(texts) if len(raw) >= length for at, piece in cut(raw, length)]
    found = []
    for a, b in slices(pieces, [len(p[2]) for p in pieces], STEP):
        part, first, count, offset, hashes = anchor_runs([p[2] for p in pieces[a:b]], length, gram)
        doc = np.array([p[0] for p in pieces[a:b]], np.int64)[part]
        first = first + np.array([p[1] for p in pieces[a:b]], np.int64)[part]
        found.append((hashes, ids[doc], _place(first, count, offset)))
    if not found:
        return
    hashes, doc, place = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((doc, hashes))
    hashes, doc, place = hashes[order], doc[order], place[order]
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    size = np.diff(np.append(begin, len(hashes)))
    change = np.concatenate([[1], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])
    holders = np.add.reduceat(change, begin)
    several = np.repeat(holders > 1, size)
    leads = np.zeros(len(hashes), bool)
    leads[begin] = True
    # An anchor that several documents share here goes on once, with their number instead of a place.
    send = ~several | leads
    sent = np.where(several, -np.repeat(holders, size), place)
    bucket = (hashes >> np.uint64(40)).astype(np.int64) % buckets
    own_bucket = _mixed(doc.astype(np.uint64)).view(np.int64) % buckets
    rows: dict[int, list[bytes]] = {}
    for slot, chosen, to, where in ((0, send, bucket, sent), (1, several, own_bucket, place)):
        at = np.flatnonzero(chosen)
        at = at[np.lexsort((doc[at], to[at]))]
        edges = np.flatnonzero(np.concatenate([[True], to[at][1:] != to[at][:-1]])) if len(at) else []
        for a, b in zip(edges, [*edges[1:], len(at)]):
            own = at[a:b]
            high = (hashes[own] >> np.uint64(32)).astype(np.uint8)
            rows.setdefault(int(to[own[0]]), [b"", b""])[slot] = _packed(hashes[own].astype(np.uint32), high, np.diff(doc[own], prepend=np.int64(0)), where[own])
    for bucket, (entries, known) in rows.items():
        yield bucket, entries, known


def shared_entries(entries: Iterable[bytes], known: Iterable[bytes], often: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place) of the entries whose anchor occurs in several documents, and the low hashes of anchors in more than
    ``often`` of them."""
    read = [(h | g.astype(np.uint64) << np.uint64(32), np.cumsum(d), p) for h, g, d, p in (_unpacked(x, *_ENTRY) for x in entries if x)]
    out = [(np.cumsum(d), p) for _, _, d, p in (_unpacked(x, *_ENTRY) for x in known if x)]
    hot = np.empty(0, np.uint64)
    if read:
        h, d, p = (np.concatenate([r[i] for r in read]) for i in range(3))
        order = np.lexsort((d, h))
        h, d, p = h[order], d[order], p[order]
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.append(begin, len(h)))
        shared = d[begin] != d[begin + size - 1]
        keep = np.repeat(shared, size) & (p >= 0)
        out.append((d[keep], p[keep]))
        first = np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])
        holders = np.add.reduceat(np.where(p < 0, -p, first), begin)
        hot = h[begin[holders > often]]
    empty = np.empty(0, np.int64)
    docs, places = (np.concatenate([empty, *[o[i] for o in out]]) for i in range(2))
    return docs, places, hot


def contexts_of(raw: bytes, places: list[int], hot: frozenset[tuple[int, int]], buckets: int, length: int, gram: int) -> Iterator[tuple[int, int, bytes]]:
    """(anchor's offset or _WINDOW, first byte, context) of the flagged anchors of a text. Places beyond the text are those of another
    row with the same id and are passed over."""
    hashes = gram_hashes(np.frombuffer(raw, np.uint8), gram) if hot and len(raw) >= gram else None
    for place in places:
        first, count = place >> 16, place >> 8 & 255
        if first + count + length - 1 > len(raw):
            continue
        at = first + (place & 255)
        if hashes is not None and _name(int(hashes[at]), buckets) in hot:
            for at in range(first, first + count):
                yield _WINDOW, at, raw[at : at + length]
        else:
            yield place & 255, first, raw[first : first + count + length - 1]


def key_of(offset: int, context: bytes, gram: int) -> int:
    """Where a context goes: by its anchor, or a lone window of a frequent anchor by itself."""
    from xxhash import xxh64_intdigest

    if offset == _WINDOW:
        return xxh64_intdigest(context, 1)
    return xxh64_intdigest(context[offset : offset + gram])


def _name(anchor: int, buckets: int) -> tuple[int, int]:
    """An anchor as entries name it: bucket and low bits."""
    return (anchor >> 40) % buckets, anchor & (1 << 40) - 1


def _digest(context: bytes) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(context) - (1 << 63)


def scan_intervals(common: list[int], low: list[int], before: list[int], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, common prefix, smallest document) of the left-diverse intervals of a suffix array.

    common[i]: length of the prefix that suffixes i and i + 1 share. before[i]: the byte in front of suffix i, or
    _DIVERSE where it is unknown. One pass with a stack of open intervals; a closed one passes its smallest document
    and its left byte to the interval around it.
    """
    stack: list[list[int]] = []  # prefix, first, smallest document, left byte
    for i in range(len(low)):
        first, least, left = i, low[i], before[i]
        shared = common[i] if i < len(common) else 0
        while stack and stack[-1][0] > shared:
            prefix, begin, least_in, left_in = stack.pop()
            first, least = begin, min(least, least_in)
            left = left if left == left_in else _DIVERSE
            if left == _DIVERSE:
                yield first, i, prefix, least
        if stack and stack[-1][0] == shared:
            top = stack[-1]
            top[2] = min(top[2], least)
            if top[3] != left:
                top[3] = _DIVERSE
        elif shared >= length:
            stack.append([shared, first, least, left])


def repeat_groups(contexts: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(context, begin, end, smallest document) of the occurrences of maximal repeats in distinct contexts.

    low, high: smallest and largest document of each context. A context of several documents stands for all its
    occurrences: its suffixes are leaves with several occurrences, and a leaf is an interval of its own where its prefix is
    longer than what it shares with its neighbours. Occurrences that no later document has are left out.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    bases = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    position = ranges(bases, windows)
    owner = np.repeat(np.arange(len(contexts)), windows)
    rest = (bases + sizes)[owner] - position
    width = int(rest.max())
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    table = np.lib.stride_tricks.sliding_window_view(padded, width)[position].copy()
    table[np.arange(width) >= rest[:, None]] = 0
    order = np.argsort(table.view(f"S{width}").ravel(), kind="stable")
    table = table[order]
    position, owner, rest = position[order], owner[order], rest[order]
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    before = np.where(position == bases[owner], _DIVERSE, data[position - 1].astype(np.int64))
    joined = np.concatenate([[False], common >= length, [False]])
    starts = np.flatnonzero(joined[1:] & ~joined[:-1])
    ends = np.flatnonzero(~joined[1:] & joined[:-1])
    least = low[owner]
    # Leaves: only at a context's first byte do unknown bytes stand in front; the others are part of a longer repeat.
    around = np.concatenate([[0], common, [0]])
    leaf = np.flatnonzero((low < high)[owner] & (before == _DIVERSE) & (rest > np.maximum(around[1:], around[:-1])))
    first, last, prefix, smallest = [leaf], [leaf], [rest[leaf]], [least[leaf]]
    if not len(starts) and not len(leaf):
        return
    # Runs with one common prefix are one interval; the others go through the stack.
    inner = ranges(starts, ends - starts)
    cuts = np.cumsum(ends - starts) - (ends - starts)
    flat = np.minimum.reduceat(common[inner], cuts) == np.maximum.reduceat(common[inner], cuts) if len(cuts) else np.empty(0, bool)
    if flat.any():
        a, b = starts[flat], ends[flat]
        members = ranges(a, b - a + 1)
        heads = np.cumsum(b - a + 1) - (b - a + 1)
        left_low, left_high = np.minimum.reduceat(before[members], heads), np.maximum.reduceat(before[members], heads)
        diverse = (left_low != left_high) | (left_low == _DIVERSE)
        first.append(a[diverse])
        last.append(b[diverse])
        prefix.append(common[a][diverse])
        smallest.append(np.minimum.reduceat(least[members], heads)[diverse])
    for a, b in zip(starts[~flat].tolist(), ends[~flat].tolist()):
        found = list(scan_intervals(common[a:b].tolist(), least[a : b + 1].tolist(), before[a : b + 1].tolist(), length))
        if found:
            columns = np.array(found, np.int64).T
            first.append(columns[0] + a)
            last.append(columns[1] + a)
            prefix.append(columns[2])
            smallest.append(columns[3])
    first, last, prefix, smallest = (np.concatenate(x) for x in (first, last, prefix, smallest))
    for i, j in slices(first, (last - first + 1).tolist(), 1 << 18):
        many = last[i:j] - first[i:j] + 1
        member = ranges(first[i:j], many)
        of, begin = owner[member], position[member] - bases[owner[member]]
        length_of, least_of = np.repeat(prefix[i:j], many), np.repeat(smallest[i:j], many)
        later = high[of] > least_of
        yield of[later], begin[later], (begin + length_of)[later], least_of[later]


def merged_contexts(packs: Iterable[tuple[bytes, bytes]], gram: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Distinct contexts by key: (key, context, smallest document, largest document)."""
    import zstandard

    held: dict[tuple[int, bytes], list[int]] = {}
    for numbers, raw in packs:
        offset, size, low, more = _unpacked(numbers, *_CONTEXT)
        data = zstandard.ZstdDecompressor().decompress(raw)
        ends = np.cumsum(size.astype(np.int64)).tolist()
        at = 0
        for o, a, b, end in zip(offset.tolist(), low.tolist(), (low + more).tolist(), ends):
            context = data[at:end]
            at = end
            name = (key_of(o, context, gram), context)
            old = held.get(name)
            if old is None:
                held[name] = [a, b]
            else:
                if a < old[0]:
                    old[0] = a
                if b > old[1]:
                    old[1] = b
    names = sorted(held)
    bounds = np.array([held[n] for n in names], np.int64).reshape(-1, 2)
    return np.array([n[0] for n in names], np.uint64), [n[1] for n in names], bounds[:, 0], bounds[:, 1]


def removable(packs: Iterable[tuple[bytes, bytes]], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(check, digest, begin, end, smallest document): what later occurrences of each context lose."""
    key, contexts, low, high = merged_contexts(packs, gram)
    if not contexts:
        return
    check = key.astype(np.uint32).view(np.int32)
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    # A lone context of one document repeats nothing.
    repeated = (size > 1) | (low[begin] < high[begin])
    begin, size = begin[repeated], size[repeated]
    weights = [sum(len(contexts[i]) - length + 1 for i in range(b, b + n)) for b, n in zip(begin.tolist(), size.tolist())]
    for i, j in slices(begin, weights, SUFFIXES):
        chosen = ranges(begin[i:j], size[i:j])
        some = [contexts[c] for c in chosen]
        for of, a, b, least in repeat_groups(some, low[chosen], high[chosen], length):
            used, back = np.unique(of, return_inverse=True)
            digests = np.array([_digest(some[u]) for u in used], np.int64)
            yield check[chosen[of]], digests[back] if len(used) else np.empty(0, np.int64), a, b, least


def spans_of(covers: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal removed runs of a text."""
    runs: list[list[int]] = []
    for a, b in sorted(covers):
        if runs and a <= runs[-1][1]:
            if b > runs[-1][1]:
                runs[-1][1] = b
        else:
            runs.append([a, b])
    return [(a, b) for a, b in runs]


def removals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary), one row per row of ``docs``.

    A null text counts as empty; texts shorter than ``length`` lose nothing. Rows that share a doc_id take nothing
    from each other. A row without doc_id counts as later than all with one. An empty table gives no rows. Rows
    that agree in id and text get equal results.
    """
    return _decided(docs, length, gram).select(F.nullif("doc", F.lit(_NO_ID).cast("long")).alias("doc_id"), "found.*")


def _keys(rows: DataFrame) -> tuple[DataFrame, list[str], int, int]:
    """Keys and text of documents, the keys' names, bytes of text and rows.

    `doc` orders documents. Only where ids repeat does a second key, `tie`, tell the texts of one id apart.
    """
    order = F.coalesce("doc_id", F.lit(_NO_ID).cast("long"))
    text = F.coalesce("text", F.lit(""))
    seen = rows.select(F.sum(F.octet_length(text)).alias("b"), F.count("*").alias("n"), F.countDistinct(order).alias("d")).first()
    ties = [] if seen["n"] == seen["d"] else [F.xxhash64(text).alias("tie")]
    return rows.select(order.alias("doc"), *ties, text.alias("text")), ["doc", *["tie"] * len(ties)], seen["b"] or 0, seen["n"]


def _decided(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Keys and found: (n_bytes, n_removed, n_spans, kept_sha256, kept); still partitioned by the keys."""
    import pandas as pd
    import pyarrow as pa

    spark = docs.sparkSession
    if not 4 <= gram <= length < gram + 250:
        raise ValueError("an anchor has at least 4 bytes, and a window fewer than 250 more")
    keyed, keys, total, count = _keys(documents(docs))
    often = max(HOT_LEAST, int(count * HOT_SHARE))
    buckets = max(2 * shuffle_partitions(spark), -(-total // GROUP))

    long = keyed.where(F.octet_length("text") >= length)
    digests = written(long.select(*keys, F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")), "digests")
    met = digests.groupBy("sha").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    earliest = written(met.where("least < most").select("sha", "least"), "earliest")
    copies = written(lookup_join(digests, earliest, ["sha"]).where("doc > least").select(*keys).distinct(), "copies")

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        def flush():
            found = list(anchor_rows(texts, np.array(ids, np.int64), buckets, length, gram))
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["bucket", "entries", "known"])

        texts, ids, held = [], [], 0
        for batch in batches:
            for doc, raw in zip(batch.column("doc").to_pylist(), texts_of(batch.column("text"))):
                texts.append(raw)
                ids.append(doc)
                held += len(raw)
                if held >= FLUSH:
                    yield from flush()
                    texts, ids, held = [], [], 0
        yield from flush()
        del texts, ids
        release()

    def flagged(group: pd.DataFrame) -> pd.DataFrame:
        doc, place, hot = shared_entries(group["entries"], group["known"], often)
        mark = np.full(len(hot), _HOT, np.int64)
        return pd.DataFrame(
            {"doc": np.concatenate([doc, mark]), "place": np.concatenate([place, hot.view(np.int64)]), "bucket": np.concatenate([np.full(len(doc), -1), np.full(len(hot), group["bucket"].iloc[0])])}
        )

    fresh = keyed.join(copies, keys, "left_anti")
    sent = fresh.select("doc", "text").mapInArrow(anchored, "bucket int, entries binary, known binary")
    flags = written(sent.groupBy("bucket").applyInPandas(flagged, "doc long, place long, bucket int"), "anchors")
    frequent = flags.where(F.col("bucket") >= 0).select("bucket", "place").collect()
    hot = frozenset((r["bucket"], r["place"]) for r in frequent)
    listed = flags.where(F.col("bucket") < 0)
    groups = max(2 * shuffle_partitions(spark), -(-listed.count() // (1 << 20)))
    marked = keyed.join(listed.groupBy("doc").agg(F.collect_list("place").alias("places")), "doc").select(*keys, "text", "places")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        import zstandard

        def flush():
            names = list(held)
            press = zstandard.ZstdCompressor(level=3).compress
            bucket = np.array([key_of(*n, gram) for n in names], np.uint64) % np.uint64(groups)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
            out: list[list] = [[], [], []]
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
                own = [names[i] for i in order[a:b]]
                bounds = np.array([held[n] for n in own], "<i8")
                offset, size = np.array([n[0] for n in own], np.uint8), np.array([len(n[1]) for n in own], np.uint16)
                out[0].append(int(bucket[order[a]]))
                out[1].append(_packed(offset, size, bounds[:, 0], bounds[:, 1] - bounds[:, 0]))
                out[2].append(press(b"".join(n[1] for n in own)))
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(c, pa.binary()) for c in out[1:]]], names=["bucket", "numbers", "contexts"])

        held: dict[tuple[int, bytes], list[int]] = {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc", "places")]
            for raw, doc, places in zip(texts_of(batch.column("text")), *columns):
                for offset, _, context in contexts_of(raw, places, hot, buckets, length, gram):
                    old = held.get((offset, context))
                    if old is None:
                        held[offset, context] = [doc, doc]
                    elif doc < old[0]:
                        old[0] = doc
                    elif doc > old[1]:
                        old[1] = doc
                if len(held) >= 1 << 17:
                    yield flush()
                    held.clear()
        if held:
            yield flush()
        held.clear()
        release()

    def lost(group: pd.DataFrame) -> pd.DataFrame:
        release()
        found = list(removable(zip(group["numbers"], group["contexts"]), length, gram))
        names = ("check", "digest", "a", "b", "least")
        if not found:
            return pd.DataFrame({n: np.empty(0, np.int64) for n in names})
        return pd.DataFrame({n: np.concatenate([f[i] for f in found]) for i, n in enumerate(names)})

    packed = marked.mapInArrow(contexts, "bucket int, numbers binary, contexts binary")
    losses = packed.groupBy("bucket").applyInPandas(lost, "check int, digest long, a int, b int, least long")

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        names = ["check", "digest", *keys, "first"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            columns = [batch.column(c).to_pylist() for c in (*keys, "places")]
            for raw, *row, places in zip(texts_of(batch.column("text")), *columns):
                for offset, first, context in contexts_of(raw, places, hot, buckets, length, gram):
                    for column, value in zip(out, (key_of(offset, context, gram), _digest(context), *row, first)):
                        column.append(value)
            check = np.array(out[0], np.uint64).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(check), *[pa.array(c, pa.int64()) for c in out[1:-1]], pa.array(out[-1], pa.int32())], names=names)
            out.clear()
        release()

    met = marked.mapInArrow(occurrences, f"check int, digest long, {' long, '.join(keys)} long, first int")
    covers = (
        met.join(losses, ["check", "digest"])
        .where("doc > least")
        .groupBy(*keys)
        .agg(F.collect_list((F.col("first") + F.col("a")).cast("long") * (1 << 16) + (F.col("b") - F.col("a"))).alias("covers"))
    )

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    def finished(texts, wholes, covers):
        out = []
        for text, whole, covered in zip(texts, wholes, covers):
            raw = text.encode()
            spans = [(0, len(raw))] if whole is True else spans_of((x >> 16, (x >> 16) + (x & 65535)) for x in covered.tolist()) if covered is not None else []
            kept, at = [], 0
            for begin, end in spans:
                kept.append(raw[at:begin])
                at = end
            kept = b"".join([*kept, raw[at:]])
            out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    whole = copies.withColumn("whole", F.lit(True))
    decided = keyed.join(covers, keys, "left").join(whole, keys, "left")
    return decided.select(*keys, finished("text", F.coalesce("whole", F.lit(False)), "covers").alias("found"))


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` with their columns; `text` is what remains and `n_chars`, if there, counts it again.

    A cut can split a character; its left-over bytes go too. Rows that lose every byte go; rows that lose nothing,
    empty and null texts among them, stay as they are.
    """
    doc, tie, null, to, to_tie, found = spare(docs, "cut_doc", "cut_tie", "cut_null", "cut_of", "cut_of_tie", "cut_found")
    _, keys, *_ = _keys(documents(docs))
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    id_ = F.coalesce(F.col("`doc_id`").cast("long"), F.lit(_NO_ID).cast("long"))
    others = [c for c in docs.columns if c != "text"]
    rest = docs.select(*[F.col(f"`{c}`") for c in others], F.col("`text`").isNull().alias(null), id_.alias(doc), F.xxhash64(text).alias(tie))
    decided = _decided(docs, length, gram)
    if len(keys) > 1:
        decided = decided.dropDuplicates(keys)
    decided = decided.select(*[F.col(k).alias(n) for k, n in zip(keys, (to, to_tie))], F.col("found").alias(found))
    on = F.col(doc) == F.col(to)
    joined = rest.join(decided, on & (F.col(tie) == F.col(to_tie)) if len(keys) > 1 else on)
    readable = F.pandas_udf(lambda raw: raw.map(lambda b: b.decode(errors="ignore")), "string")
    left = F.when(F.col(null), F.lit(None).cast("string")).otherwise(readable(F.col(found)["kept"]))
    lost, size = F.col(found)["n_removed"], F.col(found)["n_bytes"]
    out = joined.where((lost == 0) | (lost < size)).select(*[F.col(f"`{c}`") for c in others], left.alias("text"))
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
