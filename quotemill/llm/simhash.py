"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints that differ in at most four of 64 bits agree in at least two of six bit blocks. Each fingerprint
therefore goes, once for each pair of blocks, to the place named by its bits there; a place holds one trie whose
first levels have no error budget. The trie is joined with itself: pairs of nodes go down together, gather
differing bits, and are dropped beyond the budget. A place returns a spanning star of every group it finds, never
all pairs. Groups over all places are connected components of those stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, release, shuffle_partitions, slices, spare, texts_of, written
from .components import components

WIDTH = 4
BUDGET = 4
#: Fingerprints dealt to a task, each once per choice of blocks. Moves work only; no result depends on it.
DEALT = 1 << 20
SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Trie leaves joined at once, and node pairs held at once, in one worker.
LEAVES = 1 << 17
PAIRS = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(raw: bytes | None, width: int = WIDTH) -> int:
    """64 bits, unsigned. A bit is set if it is set in over half of the shingles' hashes, repeats included."""
    from xxhash import xxh64_intdigest

    words = raw.translate(_LOWER).split() if raw else []
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
        count = 1
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)]))
        count = len(words) - width + 1
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 65536):
        block = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > count, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long). Null and empty texts have fingerprint zero."""
    import pyarrow as pa

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = [fingerprint(t, width) for t in texts_of(batch.column("text"))]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), signed], names=["doc_id", "fp"])

    return documents(docs).mapInArrow(hashed, "doc_id long, fp long")


def _masks(blocks: tuple[int, ...], kept: int) -> list[int]:
    """Signed masks of all choices of ``kept`` blocks."""
    ends = np.cumsum(blocks)
    single = [((1 << w) - 1) << int(e - w) for w, e in zip(blocks, ends)]
    masks = [sum(single[i] for i in chosen) for chosen in combinations(range(len(blocks)), kept)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def trie_pairs(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, budget: int, most: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``budget`` bits of each other, inside each range [start, end) of ``fps``.

    fps: uint64, sorted and without repeats inside a range. A trie node is a range of the sorted fingerprints.
    Pairs of nodes descend level by level; a pair of leaves is settled by one XOR; a frontier larger than ``most`` is
    cut in two and done one half after the other, which bounds memory.
    """
    counts: dict[int, np.ndarray] = {}

    def ones(level: int) -> np.ndarray:
        if level not in counts:
            bits = (fps >> np.uint64(level)) & np.uint64(1)
            counts[level] = np.concatenate([[0], np.cumsum(bits, dtype=np.int32)]).astype(np.int32)
        return counts[level]

    work = [(63, starts.astype(np.int32), ends.astype(np.int32), starts.astype(np.int32), ends.astype(np.int32), np.zeros(len(starts), np.int8))]
    while work:
        level, al, ah, bl, bh, spent = work.pop()
        leaf = (ah - al == 1) & (bh - bl == 1)
        if leaf.any():
            a, b = al[leaf], bl[leaf]
            near = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= budget)
            if near.any():
                yield a[near], b[near]
            al, ah, bl, bh, spent = (x[~leaf] for x in (al, ah, bl, bh, spent))
        if not len(al) or level < 0:
            continue
        if len(al) > most:
            half = len(al) // 2
            work.append((level, al[half:], ah[half:], bl[half:], bh[half:], spent[half:]))
            work.append((level, al[:half], ah[:half], bl[:half], bh[:half], spent[:half]))
            continue
        c = ones(level)
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        own = al == bl
        cross = ~own
        parts = (
            (al, am, bl, bm, spent),
            (am, ah, bm, bh, spent),
            (al, am, bm, bh, spent + 1),
            *[tuple(x[cross] for x in (am, ah, bl, bm, spent + 1))],
        )
        nal, nah, nbl, nbh, nsp = (np.concatenate([p[i] for p in parts]) for i in range(5))
        live = (nah > nal) & (nbh > nbl) & (nsp <= budget) & ~((nal == nbl) & (nah - nal == 1))
        work.append((level - 1, nal[live], nah[live], nbl[live], nbh[live], nsp[live]))


def stars(left: np.ndarray, right: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indices into ``nodes`` -> (node, smallest node of its group), without the smallest ones themselves."""
    used, inverse = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = inverse[: len(left)], inverse[len(left) :]
    rank = np.argsort(np.argsort(nodes[used], kind="stable"), kind="stable")
    label = rank.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        by_rank = np.empty_like(new)
        by_rank[rank] = new
        new = np.minimum(new, by_rank[new])
        if (new == label).all():
            break
        label = new
    of_rank = np.empty(len(used), nodes.dtype)
    of_rank[rank] = nodes[used]
    moved = label != rank
    return nodes[used][moved], of_rank[label[moved]]


def links(distinct: DataFrame, budget: int = BUDGET, blocks: tuple[int, ...] = BLOCKS) -> DataFrame:
    """Distinct (fp, node) -> edges (a, b) between nodes whose connected groups are those of all close pairs.

    ``blocks`` are bit widths; all but ``budget`` of them agree in any close pair. A place's share of a task
    is one range of sorted fingerprints, so memory follows the task's input: about DEALT fingerprints, however many
    there are in all.
    """
    import pyarrow as pa

    kept = len(blocks) - budget
    if kept < 1 or sum(blocks) != 64:
        raise ValueError("blocks must have 64 bits in all and outnumber the budget")
    masks = _masks(blocks, kept)
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("place")) for i, m in enumerate(masks)]))
    parts = max(shuffle_partitions(distinct.sparkSession), -(-distinct.count() * len(masks) // DEALT))
    dealt = distinct.select("fp", "node", choice.alias("k")).select("k.c", "k.place", "fp", "node")
    dealt = dealt.repartition(parts, "c", "place")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        c, place, fp, node = (table.column(n).to_numpy() for n in ("c", "place", "fp", "node"))
        held.clear()
        fp = fp.view(np.uint64)
        order = np.lexsort((fp, place, c))
        c, place, fp, node = c[order], place[order], fp[order], node[order]
        first = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (place[1:] != place[:-1])]))
        last = np.append(first[1:], len(fp))
        several = last - first > 1
        first, last = first[several], last[several]
        for i, j in slices(first, (last - first).tolist(), LEAVES):
            base, top = first[i], last[j - 1]
            part, ids = fp[base:top], node[base:top]
            for left, right in trie_pairs(part, first[i:j] - base, last[i:j] - base, budget):
                a, b = stars(left, right, ids)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(joined, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET, blocks: tuple[int, ...] = BLOCKS) -> DataFrame:
    """doc_id, fp (signed long), component_id: smallest doc_id reachable over close fingerprints, itself included.

    One row per input row. Null and empty texts have fingerprint zero and link like any other. Equal fingerprints meet
    once, by their smallest doc_id, however many documents share them. A row without doc_id gets a fingerprint, links
    nothing and has a null component. An empty table gives no rows.
    """
    prints = written(fingerprints(docs, width), "fingerprints")
    distinct = written(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fingerprints")
    reached = components(links(distinct, budget, blocks))
    labelled = distinct.join(reached, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(labelled, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET, blocks: tuple[int, ...] = BLOCKS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, of one document per group: the one with the smallest doc_id.

    Groups are those of ``near_duplicates``. Rows that repeat a doc_id stay once. Rows without doc_id belong to no group
    and stay. An empty table stays empty.
    """
    found = near_duplicates(docs, width, budget, blocks)
    (chosen, number) = spare(docs, "simhash_id", "simhash_row")
    id_ = F.col("`doc_id`").cast("long")
    if _unique(docs):
        # The others are fewer, and a row without doc_id is no match.
        gone = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias(chosen)), "near-copies")
        return docs.join(gone, id_ == F.col(chosen), "left_anti")
    first = written(found.where("doc_id = component_id").select(F.col("doc_id").alias(chosen)).distinct(), "first-copies")
    rows = Window.partitionBy(chosen).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in ("doc_id", "text")]))
    kept = docs.join(first, id_ == F.col(chosen)).withColumn(number, F.row_number().over(rows)).where(F.col(number) == 1)
    return kept.drop(chosen, number).unionByName(docs.where(id_.isNull()))


def _unique(docs: DataFrame) -> bool:
    """Whether no doc_id repeats; one pass over that column alone."""
    ids = docs.select(F.col("`doc_id`").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    return ids.groupBy("doc_id").count().where("count > 1").isEmpty()
