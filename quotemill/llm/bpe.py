"""Byte-level BPE encoding and decoding with a rank queue of hierarchical bitmaps.

A pre-token's bytes form a linked list. Every neighbouring pair that has a rank waits in that rank's bucket; three
levels of 64-bit maps tell which buckets hold something, so "find first set" names the lowest rank at once. A pair
that an earlier merge changed is skipped when its turn comes. The cost of a merge does not depend on the pre-token's
length, which keeps very long pre-tokens linear.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import REMEMBERING, documents, release, texts_of

#: Pre-tokens whose ids a worker remembers before it starts afresh; those it held until then stay as older ones, and go at the
#: next start unless they were met again. A matter of speed and memory alone.
REMEMBERED = 250_000


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        # The maps are empty between pre-tokens: bit r of the low map says that bucket r holds something, and a bit
        # of a map above says that the word below it does.
        self.low = [0] * ((max(ranks.values()) >> 6) + 1)
        self.middle = [0] * ((max(ranks.values()) >> 12) + 1)
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.known = _Known(self)
        self.remembered = REMEMBERED

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        rank_of, low, middle, high = self.ranks.get, self.low, self.middle, 0
        buckets: dict[int, list[int]] = {}
        # Node i starts at byte i; after[i] is where it ends and the next begins, before[i] the start of the one before.
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        waiting = [rank_of(piece[i : i + 2], -1) for i in range(size - 1)]
        waiting.append(-1)
        for i, rank in enumerate(waiting):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # ascending, so the list is a heap
                else:
                    buckets[rank] = [i]
                    low[rank >> 6] |= 1 << (rank & 63)
                    middle[rank >> 12] |= 1 << (rank >> 6 & 63)
                    high |= 1 << (rank >> 12)
        while high:
            top = (high & -high).bit_length() - 1
            bits = middle[top]
            word = top << 6 | (bits & -bits).bit_length() - 1
            bits = low[word]
            rank = word << 6 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = buckets.pop(rank)[0]
                low[word] = bits & bits - 1
                if not low[word]:
                    middle[top] &= middle[top] - 1
                    if not middle[top]:
                        high &= high - 1
            if waiting[i] != rank:
                continue  # an earlier merge changed this pair
            j = after[i]
            end = after[i] = after[j]
            waiting[i] = waiting[j] = -1
            if end < size:
                before[end] = i
            for k, stop in ((i, after[end] if end < size else 0), (before[i], end)):
                if k < 0 or not stop:
                    continue
                rank = waiting[k] = rank_of(piece[k:stop], -1)
                if rank >= 0:
                    if rank in buckets:
                        heappush(buckets[rank], k)
                    else:
                        buckets[rank] = [k]
                        low[rank >> 6] |= 1 << (rank & 63)
                        middle[rank >> 12] |= 1 << (rank >> 6 & 63)
                        high |= 1 << (rank >> 12)
        out, i = [], 0
        ranks = self.ranks
        while i < size:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.remembered:
            self.known.age()
        return b"".join(map(self.known.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Known(dict):
    """Ids of pre-tokens met before; a new one is merged."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def age(self) -> None:
        self.older = dict(self)
        self.clear()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.codec.merge(piece.encode()), "<u4").tobytes()
        self[piece] = ids
        return ids


_CODECS: dict[tuple[str, str], Codec] = {}
REMEMBERING.append(_CODECS)


def codec(path: str, pattern: str) -> Codec:
    """One codec per vocabulary and worker. The vocabulary is a file of an installed package, the same on every machine."""
    if (path, pattern) not in _CODECS:
        with open(path, "rb") as file:
            _CODECS[path, pattern] = Codec(read_ranks(file.read()), pattern)
    return _CODECS[path, pattern]


def release_others() -> None:
    """Let go of what other operators left in this worker. At module level, as a nested function would carry a copy of the codecs."""
    release(_CODECS)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), one row per input row. A null text has no ids."""
    import pyarrow as pa

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = codec(path, pattern).encode
        for batch in batches:
            ids = [encode_or_empty(encoder, t) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return documents(docs).mapInArrow(coded, "doc_id long, ids binary")


def encode_or_empty(encoder, raw: bytes | None) -> bytes:
    return encoder(raw.decode()) if raw else b""


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids -> doc_id, ids, raw (the decoded bytes)."""
    import pyarrow as pa

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = codec(path, pattern).decode
        for batch in batches:
            raw = [decoder(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(raw, pa.binary())], names=["doc_id", "ids", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids binary, raw binary")


def round_trip(docs: DataFrame, path: str, pattern: str, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded and its ids decoded again.

    Null and empty texts have no tokens and the hashes of no bytes. Rows that repeat give equal results; an empty
    table gives no rows; a very long pre-token costs in proportion to its length. A worker remembers the ids of up to
    twice ``remembered`` pre-tokens, which changes speed and memory, never a result.
    """
    import pyarrow as pa

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(path, pattern)
        both.remembered = remembered
        release_others()
        for batch in batches:
            counts, hashes, back = [], [], []
            for raw in texts_of(batch.column("text")):
                ids = encode_or_empty(both.encode, raw)
                counts.append(len(ids) // 4)
                hashes.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(both.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents(docs).mapInArrow(told, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
