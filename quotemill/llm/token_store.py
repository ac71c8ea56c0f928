"""Token ids in wavelet-matrix files.

Documents are ordered by id over the whole table, encoded, and written in shards. A shard holds its ids as a wavelet
matrix: one bit-plane per bit of an id, each a stable partition of the one before, compressed, with a directory of
set bits. From a shard alone a token can be read, counted, or found by occurrence.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import documents, shuffle_partitions, texts_of

#: Ids of a shard (a longer document has one of its own), text bytes of a range of documents, words a worker remembers.
SHARD = 1 << 22
RANGE = 1 << 26
REMEMBERED = 1_000_000
#: Bits between entries of the directory.
STRIDE = 512

_KEYS = "part int, seq int"
SHARD_SCHEMA = f"{_KEYS}, doc_ids binary, id_null binary, lengths binary, n_tokens long, bits int, zeros array<long>, planes array<binary>, directory array<binary>"


class WaveletMatrix:
    """Ids 0 .. 2^bits - 1 as bit-planes. planes[0] is the highest bit; zeros[l] counts its unset bits."""

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int], directory: list[np.ndarray]):
        self.size, self.planes, self.zeros, self.directory = size, planes, zeros, directory

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, directory = [], [], []
        for level in range(bits - 1, -1, -1):
            set_ = (ids >> ids.dtype.type(level)) & ids.dtype.type(1) != 0
            packed = np.packbits(set_, bitorder="little")
            planes.append(packed)
            clear = ids[~set_]
            zeros.append(len(clear))
            padded = np.pad(packed, (0, -len(packed) % (STRIDE // 8)))
            counts = np.bitwise_count(padded).reshape(-1, STRIDE // 8).sum(axis=1, dtype=np.uint32)
            directory.append(np.cumsum(counts, dtype=np.uint32) - counts)
            ids = np.concatenate([clear, ids[set_]])
        return cls(len(set_) if bits else 0, planes, zeros, directory)

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3]) >> (at & 7) & 1

    def _ones(self, level: int, at: int) -> int:
        """Set bits before ``at``."""
        if at >= self.size:
            return self.size - self.zeros[level]
        block = at // STRIDE
        begin = block * (STRIDE // 8)
        whole = int(np.bitwise_count(self.planes[level][begin : at >> 3]).sum())
        part = int(self.planes[level][at >> 3]) & (1 << (at & 7)) - 1
        return int(self.directory[level][block]) + whole + part.bit_count()

    def access(self, at: int) -> int:
        """The id at a position."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, at)
            ones = self._ones(level, at)
            at = zeros + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, at: int) -> tuple[int, int]:
        """Where the last level holds the occurrences of ``value`` before position ``at``."""
        begin, end = 0, at
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, begin), self._ones(level, end)
            if value >> (len(self.zeros) - 1 - level) & 1:
                begin, end = zeros + a, zeros + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def rank(self, value: int, at: int) -> int:
        """Occurrences of ``value`` before position ``at``."""
        if value >> len(self.zeros):
            return 0
        begin, end = self._range(value, min(at, self.size))
        return end - begin

    def count(self, value: int) -> int:
        return self.rank(value, self.size)

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of ``value``; -1 if there are not as many."""
        if not 0 <= k < self.count(value):
            return -1
        at = self._range(value, self.size)[0] + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = value >> (len(self.zeros) - 1 - level) & 1
            at = self._find(level, bit, at - self.zeros[level] if bit else at)
        return at

    def _find(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th bit (from 0) with this value, by halving over ranks."""
        low, high = 0, self.size - 1
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            if (ones if bit else middle + 1 - ones) > k:
                high = middle
            else:
                low = middle + 1
        return low

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last level to the first."""
        kind = np.uint16 if len(self.zeros) <= 16 else np.uint32
        ids = np.zeros(self.size, kind)
        for level in range(len(self.zeros) - 1, -1, -1):
            set_ = np.unpackbits(self.planes[level], count=self.size, bitorder="little").astype(bool)
            zeros, back = self.zeros[level], np.empty(self.size, kind)
            back[~set_] = ids[:zeros]
            back[set_] = ids[zeros:] | kind(1 << (len(self.zeros) - 1 - level))
            ids = back
        return ids


# How the public tokenizer files served here normalise and split texts.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLITS = ["Split", "ByteLevel"]
_SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words of printable ASCII and the letters of Latin-1: they are in normal form already, and lower-case letter by letter.
_SIMPLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
#: The split pattern on such words, lower-cased.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+").findall


class Encoder:
    """Ids of texts by a public tokenizer that never joins what white space parts.

    Its pattern matches no white space and its normalisation acts inside words, so a text's ids are those of its words,
    one after the other; words met before are remembered.
    """

    def __init__(self, path: str, end: int, kind: type):
        self.words = _Words(path, kind)
        self.end = np.array([end], kind).tobytes()

    def encode(self, text: bytes | None) -> bytes:
        """Ids of a text and the end id, as bytes."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
            self.words.pieces.clear()
        return b"".join(map(self.words.__getitem__, text.split() if text else ())) + self.end


class _Words(dict):
    """Ids of words met before.

    If the file's rules are the known ones, a simple word is cut into its pieces here and the library's model encodes each
    new piece; every other word goes through the whole library.
    """

    def __init__(self, path: str, kind: type):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.whole, self.kind = tokenizer.encode, kind
        self.cut, self.pieces = _known_rules(path), _Pieces(tokenizer, kind)
        added = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)", re.IGNORECASE).search

    def __missing__(self, raw: bytes) -> bytes:
        word = raw.decode()
        if not self.cut or not _SIMPLE(word) or self.added(word):
            ids = np.array(self.whole(word, add_special_tokens=False).ids, self.kind).tobytes()
        elif word.isalpha():
            ids = self.pieces[word.lower()]
        else:
            ids = b"".join(map(self.pieces.__getitem__, _PIECES(word.lower())))
        self[raw] = ids
        return ids


def _known_rules(path: str) -> bool:
    """Whether a tokenizer file normalises and splits by the fixed values above."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    normal, split = rules["normalizer"] or {}, rules["pre_tokenizer"] or {}
    if [n["type"] for n in normal.get("normalizers", [])] != _NORMALIZERS:
        return False
    cuts = split.get("pretokenizers", [])
    if [c["type"] for c in cuts] != _SPLITS or rules.get("post_processor"):
        return False
    cut, level = cuts
    return (
        normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and (cut["pattern"], cut["behavior"], cut["invert"]) == ({"Regex": _SPLIT_PATTERN}, "Removed", True)
        and not level["add_prefix_space"]
        and not level["use_regex"]
    )


class _Pieces(dict):
    """Ids of lower-cased pieces met before; the library's model encodes a new one."""

    def __init__(self, tokenizer, kind: type):
        from tokenizers import pre_tokenizers

        self.model = tokenizer.model.tokenize
        self.ids = [i.to_bytes(kind().itemsize, "little") for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.level = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(0xC0, 0x100)}

    def __missing__(self, piece: str) -> bytes:
        coded = piece if piece.isascii() else piece.translate(self.level)
        ids = self[piece] = b"".join([self.ids[t.id] for t in self.model(coded)])
        return ids


_ENCODERS: dict[tuple[str, int, str], Encoder] = {}


def encoder_of(path: str, end: int, kind: type) -> Encoder:
    """One encoder per tokenizer file and worker, so that a worker's later tasks find the words of its earlier ones."""
    key = (path, end, np.dtype(kind).str)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, end, kind)
    return _ENCODERS[key]


def vocabulary_bits(path: str) -> int:
    from tokenizers import Tokenizer

    return max(1, (Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1).bit_length())


def write(docs: DataFrame, path: str, target: str, end: int = 2) -> None:
    """Encode ``docs`` with the tokenizer file ``path`` and write shards, in ascending doc_id order, to ``target``.

    Each document ends with the id ``end``; a null text has that id alone. Rows without doc_id come last. Rows that
    share a doc_id stand in the order of their texts. Shards are numbered by range of ids and place inside the range.
    """
    import pyarrow as pa

    rows = documents(docs)
    bits = max(vocabulary_bits(path), end.bit_length())
    kind = np.uint16 if bits <= 16 else np.uint32
    total = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), -(-total // RANGE))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(order[0], "text")

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        press = zstandard.ZstdCompressor(level=1).compress
        encoder = encoder_of(path, end, kind)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        coded: list[bytes] = []
        held = 0

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(coded), kind), bits)
            lengths = np.array([len(c) // kind().itemsize for c in coded], "<i8")
            values = {
                "part": part,
                "seq": seq,
                "doc_ids": press(np.array([i or 0 for i in ids], "<i8").tobytes()),
                "id_null": press(np.array([i is None for i in ids], np.uint8).tobytes()),
                "lengths": press(lengths.tobytes()),
                "n_tokens": matrix.size,
                "bits": bits,
                "zeros": matrix.zeros,
                "planes": [press(p.tobytes()) for p in matrix.planes],
                "directory": [press(d.astype("<u4").tobytes()) for d in matrix.directory],
            }
            return pa.RecordBatch.from_arrays([pa.array([values[f.name]], f.type) for f in _arrow_schema()], schema=_arrow_schema())

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                own = encoder.encode(text)
                if ids and held + len(own) // kind().itemsize > SHARD:
                    yield shard()
                    seq, ids, coded, held = seq + 1, [], [], 0
                ids.append(doc)
                coded.append(own)
                held += len(own) // kind().itemsize
        if ids:
            yield shard()

    placed.mapInArrow(sharded, SHARD_SCHEMA).write.parquet(target)


def _arrow_schema():
    import pyarrow as pa

    return pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.binary()), ("id_null", pa.binary()), ("lengths", pa.binary()), ("n_tokens", pa.int64()), ("bits", pa.int32()), ("zeros", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary())), ("directory", pa.list_(pa.binary()))]
    )


def open_shard(row: dict) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """doc_ids, lengths and ids of a shard, from its stored fields."""
    import zstandard

    read = zstandard.ZstdDecompressor().decompress
    ids = [None if null else i for i, null in zip(np.frombuffer(read(row["doc_ids"]), "<i8").tolist(), read(row["id_null"]))]
    planes = [np.frombuffer(read(p), np.uint8) for p in row["planes"]]
    directory = [np.frombuffer(read(d), "<u4") for d in row["directory"]]
    return ids, np.frombuffer(read(row["lengths"]), "<i8"), WaveletMatrix(row["n_tokens"], planes, row["zeros"], directory)


def read_digests(spark, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the files alone."""
    import pyarrow as pa

    shards = spark.read.schema(SHARD_SCHEMA).parquet(target)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths, matrix = open_shard(row)
                tokens = matrix.decode()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)), pa.array(ids, pa.int64()), pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    found = shards.mapInArrow(digested, f"{_KEYS}, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # Totals of ranges, then of shards inside a range; one row each, never documents.
    sizes = shards.select("part", "seq", "n_tokens")
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    over_parts = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("ahead"))
    offsets = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)).alias("within")).join(parts, "part").select("part", "seq", (F.col("ahead") + F.col("within")).alias("offset"))
    return found.join(offsets, ["part", "seq"]).select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def store_and_read(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """Write the shards to a new place in the shared folder and read them back.

    An empty table gives no rows; the other cases are those of ``write``.
    """
    target = fresh_path(docs.sparkSession, "tokens")
    write(docs, path, target, end)
    return read_digests(docs.sparkSession, target)
