"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of sample texts. A text is compressed with every
dictionary in turn, and the language whose dictionary gives the fewest bytes is chosen. Where the two best
languages are too close, or parts of the text are clearly of different languages, the text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, release, spread, texts_of

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit and parameters of the decision.

    docs_per_language, sample_chars, sample_pieces: the fit takes at most so many documents of a language, and of a
    longer document so many characters in pieces from its first to its last character. Samples enter the dictionary by
    hash of the id until it holds dictionary_bytes. All other work covers whole texts of all documents.
    piece: most bytes compressed at once, so that the dictionary, not a long text's own past, decides. Every text is
    cut into two equal pieces at least, so that two languages one after the other show.
    suffixes: a text that two languages compress equally well is compared again by the sum over so many of its
    word-wise suffixes, evenly spread over its words, which tells finer differences.
    margin: least share by which the best size must lie below the second best; and the share by which it must not lie
    above what the best languages of single pieces need. On sf0.1, 99.5 % of the longer texts of a language learned have
    margins above 0.08, 19 in 20 texts of shuffled letters margins below 0.03.
    """

    docs_per_language: int = 64
    sample_chars: int = 4096
    sample_pieces: int = 8
    dictionary_bytes: int = 96 * 1024
    piece: int = 4096
    level: int = 9
    suffixes: int = 64
    margin: float = 0.04


DEFAULT = Settings()


def fit(labelled: DataFrame, settings: Settings = DEFAULT) -> dict[str, bytes]:
    """Dictionaries of the languages in ``labelled`` (doc_id, text, lang).

    Rows without text or language are passed over. Per language the order is by hash of the id, so reruns agree; each
    input partition keeps only the rows that can still be chosen. What reaches the driver is bounded by the settings,
    for each language. Sample texts that repeat count once.
    """
    rows = documents(labelled, "lang").where("lang IS NOT NULL AND text IS NOT NULL AND length(trim(text)) > 0")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    chosen = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= settings.docs_per_language)
    sampled = chosen.select("lang", "place", spread(F.col("text"), settings.sample_chars, settings.sample_pieces).alias("text"))
    texts: dict[str, list[bytes]] = {}
    for row in sampled.orderBy("lang", "place").collect():
        texts.setdefault(row["lang"], []).append(bare(row["text"]))
    return {lang: b" ".join(dict.fromkeys(found))[: settings.dictionary_bytes] for lang, found in sorted(texts.items())}


#: ASCII without letters: marks and digits are alike in all languages.
_SPACES = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def bare(text: str) -> bytes:
    """Lower case, one blank between words, without ASCII marks and digits."""
    return b" ".join(text.lower().encode().translate(_SPACES).split())


class Sizer:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        import regex
        import zstandard

        self.letter = regex.compile(r"\p{L}").search
        self.settings = settings
        self.names = list(dictionaries)
        self.coders = []
        for raw in dictionaries.values():
            words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=settings.level)
            self.coders.append(
                zstandard.ZstdCompressor(
                    level=settings.level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
                ).compress
            )

        # Bytes that every compressed piece has, whatever is in it; they tell nothing.
        self.frame = len(self.coders[0](b"")) if self.coders else 0

    def judge(self, raw: bytes | None) -> tuple[str, float, bool]:
        """Language, score (1 - best size / second size) and whether the text is rejected."""
        if not raw or not self.names:
            return UNDETERMINED, 0.0, True
        text = raw.decode()
        if not self.letter(text):
            return UNDETERMINED, 0.0, True
        raw = bare(text)
        own = self.settings
        parts = max(2, -(-len(raw) // own.piece))
        step = max(1, -(-len(raw) // parts))
        pieces = [raw[i : i + step] for i in range(0, len(raw), step)]
        by_piece = [[len(code(p)) - self.frame for p in pieces] for code in self.coders]
        sizes = list(map(sum, by_piece))
        least = sum(map(min, zip(*by_piece)))
        told = min(sizes)
        if sizes.count(told) > 1:
            words = raw.split(b" ")
            starts = sorted({i * len(words) // own.suffixes for i in range(own.suffixes)})
            suffixes = [b" ".join(words[i:]) for i in starts]
            sizes = [sum(len(code(x)) - self.frame for x in suffixes) for code in self.coders]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = min((s for i, s in enumerate(sizes) if i != best), default=None)
        if rest is None:
            return self.names[best], 1.0, False
        share = 1.0 - sizes[best] / rest
        return self.names[best], share, share < own.margin or told - least > own.margin * told


def predict(docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep``, lang_pred, score (0 to 1) and rejected, one row per input row.

    A null text, or one without any letter, is `und` with score 0 and rejected, as is every text when no language
    was learned. Equal sizes go to the first language by name and are rejected. Rows that repeat give equal results.
    """
    import pyarrow as pa

    rows = documents(docs, *keep)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sizer = Sizer(dictionaries, settings)
        for batch in batches:
            found = [sizer.judge(t) for t in texts_of(batch.column("text"))]
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", *keep)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", *keep, "lang_pred", "score", "rejected"],
            )

    more = "".join(f", `{c}` string" for c in keep)
    return rows.mapInArrow(judged, f"doc_id long{more}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = DEFAULT) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is identified; rejected rows go.

    The texts are judged where they lie, without a join, so rows without an id or with a repeated id are
    judged each by its own text.
    """

    documents(docs)

    @F.pandas_udf("boolean")
    def accepted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        sizer = Sizer(dictionaries, settings)
        for texts in parts:
            yield texts.map(lambda t: not sizer.judge(None if t is None else t.encode())[2]).astype("bool")
        del sizer
        release()

    return docs.where(accepted(F.col("`text`").cast("string")))
