"""Quality rules: base counts, then distance of a text's histograms from language references.

Two histograms describe a text: its characters by class and its words by common word of any language. The common words
of a language are the most frequent ones of all its documents, so no language needs a list. A reference is the sum of
these histograms over all documents of a language. The text is kept if for some language the Jensen-Shannon
distances (base 2, from 0 to 1) of both stay within their limits. Texts below a least length are too short for
such a test and pass it. Everything is SQL on built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, documents, written

#: The six white-space characters of the word pattern.
BLANKS = " \t\n\x0b\x0c\r"
PUNCTUATION = r""".,;:!?'"()\-"""
PUNCTUATION_PLAIN = ".,;:!?'\"()-"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """chars, words: largest distances of a kept text. least_words: shorter texts are not tested.
    least_reference: words a language's reference needs to count. common: common words of a language."""

    chars: float = 0.28
    words: float = 0.26
    least_words: int = 50
    least_reference: int = 1000
    common: int = 6


DEFAULT = Limits()


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words found twice or more, the first one included.

    Windows are compared by 64-bit hashes, those of twice the words made of two smaller ones; a false match inside one text
    has a chance of about the square of its words over 2^64.
    """

    def joined(h: Column, size: int, done: int = 1) -> Column:
        step = min(done, size - done)
        if not step:
            return h
        both = _let(h, lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) - step), F.slice(x, F.lit(step + 1), F.size(x) - step), lambda a, b: F.xxhash64(a, b)))
        return joined(both, size, done + step)

    def covered(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def starts(s: Column) -> Column:
            def again(x: Column, j: Column) -> Column:
                return F.coalesce(F.get(s, j - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["g"] == x["g"], F.lit(False))

            return F.sort_array(F.transform(F.filter(s, again), lambda x: x["i"]))

        first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).alias("last"))

        def add(acc: Column, i: Column) -> Column:
            return F.struct((acc["n"] + F.least(F.lit(width), i - acc["last"])).cast("long").alias("n"), i.alias("last"))

        return _let(placed, lambda s: F.aggregate(starts(s), first, add, lambda acc: acc["n"]))

    def of_hashes(h: Column) -> Column:
        return _let(joined(h, width), lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0).cast("long")))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > width, _let(hashes, of_hashes)).otherwise(F.lit(0).cast("long"))


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANK}]+"))


def _folded(word: Column) -> Column:
    """A word as it is compared with common words: lower case, without marks around it."""
    return F.lower(F.btrim(word, F.lit(PUNCTUATION_PLAIN)))


def common_words(docs: DataFrame, limits: Limits = DEFAULT) -> list[str]:
    """The most frequent words with a letter of each language of ``least_reference`` words or more, in one sorted list.

    Every word of every document with a language is counted; ties go to the smaller word. Counts are summed in each task
    before they are shuffled, and each partition passes on only words that can still be chosen, so a language that holds most
    documents gathers nowhere. ``common`` words a language reach the driver. An empty table has none.
    """
    rows = documents(docs, "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    met = rows.select("lang", F.explode(_words(F.col("text"))).alias("w")).select("lang", _folded(F.col("w")).alias("word"))
    counted = written(met.groupBy("lang", "word").agg(F.count("*").alias("n")), "quality-words")
    large = counted.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= limits.least_reference).select("lang")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    placed = counted.where(F.col("word").rlike(r"\p{L}")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= limits.common)
    # The few words left meet the languages last; a semi join would be moved below the window and bring all words to their language.
    return sorted({r["word"] for r in placed.join(large, "lang").select("word").collect()})


def _without(text: Column, characters: str) -> Column:
    """Length of a text without a class of characters."""
    return F.length(F.regexp_replace(text, f"[{characters}]+", "")).cast("long")


def counts(docs: DataFrame, known: list[str]) -> DataFrame:
    """doc_id, lang, the base counts, and the histograms chars and words (arrays of longs), one row per row.

    words counts each of the ``known`` common words, then all others together.
    """
    rows = documents(docs, "lang")
    text = F.coalesce("text", F.lit(""))
    told = rows.select("doc_id", "lang", text.alias("t"), _words(text).alias("w"))
    total = F.length("t").cast("long")
    common = F.filter(F.transform("w", _folded), lambda w: w.isin(*known))
    listed = F.lit(known).cast("array<string>") if known else F.array().cast("array<string>")

    def histogram(found: Column) -> Column:
        each = F.transform(listed, lambda x: F.size(F.filter(found, lambda w: w == x)).cast("long"))
        return F.concat(each, F.array((F.col("n_words") - F.size(found)).cast("long")))

    measured = told.select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        (total - _without(F.col("t"), "#*$%&|<>")).alias("n_symbols"),
        _let(F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        total.alias("total"),
        (total - _without(F.col("t"), r"\p{Lu}")).alias("upper"),
        (total - _without(F.col("t"), r"\p{L}")).alias("letters"),
        (total - _without(F.col("t"), "0-9")).alias("digits"),
        (total - _without(F.col("t"), PUNCTUATION)).alias("marks"),
        common.alias("found"),
    )
    other = F.col("word_chars") - F.col("letters") - F.col("digits") - F.col("marks")
    chars = F.array("upper", F.col("letters") - F.col("upper"), "digits", F.col("total") - F.col("word_chars"), "marks", other)
    words = _let(F.col("found"), histogram).alias("words")
    return measured.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", chars.alias("chars"), words)


def references(counted: DataFrame, n_known: int, limits: Limits = DEFAULT) -> list[tuple[str, list[int], list[int]]]:
    """Language, character and word histograms, summed over all documents of the language; a row per language."""
    sums = counted.where("lang IS NOT NULL").groupBy("lang").agg(
        F.sum("n_words").alias("n"),
        F.array(*[F.sum(F.get("chars", F.lit(i))) for i in range(6)]).alias("chars"),
        F.array(*[F.sum(F.get("words", F.lit(i))) for i in range(n_known + 1)]).alias("words"),
    )
    return [(r["lang"], r["chars"], r["words"]) for r in sums.where(F.col("n") >= limits.least_reference).orderBy("lang").collect()]


def distance(counts_: Column, reference: list[int]) -> Column:
    """Jensen-Shannon distance of a histogram from a reference; null for an empty histogram."""
    total = sum(reference)
    share = F.lit([x / total for x in reference])

    def term(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)

    def measured(sum_: Column) -> Column:
        own = F.transform(counts_, lambda x: x / sum_)
        return F.aggregate(F.zip_with(own, share, term), F.lit(0.0), lambda acc, x: acc + x)

    whole = F.aggregate(counts_, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(F.lit(0.0), _let(whole, lambda s: F.when(s > 0, measured(s))) / 2))


def judge(docs: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and language and the two
    distances of the language that fits best; one row per input row.

    A null text has no words and fails the base rules, as does any of fewer than 20 words. Without any reference the
    base rules alone decide. Repeated rows get equal results; an empty table gives no rows.
    """
    known = common_words(docs, limits)
    counted = written(counts(docs, known), "quality-counts")
    found = references(counted, len(known), limits)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fits = [
        F.struct(distance(F.col("chars"), chars).alias("jsd_chars"), distance(F.col("words"), words).alias("jsd_words"), F.lit(lang).alias("language"))
        for lang, chars, words in found
    ]
    kind = "array<struct<jsd_chars: double, jsd_words: double, language: string>>"
    judged = counted.select("*", failed.alias("base_failed"), (F.array(*fits) if fits else F.array()).cast(kind).alias("fits"))

    def within(f: Column) -> Column:
        return (f["jsd_chars"] <= limits.chars) & (f["jsd_words"] <= limits.words)

    closest = F.array_min(F.transform("fits", lambda f: F.struct((f["jsd_chars"] + f["jsd_words"]).alias("sum"), f.alias("fit"))))["fit"]
    passed = (F.col("n_words") < limits.least_words) | (F.size("fits") == 0) | F.coalesce(F.exists("fits", within), F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & passed).alias("kept"), closest["language"].alias("language"), closest["jsd_chars"].alias("jsd_chars"), closest["jsd_words"].alias("jsd_words"),
    )
