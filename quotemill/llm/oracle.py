"""SQL for the operators that SQL can express; the others are tested against brute-force versions."""

from __future__ import annotations

from . import importance, licenses, quality_rules, substring_dedup

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
      FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size, md5(coalesce(text, '')) AS h FROM documents),
k AS (SELECT *, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || h) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
             source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_ FROM w),
m AS (SELECT *, max(CASE WHEN (total - full_) / open_ * weight <= cap THEN (total - full_) / open_ END) OVER () AS level FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM m),
b AS (SELECT *, least(CAST(round(target) AS BIGINT), source_size * 3) AS budget FROM t),
p AS (SELECT k.doc_id, k.size, b.source_size, b.target, b.budget,
             coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
             CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS epochs
      FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)) AS BIGINT) AS taken FROM p"""


def _quality() -> str:
    limits = quality_rules.DEFAULT
    marks = quality_rules.PUNCTUATION.replace("'", "''")
    plain = quality_rules.PUNCTUATION_PLAIN.replace("'", "''")

    def distance(own: str, ref: str) -> str:
        pairs = f"list_zip(list_transform({own}, lambda x: x / list_sum({own})), list_transform({ref}, lambda x: x / list_sum({ref})))"
        part = "CASE WHEN z[{i}] > 0 THEN z[{i}] * log2(z[{i}] / ((z[1] + z[2]) / 2)) ELSE 0 END"
        terms = f"list_transform({pairs}, lambda z: {part.format(i=1)} + {part.format(i=2)})"
        return f"sqrt(greatest(0, list_sum({terms}) / 2))"

    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT *, row_number() OVER () AS row_ FROM d),
v AS (SELECT lang, lower(trim(x, '{plain}')) AS word, count(*) AS n FROM (SELECT lang, unnest(w) AS x FROM d WHERE lang IS NOT NULL) GROUP BY ALL),
k AS (SELECT coalesce(list(DISTINCT word ORDER BY word), []) AS known
      FROM (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM v
            WHERE regexp_matches(word, '\p{{L}}') AND lang IN (SELECT lang FROM v GROUP BY lang HAVING sum(n) >= {limits.least_reference}))
      WHERE place <= {limits.common}),
g AS (SELECT row_, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT row_, w, unnest(range(1, len(w) - 6)) AS i FROM u WHERE len(w) > 7)),
a AS (SELECT row_, i FROM (SELECT *, count(*) OVER (PARTITION BY row_, g) AS n FROM g) WHERE n > 1),
r AS (SELECT row_, sum(least(8, i - before)) AS n_repeat_words
      FROM (SELECT row_, i, coalesce(lag(i) OVER (PARTITION BY row_ ORDER BY i), i - 8) AS before FROM a) GROUP BY row_),
c AS (SELECT u.*, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
               - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS upper_, length(t) - length(regexp_replace(t, '\p{{L}}', '', 'g')) AS letters,
             length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS digits, length(t) - length(regexp_replace(t, '[{marks}]', '', 'g')) AS marks,
             list_filter(list_transform(w, lambda x: lower(trim(x, '{plain}'))), lambda x: list_contains(known, x)) AS folded, known
      FROM u CROSS JOIN k LEFT JOIN r ON u.row_ = r.row_),
h AS (SELECT doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
             [upper_, letters - upper_, digits, length(t) - word_chars, marks, word_chars - letters - digits - marks] AS chars,
             list_append(list_transform(known, lambda y: len(list_filter(folded, lambda x: x = y))), n_words - len(folded)) AS words FROM c),
f AS (SELECT lang FROM h WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {limits.least_reference}),
s AS (SELECT lang, kind, i, sum(c) AS c
      FROM (SELECT lang, 'chars' AS kind, unnest(chars) AS c, generate_subscripts(chars, 1) AS i FROM h SEMI JOIN f USING (lang)
            UNION ALL SELECT lang, 'words', unnest(words), generate_subscripts(words, 1) FROM h SEMI JOIN f USING (lang)) GROUP BY ALL),
e AS (SELECT lang, list(c ORDER BY i) FILTER (kind = 'chars') AS rc, list(c ORDER BY i) FILTER (kind = 'words') AS rw FROM s GROUP BY lang),
x AS (SELECT h.*, rc, rw FROM h, e WHERE n_words >= {limits.least_words}),
y AS (SELECT doc_id, bool_or({distance("chars", "rc")} <= {limits.chars} AND {distance("words", "rw")} <= {limits.words}) AS near FROM x GROUP BY doc_id),
z AS (SELECT h.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_words < {limits.least_words} OR coalesce(near, false) AS near_ FROM h LEFT JOIN y ON h.doc_id = y.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND near_ AS kept FROM z"""


def statements() -> dict[str, str]:
    return {"op1_topk": TOPK, "op2_mixing": MIXING, "op6_licenses": licenses.scan_sql(), "op7_quality_rules": _quality(), "op11_importance": importance.resample_sql(), "op12_substring_dedup": substring_dedup.removals_sql()}
