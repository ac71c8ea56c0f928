"""License scans by sentence rules.

A text is cut into sentences. Each is normalised (lower case, runs of other characters than letters and digits
become one space) and looked up among known license sentences. The sequence of identifiers found is matched against
ordered rules: a rule holds if its identifiers stand next to each other in the sequence, and an identifier that an
earlier rule has used counts no more for a later one. Everything is SQL on built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

#: Known license sentences, normalised, with their identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "this project is licensed under the mit license": "mit-ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "licensed under the apache license version 2 0": "apache2-ref",
    "licensed under the apache license version 2 0 the license": "apache2-head",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-copy",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-head",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-head",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-head",
    "this is free and unencumbered software released into the public domain": "unlicense-head",
    "licensed under cc by 4 0": "ccby-ref",
    "licensed under cc by sa 4 0": "ccbysa-ref",
    "licensed under cc by nc 4 0": "ccbync-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby-ref",
    "all rights reserved": "reserved",
}

#: Ordered rules, the longest and most specific first.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache2-head", "apache2-comply", "apache2-copy")),
    ("GPL-3.0-or-later", ("gpl3-head", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-head", "gpl-warranty")),
    ("ISC", ("isc-grant", "mit-warranty")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-head",)),
    ("Unlicense", ("unlicense-head",)),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache2-ref",)),
    ("Apache-2.0", ("apache2-head",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL-3.0-or-later", ("gpl3-head",)),
    ("GPL-2.0-or-later", ("gpl2-head",)),
    ("CC-BY-4.0", ("ccby-ref",)),
    ("CC-BY-SA-4.0", ("ccbysa-ref",)),
    ("CC-BY-NC-4.0", ("ccbync-ref",)),
)

_GPL = "you can redistribute it and or modify it under the terms of the gnu {}general public license "
_FSF = "as published by the free software foundation"
#: Known besides: parts of published notices, as colons and semicolons cut them, and further licenses.
MORE_SENTENCES = {
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "neither the name of the copyright holders nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-warranty",
    "distributed under the boost software license version 1 0": "bsl1-head",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed": "wtfpl-head",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "apache license": "apache-title",
    "version 2 0 january 2004": "apache2-date",
    "apache license version 2 0 january 2004": "apache2-title",
    "apache license version 2 0 january 2004 http www apache org licenses": "apache2-title",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2-head",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at http www eclipse org legal epl 2 0": "epl2-head",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0 which accompanies this distribution and is available at https www eclipse org legal epl v20 html": "epl2-head",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "epl1-head",
    "the contents of this file are subject to the terms of the common development and distribution license the license": "cddl-head",
    "the artistic license 2 0": "artistic2-title",
    "this is free software you can redistribute it and or modify it under the same terms as the perl 5 programming language system itself": "perl-head",
    "this program is free software you can redistribute it and or modify it under the terms of the artistic license 2 0": "artistic2-head",
    "you can redistribute it and or modify it under the terms of the artistic license 2 0": "artistic2-head",
    **{f"{_GPL.format(kind)}{_FSF}": f"{name}-terms" for kind, name in (("", "gpl"), ("lesser ", "lgpl"), ("affero ", "agpl"), ("library ", "lgpl20"))},
    **{
        f"{_GPL.format(kind)}{_FSF} either version {number} of the license or at your option any later version": f"{name}{mark}-head"
        for kind, name, number, mark in (("", "gpl", "2", "2"), ("", "gpl", "3", "3"), ("lesser ", "lgpl", "2 1", "21"), ("lesser ", "lgpl", "3", "3"), ("affero ", "agpl", "3", "3"), ("library ", "lgpl20", "2", ""))
    },
    **{f"either version {number} of the license or at your option any later version": f"later{mark}" for number, mark in (("2", "2"), ("2 1", "21"), ("3", "3"))},
    f"{_GPL.format('')}version 2 {_FSF}": "gpl2-only",
}

#: Rules on these, after the fixed ones.
MORE_RULES = (
    ("GPL-2.0-or-later", ("gpl-terms", "later2")),
    ("GPL-3.0-or-later", ("gpl-terms", "later3")),
    ("LGPL-2.1-or-later", ("lgpl-terms", "later21")),
    ("LGPL-3.0-or-later", ("lgpl-terms", "later3")),
    ("AGPL-3.0-or-later", ("agpl-terms", "later3")),
    ("LGPL-2.1-or-later", ("lgpl21-head",)),
    ("LGPL-3.0-or-later", ("lgpl3-head",)),
    ("AGPL-3.0-or-later", ("agpl3-head",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("LGPL-2.0-or-later", ("lgpl20-terms", "later2")),
    ("LGPL-2.0-or-later", ("lgpl20-head",)),
    ("BSL-1.0", ("bsl1-head",)),
    ("0BSD", ("0bsd-grant",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("Apache-2.0", ("apache-title", "apache2-date")),
    ("Apache-2.0", ("apache2-title",)),
    ("EPL-2.0", ("epl2-head",)),
    ("EPL-1.0", ("epl1-head",)),
    ("CDDL-1.0", ("cddl-head",)),
    ("Artistic-2.0", ("artistic2-title",)),
    ("Artistic-2.0", ("artistic2-head",)),
    ("Artistic-1.0-Perl", ("perl-head",)),
    ("WTFPL", ("wtfpl-head",)),
)

#: Where a sentence over several lines ends: at a full stop and the like before white space, or at a line without words.
END = r"[.!?:;]+[\x20\x09-\x0D]+|\n[^\p{L}\p{N}\n]*(?=\n)"
#: Comment marks that would end a sentence, or are words; a line of copyright and year, which stands alone.
COMMENT = r"(?imd)^[\x20\t]*(?:;+|dnl|rem)[\x20\t]+"
COPYRIGHT = r"(?imd)^([^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*)$"
#: An SPDX line's expression, the exceptions in it, and its identifiers. The group's loop is possessive (`*+`): a plain one
#: takes a stack frame per term, and an expression of a thousand terms would end the executor.
SPDX = r"SPDX-License-Identifier:[\x20\t]*([(]*[A-Za-z0-9.+-]+[)]*(?:[\x20\t]+(?:AND|OR|WITH)[\x20\t]+[(]*[A-Za-z0-9.+-]+[)]*)*+)"
EXCEPTION = r"[\x20\t]+WITH[\x20\t]+[A-Za-z0-9.+-]+"
IDENTIFIER = r"[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"
BARE = r"[^\p{L}\p{N}]+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), BARE, " "))


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES | MORE_SENTENCES, rules: tuple = RULES + MORE_RULES) -> DataFrame:
    """doc_id, sentence_ids (in text order, one blank between), n_sentences, licenses (sorted, distinct, comma-
    separated), n_licenses; one row per input row.

    Texts without a known sentence, null and empty texts have empty strings and zeros. Repeated sentences count each
    time; repeated rows give equal results; an empty table gives no rows. A rule's match is taken out of the sequence
    wherever it occurs, and leaves a mark, so that what stood around it does not become neighbours.

    A sentence may go over several lines, with or without comment marks before them. Where the whole is not known, each
    of its lines is looked up. Identifiers of SPDX lines count as licenses, not as sentences.
    """
    rows = documents(docs)
    text = F.coalesce("text", F.lit(""))
    whole = F.split(F.regexp_replace(F.regexp_replace(text, COMMENT, ""), COPYRIGHT, "\n$1\n\n"), END)

    def looked_up(sentence: Column) -> Column:
        bare = normalised(sentence)
        by_line = F.when(F.contains(sentence, F.lit("\n")), F.transform(F.split(sentence, "\n"), normalised))
        return F.when(bare.isin(list(sentences)), F.array(bare)).otherwise(by_line)

    parts = F.flatten(F.array_compact(F.transform(whole, looked_up)))
    known = F.filter(parts, lambda s: s.isin(list(sentences)))
    spdx = F.flatten(F.transform(F.regexp_extract_all("text", F.lit(SPDX), 1), lambda e: F.regexp_extract_all(F.regexp_replace(e, EXCEPTION, ""), F.lit(IDENTIFIER), 0)))
    spdx = F.coalesce(F.filter(spdx, lambda s: ~s.isin("AND", "OR")), F.array().cast("array<string>"))
    names = F.lit(list(sentences.values()))
    of = F.transform(known, lambda s: F.element_at(names, F.array_position(F.lit(list(sentences)), s).cast("int")))
    found = rows.select("doc_id", of.alias("ids"), spdx.alias("spdx"))
    told = found.select("doc_id", "spdx", F.array_join("ids", " ").alias("sentence_ids"), F.size("ids").cast("long").alias("n_sentences"), F.concat(F.lit(" "), F.array_join("ids", "  "), F.lit(" ")).alias("left"))
    licenses = []
    for i, (name, rule) in enumerate(rules):
        sought = "".join(f" {r} " for r in rule)
        told = told.withColumn(f"rule{i}", F.instr("left", sought) > 0).withColumn("left", F.replace("left", F.lit(sought), F.lit(" . ")))
        licenses.append(F.when(F.col(f"rule{i}"), F.lit(name)))
    held = F.array_sort(F.array_distinct(F.concat(F.array_compact(F.array(*licenses)), "spdx")))
    return told.select("doc_id", "sentence_ids", "n_sentences", F.array_join(held, ",").alias("licenses"), F.size(held).cast("long").alias("n_licenses"))


def scan_sql() -> str:
    """The same in SQL. Its patterns have no lookahead, so a sentence's end takes blank lines with it; and no possessive loops."""
    known, rules = SENTENCES | MORE_SENTENCES, RULES + MORE_RULES
    end = r"[.!?:;]+[\x20\x09-\x0D]+|\n(?:[^\p{L}\p{N}\n]*\n)+"
    comment, copyright_ = (p.replace("(?imd)", "(?im)") for p in (COMMENT, COPYRIGHT))
    keys = ", ".join(f"'{s}'" for s in known)
    values = ", ".join(f"'{v}'" for v in known.values())

    def bare(of: str) -> str:
        return f"trim(regexp_replace(lower({of}), '{BARE}', ' ', 'g'))"

    steps, last = [], "found"
    for i, (name, rule) in enumerate(rules):
        sought = "".join(f" {r} " for r in rule)
        steps.append(f"r{i} AS (SELECT doc_id, ids, replace(gone, '{sought}', ' . ') AS gone, CASE WHEN contains(gone, '{sought}') THEN list_append(names, '{name}') ELSE names END AS names FROM {last})")
        last = f"r{i}"
    return f"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, string_split_regex(regexp_replace(regexp_replace(coalesce(text, ''), '{comment}', '', 'g'),
         '{copyright_}', chr(10) || '\\1' || chr(10) || chr(10), 'g'), '{end}') AS whole FROM documents),
parts AS (SELECT doc_id, text, flatten(list_transform(whole, lambda s: CASE WHEN list_contains([{keys}], {bare("s")}) THEN [{bare("s")}]
         WHEN contains(s, chr(10)) THEN list_transform(string_split(s, chr(10)), lambda l: {bare("l")}) ELSE CAST([] AS VARCHAR[]) END)) AS parts FROM split),
named AS (SELECT doc_id, list_filter(list_transform(parts, lambda s: [{values}][list_position([{keys}], s)]), lambda x: x IS NOT NULL) AS ids,
         list_filter(flatten(list_transform(regexp_extract_all(text, '{SPDX.replace("*+)", "*)")}', 1),
             lambda e: regexp_extract_all(regexp_replace(e, '{EXCEPTION}', '', 'g'), '{IDENTIFIER}'))), lambda x: x NOT IN ('AND', 'OR')) AS spdx FROM parts),
found AS (SELECT doc_id, ids, ' ' || array_to_string(ids, '  ') || ' ' AS gone, spdx AS names FROM named),
{", ".join(steps)}
SELECT doc_id, array_to_string(ids, ' ') AS sentence_ids, len(ids) AS n_sentences,
       array_to_string(list_sort(list_distinct(names)), ',') AS licenses, len(list_distinct(names)) AS n_licenses
FROM {last}"""
