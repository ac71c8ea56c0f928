"""The operators against brute force, the public libraries, SQL and held-out labels, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import TABLES, compare
from conftest import SMALL
from quotemill.llm import bpe, components, language_id, licenses, mixing, oracle, quality_model, quality_rules, queries, simhash, suffix_dedup, token_store, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, taken string, fp int, component_id int, doc int, tie int"
LONG = "the quick brown fox jumps over it and the lazy dog of a town " * 4000


def awkward_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    passage = "a passage of well over fifty bytes that several documents of the table share, word by word. "
    texts = [None, "", " ", "x", "The and of to in is.", passage * 3, passage + "one end", "another start " + passage, "ÄÖÜ é 🙂 ~ \x00\x1c  ", LONG, LONG, "\n\n\n", "|||| #### $$$$", passage.upper()]
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", None, "b"][i % 3], None, 1, "t", 2, 3, 4, 5) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[9], (None, passage, "en", "a", 1, 1, "t", 2, 3, 4, 5), (None, None, None, None, None, None, None, None, None, None, None), (6, "same id, another text " + passage, "en", "b", 1, 1, "t", 2, 3, 4, 5)]
    return rows


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    found = db.sql(oracle.statements()[name])
    at = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    assert columns == [found.columns[i] for i in at]
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert got and compare(columns, got, [tuple(r[i] for i in at) for r in found.fetchall()]) == ""


# --- top-k --------------------------------------------------------------------------------------


def best(rows, k, asks):
    vectors = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows]
    out = []
    for q in sorted({i for i, _ in vectors if asks(i)}):
        own = min((v.tolist() for i, v in vectors if i == q))
        scores = sorted((-int(np.dot(own, v)), i) for i, v in vectors if i != q and len(v) == len(own))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_topk_brute_force(spark, block):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.5, 0.0, 0.25, 0.5, 2.0]) for _ in range(4)]) for i in range(300)]
    rows += [(7, [0.5] * 4), (50, [0.25] * 4)]
    bad = [(400, None), (450, [1.0, None, 1.0, 1.0]), (500, [float("nan")] * 4), (550, [float("inf")] * 4), (None, [1.0] * 4), (600, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash")).withColumn("score", F.lit(1))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5, block=block)
    assert table(got, "query_id", "rank", "vec_id", "score") == sorted(best(rows, 5, lambda i: i % 50 == 0), key=repr)


def test_topk_of_many_blocks_keeps_no_queries_in_the_plan(spark):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(-8, 8) / 4 for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 4 == 0, k=3, block=1)
    assert table(got, "query_id", "rank", "vec_id", "score") == sorted(best(rows, 3, lambda i: i % 4 == 0), key=repr)
    assert "MapInArrow" not in got._jdf.queryExecution().toString()


def test_topk_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-3.0])], "vec_id long, embedding array<double>")
    assert table(topk.top_k(df, F.col("vec_id") == 0, k=5), "vec_id", "score") == [(1, 512 * 256), (2, -768 * 256)]
    assert topk.top_k(df.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(df.where("false"), F.col("vec_id") == 0).count() == 0


# --- mixing -------------------------------------------------------------------------------------


def test_mixing_targets_and_reruns(spark, docs):
    got = mixing.mix(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 1
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(7)).collect()))


def test_mixing_reshares(spark):
    rows = [("a", 10), ("b", 1000), ("c", 1000), (None, 10)]
    plan = mixing.budgets(spark.createDataFrame(rows, "source string, source_size long"))
    target = {r["source"]: r["target"] for r in plan.collect()}
    assert target["a"] == 30 and target[None] == 30
    assert target["b"] == pytest.approx(1960 * 2 / 3) and target["c"] == pytest.approx(1960 / 3)


def test_mixing_ranges_follow_the_rows(docs, monkeypatch):
    assert [mixing.range_digits(n) for n in (0, 1 << 28, (1 << 28) + 1, 10**12)] == [2, 2, 3, 5]
    wide = sorted(map(repr, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "range_digits", lambda rows: 4)
    assert sorted(map(repr, mixing.mix(docs).collect())) == wide


def test_mixing_awkward(awkward, empty):
    got = mixing.mix(awkward)
    assert got.count() == len(awkward_rows()) and mixing.mix(empty).count() == 0
    mixed = mixing.repeat_documents(awkward)
    assert mixed.columns == awkward.columns and mixing.repeat_documents(empty).count() == 0
    assert all(r["text"] and r["text"].strip(" \t\n") for r in mixed.collect())


# --- suffix-array dedup -------------------------------------------------------------------------


def cut_brute(rows, length=50):
    first: dict[bytes, int] = {}
    key = lambda d: (1 << 63) - 1 if d is None else d
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w not in first or key(d) < first[w]:
                first[w] = key(d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < key(d):
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


CUT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [False, True])
def test_suffix_dedup_brute_force(docs, texts, monkeypatch, hot):
    if hot:  # every shared anchor counts as frequent
        monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 1)
        monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 0.0)
    assert table(suffix_dedup.removals(docs), *CUT) == cut_brute(texts.items())


def test_suffix_dedup_nested_repeats(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("ab ") for _ in range(400))
    rows = []
    for i in range(60):
        a, b = sorted(rng.sample(range(400), 2))
        rows.append((i, "".join(rng.choice("cd") for _ in range(rng.randrange(30))) + base[a:b] + rng.choice(["", base[:90], "z" * 120])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert table(suffix_dedup.removals(df), *CUT) == cut_brute(rows)


def test_suffix_dedup_awkward(awkward, empty, monkeypatch):
    rows = [(r[0], r[1]) for r in awkward_rows() if r[1] != LONG]
    short = awkward.where(F.coalesce(F.length("text") < 10000, F.lit(True)))
    assert table(suffix_dedup.removals(short), *CUT) == cut_brute(rows)
    assert suffix_dedup.removals(awkward).count() == len(awkward_rows()) and suffix_dedup.removals(empty).count() == 0
    monkeypatch.setattr(suffix_dedup, "STEP", 256)
    assert table(suffix_dedup.removals(short), *CUT) == cut_brute(rows)
    left = suffix_dedup.without_repeats(short)
    assert left.columns == short.columns and suffix_dedup.without_repeats(empty).count() == 0
    # Rows that lost everything go; null and empty texts stay.
    assert left.where("text IS NULL").count() == 2
    assert left.count() == sum(1 for r in cut_brute(rows) if r[2] == 0 or r[2] < r[1])

def test_equal_contexts_are_leaves_of_the_tree():
    """Suffixes of a context that several documents hold form intervals, maximal to the left and to the right."""
    one, two = b"x" + b"ab" * 30, b"y" + b"ab" * 30
    low, high = np.array([3, 5]), np.array([3, 9])
    alone = [tuple(int(x[0]) for x in g) for g in suffix_dedup.repeat_groups([two], low[1:], high[1:], 50)]
    assert alone == [(0, 0, 61, 5)]
    found = {(int(o), int(a), int(b), int(d)) for g in suffix_dedup.repeat_groups([one, two], low, high, 50) for o, a, b, d in zip(*g)}
    assert (1, 0, 61, 5) in found and (1, 1, 61, 3) in found
    assert not any(o == 0 and d == 3 and (a, b) == (0, 61) for o, a, b, d in found)  # nobody repeats the first as a whole


def test_interval_scan_reports_maximal_repeats():
    found = list(suffix_dedup.scan_intervals([60, 55, 55], [4, 2, 9, 1], [97, 97, 98, 97], 50))
    assert found == [(0, 3, 55, 1)]  # the inner pair has one left byte and is part of a longer repeat
    assert (0, 1, 60, 2) in list(suffix_dedup.scan_intervals([60, 55], [4, 2, 9], [-1, 97, 98], 50))


# --- SimHash ------------------------------------------------------------------------------------


def print_brute(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_brute(prints):
    """Pairs of (id, fingerprint) -> id: smallest reachable id."""
    parent = {d: d for d, _ in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 4:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d, _ in prints}


def test_simhash_brute_force(docs, texts):
    prints = [(d, print_brute(t)) for d, t in texts.items()]
    group = groups_brute(prints)
    got = queries.op4_simhash(docs.sparkSession, SMALL)
    assert table(got, "doc_id", "fingerprint", "component_id") == sorted(((d, f"{x:016x}", group[d]) for d, x in prints), key=repr)


@pytest.mark.parametrize("dealt", [1 << 20, 200])
def test_links_of_dense_and_chained_fingerprints(spark, monkeypatch, dealt):
    monkeypatch.setattr(simhash, "DEALT", dealt)
    monkeypatch.setattr(simhash, "PAIRS", 64)
    monkeypatch.setattr(simhash, "LEAVES", 50)
    rng = random.Random(11)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 30)):
            prints.add(x)
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << b
    rows = list(enumerate(sorted(prints, key=lambda x: x * 7919 % 10007)))
    df = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in rows], "node long, fp long")
    reached = {r["node"]: r["component"] for r in components.components(simhash.links(df)).collect()}
    assert {i: reached.get(i, i) for i, _ in rows} == groups_brute(rows)


def test_components_of_paths(spark):
    n = 200
    edges = [(i, i + 1) for i in range(n)] + [(1000 + n - i, 1000 + n - i - 1) for i in range(n)] + [(5000, 5000)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(n + 1)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_awkward(awkward, empty):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(awkward).collect()}
    assert (None, None) in got and {(0, 0), (1, 0), (2, 0), (11, 0), (9, 9), (10, 9)} <= got
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    kept = simhash.keep_one(awkward)
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert kept.columns == awkward.columns and ids[None] == 2 and max(n for i, n in ids.items() if i is not None) == 1
    assert 1 not in ids and 10 not in ids and 0 in ids


def test_keep_one_of_each_group(spark, docs, texts):
    rng = random.Random(5)
    made, words = {}, [f"w{i}" for i in range(5000)]
    for _ in range(6):
        text = rng.choices(words, k=2000)
        for _ in range(8):  # chains of texts that each change a few words of the one before
            made[10_000 + len(made)] = " ".join(text)
            for _ in range(rng.randrange(1, 6)):
                text[rng.randrange(2000)] = rng.choice(words)
    made |= {20_000: "two words", 20_001: "Two  words", 20_002: "", 20_003: None}
    group = groups_brute([(d, print_brute(t)) for d, t in (texts | made).items()])
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(made.items()), "doc_id long, text string"))
    assert [r["doc_id"] for r in simhash.keep_one(df).orderBy("doc_id").collect()] == sorted(d for d in group if group[d] == d)
    assert group[20_001] == 20_000 and group[20_003] == 20_002 and len({group[d] for d in made}) < 40


# --- BPE ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_codec():
    import tiktoken

    with open(queries.vocabulary("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=queries.pattern(), mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(spark, texts, reference_codec):
    got = {r["doc_id"]: r for r in queries.op5_bpe(spark, SMALL).collect()}
    for d, t in texts.items():
        ids = np.array(reference_codec.encode_ordinary(t or ""), "<u4").tobytes()
        want = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert tuple(got[d])[1:] == want


def test_bpe_odd_texts(reference_codec):
    codec = bpe.codec(queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern())
    rng = random.Random(2)
    odd = ["a" * 3000, "ab" * 2000, "=" * 500, " " * 300 + "x", "　\x85\x1c\x1f​", "é" * 500, "🙂👩‍👩‍👧", "12345 ²³ ½", "\r\n\t \n", "don't we'LL"]
    odd += ["".join(rng.choice("abAB01 .\n'éß🙂\t") for _ in range(400)) for _ in range(50)]
    odd += ["".join(chr(c) for c in range(a, a + 256) if not 0xD800 <= c < 0xE000) for a in range(0, 0x3400, 256)]
    for t in odd:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == reference_codec.encode_ordinary(t), t[:40]
        assert codec.decode(ids).decode() == t


def test_bpe_awkward(awkward, empty):
    path, pattern = queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern()
    back = bpe.decode(bpe.encode(awkward, path, pattern), path, pattern)
    assert Counter(bytes(r["raw"]) for r in back.collect()) == Counter((r[1] or "").encode() for r in awkward_rows())
    got = bpe.round_trip(awkward, path, pattern)
    assert got.where("n_tokens = 0").count() == sum(1 for r in awkward_rows() if not r[1]) and bpe.round_trip(empty, path, pattern).count() == 0


# --- licenses -----------------------------------------------------------------------------------


def test_licenses(spark):
    header = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n"
    rows = [(1, header), (2, "Prose. Released under the MIT License. More prose.\nLicensed under CC BY-NC 4.0."), (3, None), (4, ""), (5, "We talk of the MIT License here."), (6, "Released under the MIT License.\nReleased under the MIT License.")]
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][2:] == ("Apache-2.0", 1) and got[1][0].split(" ") == ["apache2-head", "apache2-comply", "apache2-copy"]
    assert got[2] == ("mit-ref ccbync-ref", 2, "CC-BY-NC-4.0,MIT", 2)
    assert got[3] == got[4] == got[5] == ("", 0, "", 0) and got[6] == ("mit-ref mit-ref", 2, "MIT", 1)


def test_licenses_awkward(awkward, empty):
    assert licenses.scan(awkward).count() == len(awkward_rows()) and licenses.scan(empty).count() == 0


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE.""",
    "BSD-3-Clause": """Copyright 2020 Some Body
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above
   copyright notice, this list of conditions and the following disclaimer in
   the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.""",
}


MORE_NOTICES = (
    ("This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin", "Zlib"),
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS", "Apache-2.0"),
    ("This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n\nSPDX-License-Identifier: EPL-2.0", "EPL-2.0"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Library General Public\nLicense as published by the Free Software Foundation; either\nversion 2 of the License, or (at your option) any later version.", "LGPL-2.0-or-later"),
    ("The contents of this file are subject to the terms of the\nCommon Development and Distribution License (the \"License\").\nYou may not use this file except in compliance with the License.", "CDDL-1.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED", "0BSD"),
    ("                       The Artistic License 2.0\n\n           Copyright (c) 2000-2006, The Perl Foundation.", "Artistic-2.0"),
)


def test_licenses_over_several_lines(spark):
    rows, want = [], {}
    for name, text in WRAPPED.items():
        bsd2 = text[: text.index("3. Neither")].rstrip() if name == "BSD-3-Clause" else None
        for form, held in ((name, text), ("BSD-2-Clause", bsd2)):
            for mark in ("", "// ", "# ", " * ", "; ", "-- ") if held else ():
                lines = "\n".join((mark + line).rstrip() for line in held.split("\n"))
                want[len(rows)] = form
                rows.append((len(rows), f"/*\n{lines}\n */\nint x;" if "*" in mark else lines + "\ncode\n"))
    for line, found in (("// SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */", "BSD-3-Clause,GPL-2.0-only"), ("SPDX-License-Identifier: ISC and so on", "ISC"), ("Prose\nreleased under the MIT License\ngoes on", "MIT"), ("permission is\nhereby granted", "")):
        want[len(rows)] = found
        rows.append((len(rows), line))
    for text, found in MORE_NOTICES:
        want[len(rows)] = found
        rows.append((len(rows), text))
    scanned = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["licenses"] for r in scanned} == want
    db = duckdb.connect()
    db.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    odd = [(-1, None), (-2, ""), (-3, "\n\n \n--\n# \n.\nAll rights reserved.\n...\n\n"), (-4, "Licensed under\nCC BY 4.0\n\n\n; Licensed under CC BY-SA 4.0\n(c) 2020 x\nAll rights\nreserved")]
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows + odd)
    scanned += licenses.scan(spark.createDataFrame(odd, "doc_id long, text string")).collect()
    assert sorted(map(tuple, scanned)) == sorted(db.sql(licenses.scan_sql()).fetchall())


def test_licenses_of_many_terms(spark):
    names = [f"LicenseRef-{i}" for i in range(20_000)]
    rows = [(1, "// SPDX-License-Identifier: " + " AND ".join(names)), (2, "SPDX-License-Identifier: " + "MIT OR " * 20_000 + "ISC"), (3, "SPDX-License-Identifier: " + "(" * 50_000), (4, "SPDX-License-Identifier:" + " \t" * 50_000)]
    rows += [(5, "Copyright " * 5_000), (6, "; " * 50_000), (7, "\n.." * 50_000), (8, "released under the mit license\n" * 5_000)]
    got = {r["doc_id"]: r["n_licenses"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 20_000, 2: 2, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 1}


def test_bpe_memory_of_a_worker_ages():
    with open(queries.vocabulary("byte_bpe_50k.tiktoken"), "rb") as file:
        codec = bpe.Codec(bpe.read_ranks(file.read()), queries.pattern())
    want = codec.encode("some words met again, others once")
    codec.known.age()
    assert not codec.known and codec.encode("some words met again, others once") == want
    codec.known.age()
    codec.encode("some")
    codec.known.age()
    assert set(codec.known.older) == {"some"} and codec.encode("some words met again, others once") == want


# --- quality rules ------------------------------------------------------------------------------


def test_quality_base_counts_awkward(awkward, empty):
    def base(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        held = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(held)

    got = quality_rules.judge(awkward)
    want = sorted((r[0], *base(r[1])) for r in awkward_rows() if r[0] is not None)
    assert sorted(tuple(r)[:6] for r in got.where("doc_id IS NOT NULL").collect()) == want
    assert quality_rules.judge(empty).count() == 0


def test_quality_rules_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_rules.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").where("NOT base_failed")
    rate = {r["quality"]: r["r"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("r")).collect()}
    assert rate[1] >= 0.99 and rate[0] <= 0.25


def test_quality_rules_are_native(docs):
    plan = quality_rules.counts(docs, ["the", "und"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_common_words_by_brute_force(spark, docs, awkward, empty):
    def want(rows, limits):
        by_lang = {}
        for lang, text in rows:
            if lang is not None:
                words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
                by_lang.setdefault(lang, Counter()).update(w.strip(quality_rules.PUNCTUATION_PLAIN).lower() for w in words)
        out = set()
        for seen in by_lang.values():
            if sum(seen.values()) >= limits.least_reference:
                lettered = sorted((-n, w.encode(), w) for w, n in seen.items() if re.search(r"[^\W\d_]", w))
                out.update(w for *_, w in lettered[: limits.common])
        return sorted(out)

    for frame, limits in ((docs, quality_rules.DEFAULT), (awkward, quality_rules.Limits(least_reference=1, common=3)), (empty, quality_rules.DEFAULT)):
        rows = [(r["lang"], r["text"]) for r in frame.select("lang", "text").collect()]
        assert quality_rules.common_words(frame, limits) == want(rows, limits)


def test_quality_learns_words_of_any_language(spark):
    """Two languages that no list knows; only their usual mix of words passes."""
    few = {"xa": ["bo", "ki", "lun", "zéta"], "xb": ["ur", "mip", "tek", "oja"]}
    rng = np.random.default_rng(5)

    def text(lang):
        words = rng.choice(few[lang], 60, p=[0.4, 0.3, 0.2, 0.1])
        return " ".join(w if i % 2 else "".join(rng.choice(list("abcdefghij"), 5)) for i, w in enumerate(words))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["xa", "xb"] * 40)]
    bad = [(1000, " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(60)), None), (1001, " ".join(["bo"] * 30 + [f"x{i}" for i in range(30)]), None)]
    frame = spark.createDataFrame(rows + bad, "doc_id long, text string, lang string")
    assert quality_rules.common_words(frame, quality_rules.Limits(common=4)) == sorted(few["xa"] + few["xb"])
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(frame, quality_rules.Limits(common=4)).collect()}
    assert {i for i, kept in got.items() if not kept} == {1000, 1001}
    none = quality_rules.judge(frame.withColumn("lang", F.lit(None).cast("string")))
    assert all(r["kept"] != r["base_failed"] for r in none.collect())


# --- token store --------------------------------------------------------------------------------


def ids_of(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    return [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_token_store_equals_library(spark, texts):
    got = [tuple(r) for r in queries.op8_token_store(spark, SMALL).orderBy("doc_id").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    order, start, want = sorted(texts), 0, []
    for d, ids in zip(order, ids_of([texts[d] or "" for d in order])):
        want.append((d, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_token_store_odd_words():
    encoder = token_store.Encoder(queries.vocabulary("word_bpe_49k.json"), 2, np.uint16)
    rng = random.Random(8)
    odd = ["a<|endoftext|>b <|startoftext|>", "é ́x \x1c\x1d a\x85b　c d", "ΑΣ ΑΣΑ İI", "don't it's", "\x0b\x0cx", "🙂a1²½", "a\x01b \x01 c\x01"]
    odd += ["".join(rng.choice("abZ01 .\n'éßΣ́🙂\x1c <|>") for _ in range(200)) for _ in range(50)]
    odd += ["<|EndOfText|>", "É'S À'LL ÀÖØÞ'Re ÿŸ ''ss _a_ 12½ µ×÷ªº ﬁ1", "'", "日本 語'S"]
    for t in odd:
        assert np.frombuffer(encoder.encode(t.encode()), np.uint16).tolist() == ids_of([t])[0], t[:40]


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 513, 3000):
        ids = rng.integers(0, 40, n).astype(np.uint16)
        w = token_store.WaveletMatrix.build(ids, 6)
        assert w.decode().tolist() == ids.tolist()
        for i in rng.integers(0, n, min(n, 40)):
            assert w.access(int(i)) == ids[i]
        for v in range(0, 42, 5):
            at = np.flatnonzero(ids == v)
            assert w.count(v) == len(at) and w.rank(v, n // 2) == (ids[: n // 2] == v).sum()
            assert [w.select(v, k) for k in range(min(5, len(at)))] == at[:5].tolist() and w.select(v, len(at)) == -1


def test_token_store_awkward(awkward, empty, monkeypatch):
    path = queries.vocabulary("word_bpe_49k.json")
    got = token_store.store_and_read(awkward, path).collect()
    assert len(got) == len(awkward_rows()) and sum(r["n_tokens"] == 1 for r in got) >= 4
    spans = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    assert token_store.store_and_read(empty, path).count() == 0


# --- classifiers --------------------------------------------------------------------------------


def test_quality_model_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op9_quality_model(spark, sf).join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in got if r["quality"] == 1]
    bad = [r["score"] for r in got if r["quality"] == 0]
    area = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    right = np.mean([r["predicted"] == r["quality"] for r in got])
    assert area > 0.95 and right > 0.95, (area, right)


def test_quality_model_awkward(spark, awkward, empty):
    model = quality_model.train([(*quality_model.bag(t, quality_model.DEFAULT), c) for t, c in [(b"good words here", 1), (b"### bad &&&", 0), (b"", 0)]] * 20)
    got = quality_model.score(awkward, model).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_model.score(empty, model).count() == 0
    none = quality_model.train([])
    assert {r["score"] for r in quality_model.score(awkward, none).collect()} == {0.5}
    labels = spark.createDataFrame([(6, 1), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id long, quality int")
    assert {c for *_, c in quality_model.sample(awkward, labels)} == {0, 1}
    assert quality_model.sample(empty, labels) == [] == quality_model.sample(awkward, labels.where("false"))


def test_quality_sample_takes_whole_texts(spark):
    rows = [(i, "plain words " * 2000 + f"last{i}") for i in range(30)] + [(30, None), (31, "a a")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(32)], "doc_id long, quality int")
    settings = quality_model.Settings(docs_per_class=12)
    found = quality_model.sample(spark.createDataFrame(rows, "doc_id long, text string"), labels, settings)
    assert Counter(c for *_, c in found) == {0: 12, 1: 12}
    bags = {(tuple(a.tolist()), tuple(b.tolist())) for a, b in (quality_model.bag((t or "").encode(), settings) for _, t in rows)}
    assert all((tuple(a.tolist()), tuple(b.tolist())) in bags for a, b, _ in found)
    ids, times = quality_model.bag(b"a a", settings)
    assert times.sum() == 2 * len(quality_model.features(b"a", settings)) + 1 and quality_model.repeat_mark(settings) in ids


def test_quality_model_against_plain_loops():
    """The same descent with one number at a time, and a text's score as softmax of the mean of its features' vectors."""
    settings = quality_model.Settings(buckets=64, dim=3, epochs=2)
    texts = [(b"a bb ccc", 1), (b"dd dd e", 0), (b"bb bb bb f", 1), (b"gg a", 0), (b"hh ii jj a", 0)]
    model = quality_model.train([(*quality_model.bag(t, settings), c) for t, c in texts], settings)
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1 / 3, 1 / 3, (64, 3)).astype(np.float32).astype(float).tolist()
    out, shift = [[0.0, 0.0] for _ in range(3)], [0.0, 0.0]
    share_of_ones = sum(c for _, c in texts) / len(texts)
    weigh = [0.5 / (1 - share_of_ones), 0.5 / share_of_ones]

    def mean(raw):
        words = raw.split()
        marks = [f for w in words for f in quality_model.features(w, settings)] + [quality_model.repeat_mark(settings) for a, b in zip(words, words[1:]) if a == b]
        return {f: n / len(marks) for f, n in Counter(marks).items()}

    def odds(share):
        hidden = [sum(s * vectors[f][k] for f, s in share.items()) for k in range(3)]
        logit = [sum(hidden[k] * out[k][c] for k in range(3)) + shift[c] for c in (0, 1)]
        return hidden, 1 / (1 + np.exp(logit[0] - logit[1]))

    done = 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(texts)):
            rate = settings.rate * (1 - done / (settings.epochs * len(texts)))
            done += 1
            raw, c = texts[i]
            share = mean(raw)
            hidden, one = odds(share)
            step = [rate * weigh[c] * ((k == c) - p) for k, p in ((0, 1 - one), (1, one))]
            back = [out[k][0] * step[0] + out[k][1] * step[1] for k in range(3)]
            norm = sum(s * s for s in share.values())
            for k in range(3):
                for d in (0, 1):
                    out[k][d] += hidden[k] * step[d]
            for d in (0, 1):
                shift[d] += 0.1 * step[d]
            for f, s in share.items():
                for k in range(3):
                    vectors[f][k] += s / norm * back[k]
    known = quality_model._Known(model)
    for raw, _ in texts:
        assert quality_model.score_text(raw, known, model.bias) == pytest.approx(odds(mean(raw))[1], abs=1e-4)


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op10_language_id(spark, sf).join(docs, "doc_id").where("held_out").collect()
    right = np.mean([r["lang_pred"] == r["lang"] for r in got])
    assert right > 0.97, right
    assert np.mean([r["rejected"] for r in got]) < 0.01


def language_brute(raw, dictionaries):
    """(language, rejected) with one compressor call per piece and language."""
    import zstandard

    text = (raw or b"").decode()
    if not any(c.isalpha() for c in text):
        return "und", True
    words = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text.lower()).encode().split()
    raw = b" ".join(words)

    def size(lang, part):
        held = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=9)
        return len(zstandard.ZstdCompressor(level=9, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress(part)) - 9  # bytes of an empty frame

    step = max(1, -(-len(raw) // max(2, -(-len(raw) // 4096))))
    pieces = [raw[i : i + step] for i in range(0, len(raw), step)]
    sizes = {lang: [size(lang, p) for p in pieces] for lang in dictionaries}
    total = {lang: sum(s) for lang, s in sizes.items()}
    best = min(total.values())
    mixed = best - sum(min(s) for s in zip(*sizes.values())) > 0.04 * best
    if list(total.values()).count(best) > 1:
        total = {lang: sum(size(lang, b" ".join(words[i:])) for i in sorted({j * len(words) // 64 for j in range(64)})) for lang in dictionaries}
    first, second = sorted(total.values())[:2]
    return min(sorted(total), key=total.get), mixed or 1 - first / second < 0.04


def test_language_brute_force(docs, awkward):
    dictionaries = language_id.fit(docs)
    sizer = language_id.Sizer(dictionaries, language_id.DEFAULT)
    texts = [r["text"].encode() for r in docs.orderBy("doc_id").limit(60).collect()] + [None if r["text"] is None else r["text"].encode() for r in awkward.where("length(text) < 9000 OR text IS NULL").collect()]
    texts += ["a b c".encode(), "je suis ici".encode(), b"the the", "der Hund und the dog".encode()]
    for raw in texts:
        name, _, rejected = sizer.judge(raw)
        assert (name, rejected) == language_brute(raw, dictionaries), raw


def test_language_fit_reads_whole_texts(spark):
    long = "".join(chr(97 + i // 10_000) for i in range(100_000))
    rows = [(1, long, "xx"), (2, long, "xx"), (3, "short text", "xx"), (4, "other", None), (5, None, "xx"), (6, " ", "xx")]
    fitted = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(fitted) == {"xx"} and b"short text" in fitted["xx"]
    parts = fitted["xx"].replace(b"short text", b"").split()
    assert len(parts) == 8 and parts[0] == b"a" * 512 and parts[-1] == b"j" * 512 and len({p[:1] for p in parts}) == 8
    small = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), language_id.Settings(dictionary_bytes=100))
    assert len(small["xx"]) == 100


def test_language_awkward(awkward, empty, docs):
    dictionaries = language_id.fit(docs)
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.predict(awkward, dictionaries).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (11, "und"), (12, "und"), (9, "en")} <= got
    assert language_id.predict(empty, dictionaries).count() == 0 and language_id.fit(empty) == {}
    assert {r["lang_pred"] for r in language_id.predict(awkward, {}).collect()} == {"und"}
    kept = language_id.keep_identified(awkward, dictionaries)
    assert kept.columns == awkward.columns and language_id.keep_identified(empty, dictionaries).count() == 0


def test_language_rejects_mixed_shuffled_and_unknown(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in table.where(queries.held_out(4, 2)).orderBy("doc_id").collect() if len(r["text"]) > 300]
    sizer = language_id.Sizer(language_id.fit(table.where(~queries.held_out(4, 2))), language_id.DEFAULT)
    rejected = lambda texts: np.mean([sizer.judge(t.encode())[2] for t in texts])
    rng = random.Random(3)
    english, german = ([r["text"].split() for r in rows if r["lang"] == lang] for lang in ("en", "de"))
    mixed = [" ".join(a[:n] + b[:n]) for n in (10, 20, 150) for a, b in zip(english, german) if len(a) >= n <= len(b)]
    shuffled = ["".join(rng.sample(r["text"][:3000], min(3000, len(r["text"])))) for r in rows[:100]]
    unknown = [
        "Il gatto dorme sul tavolo della cucina mentre la pioggia cade lentamente sui tetti della città.",
        "Suomen kielen sanat ovat usein pitkiä ja taivutusmuotoja on paljon, joten lukeminen vaatii harjoitusta.",
    ]
    assert rejected(mixed) > 0.8 and rejected(shuffled) > 0.9 and rejected(unknown) == 1
    assert rejected([r["text"] for r in rows]) < 0.01


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline_brute_force(spark, docs, reference_codec):
    """Each stage anew in plain Python, on what the stage before kept."""
    rows = [r.asDict() for r in docs.collect()]
    got = table(corpus_pipeline.run(spark, SMALL), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    dictionaries = language_id.fit(docs)
    rows = [r for r in rows if not language_brute(r["text"].encode(), dictionaries)[1]]
    group = groups_brute([(r["doc_id"], print_brute(r["text"])) for r in rows])
    rows = [r for r in rows if group[r["doc_id"]] == r["doc_id"]]
    first: dict[bytes, int] = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        raw = r["text"].encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], r["doc_id"])
    kept = []
    for r in rows:
        raw = r["text"].encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < r["doc_id"]:
                gone[i : i + 50] = b"\1" * 50
        if sum(gone) < len(raw) or not raw:
            kept.append({**r, "text": bytes(c for c, g in zip(raw, gone) if not g).decode(errors="ignore")})
    sized = [(r, len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))) for r in kept]
    sums = Counter()
    for r, n in sized:
        sums[r["source"]] += n
    names = sorted(sums)
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    full: set = set()
    while True:
        level = (sum(sums.values()) - sum(3.0 * sums[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and level * weight[s] > 3.0 * sums[s]}
        if not over:
            break
        full |= over
    want = []
    for s in names:
        budget = 3 * sums[s] if s in full else min(round(level * weight[s]), 3 * sums[s])
        own = [(hashlib.md5(f"mix:{r['doc_id']}:{hashlib.md5(r['text'].encode()).hexdigest()}".encode()).hexdigest(), r, n) for r, n in sized if r["source"] == s]
        left = budget % sums[s]
        for _, r, n in sorted(own, key=lambda x: x[0]):
            taken = budget // sums[s] * n + max(0, min(n, left))
            left -= n
            if n:
                ids = np.array(reference_codec.encode_ordinary(r["text"]), "<u4").tobytes()
                want += [(r["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())] * int(taken / n + 0.5)
    assert got == sorted(want, key=repr)


def test_pipeline_stages_on_awkward_and_empty_tables(spark, awkward, empty):
    for start in (awkward, empty):
        held = start
        for name, stage in corpus_pipeline.STAGES:
            held = corpus_pipeline.pinned(stage(spark, held, SMALL), "test-stage")
            if name != "byte_bpe":
                assert held.columns == start.columns
