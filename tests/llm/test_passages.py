"""Importance resampling, passages found by FM-index, and periodic runs: against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from math import floor, log
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from quotemill.llm import fm_index, importance, periodic_runs, queries, substring_dedup
from test_llm import awkward, awkward_rows, docs, empty, table  # noqa: F401

# --- importance resampling ----------------------------------------------------------------------


def resample_brute(rows, target, grams=1, buckets=10_000, least=20, percent=10, seed=2024):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
        return len(words), [crc32(r.encode()) % buckets for r in runs]

    own = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for *_, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [floor(1000 * log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for d, n, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(f), weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = Counter()
    ranks = {}
    for place, r in enumerate(able[: len(able) * percent // 100]):
        ranks.setdefault(r, []).append(place + 1)
    full = []
    for r in out:
        held = ranks.get(r)
        full.append((r[0], *r[2:], held[drawn[r]] if held and drawn[r] < len(held) else None))
        drawn[r] += 1
    return sorted(full, key=repr)


RANKED = ("doc_id", "n_features", "weight", "score", "rank")


def test_resampling_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert table(queries.op11_importance(spark, SMALL), *RANKED) == resample_brute(rows, target)


@pytest.mark.parametrize("grams, buckets, percent", [(2, 97, 50), (3, 10_000, 100), (1, 64, 0)])
def test_resampling_of_longer_features(spark, grams, buckets, percent):
    rng = random.Random(2)
    rows = [(i % 90, " ".join(rng.choice("a b cc é ÄB x-y 7".split()) for _ in range(rng.randrange(60)))) for i in range(100)] + [(None, "a b " * 30), (None, None)]
    target = ["a b cc", "", None, "é é"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), grams, buckets, 20, percent)
    assert table(got, *RANKED) == resample_brute(rows, target, grams, buckets, 20, percent)


def test_sliced_sums_are_exact():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 1 << 20, (7, 1000)) * (rng.random((7, 1000)) < 0.2)
    gains = rng.integers(-30_000, 30_000, 1000)
    up, down = (importance.bit_planes(np.maximum(side, 0)[None, :])[:, 0] for side in (gains, -gains))
    assert (importance.sliced_sums(importance.bit_planes(counts), up, down) == counts @ gains).all()
    assert importance.bit_planes(np.zeros((3, 5), np.int64)).shape == (0, 3, 1)


def test_resampling_awkward(spark, awkward, empty):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = importance.resample(awkward, awkward, percent=100)
    assert table(got, *RANKED) == resample_brute(rows, [t for _, t in rows], percent=100)
    none = importance.resample(awkward, empty, percent=30)
    assert table(none, *RANKED) == resample_brute(rows, [], percent=30)
    assert importance.resample(empty, awkward).count() == 0
    kept = importance.drawn(awkward, awkward, percent=100)
    assert kept.columns == awkward.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got.where("rank IS NOT NULL").collect()}
    assert importance.drawn(empty, awkward).count() == 0


def test_resampling_draws_what_resembles_the_target(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["apple", "pear", "plum"] if i % 5 == 0 else ["bolt", "nut", "gear"], k=30))) for i in range(1000)]
    target = spark.createDataFrame([("apple pear plum " * 50,)], "text string")
    got = importance.resample(spark.createDataFrame(rows, "doc_id long, text string"), target).where("rank IS NOT NULL").collect()
    assert len(got) == 100 and sorted(r["rank"] for r in got) == list(range(1, 101))
    assert np.mean([r["doc_id"] % 5 == 0 for r in got]) > 0.6  # one in five without weights


# --- passages -----------------------------------------------------------------------------------


def cut_brute(rows, window=13):
    key = lambda d: (1 << 63) - 1 if d is None else d
    first: dict[tuple, int] = {}
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, key(d)), key(d))
    out = []
    for d, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < key(d):
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((d, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


CUT = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_wavelet_tree_counts():
    rng = np.random.default_rng(4)
    for sigma in (1, 2, 3, 100):
        symbols = rng.integers(0, sigma, 500)
        tree = fm_index.WaveletTree(symbols, sigma)
        for c in range(min(sigma, 5)):
            at = np.array([0, 1, 63, 64, 65, 499, 500])
            assert tree.rank(np.full(7, c), at).tolist() == [(symbols[:i] == c).sum() for i in at]


def test_fm_index_finds_all_occurrences():
    rng = np.random.default_rng(5)
    text = np.concatenate([rng.integers(1, 4, 300), [0]])
    index = fm_index.FMIndex(text, 4, 8)
    twice = np.concatenate([text, text])
    for _ in range(50):
        pattern = rng.integers(1, 4, rng.integers(1, 9))
        low, high = np.array([0]), np.array([len(text)])
        for c in pattern[::-1]:
            low, high = index.extend(np.array([c]), low, high)
        want = {i for i in range(len(text)) if (twice[i : i + len(pattern)] == pattern).all()}
        assert set(index.order[low[0] : high[0]].tolist()) == want
    group, first = index.prefix_groups(5)
    names = [tuple(twice[i : i + 5]) for i in index.order]
    assert [names[i] != names[i - 1] for i in range(1, len(names))] == (np.diff(group) == 1).tolist() and first[-1] == len(text)


@pytest.mark.parametrize("seed", range(6))
def test_lost_spans_brute_force(seed):
    rng = random.Random(seed)
    contexts = sorted({" ".join(rng.choices("ab", k=rng.randrange(3, 9))).encode() for _ in range(40)})
    low = np.array([rng.randrange(20) for _ in contexts])
    high = low + np.array([rng.choice([0, 0, 5]) for _ in contexts])
    got = {}
    for c, a, b, least in zip(*(x.tolist() for x in substring_dedup.lost_spans(contexts, low, high, 3))):
        for i in range(a, b - 2):
            assert (c, i) not in got
            got[c, i] = least
    first = {}
    for c, name in enumerate(contexts):
        words = name.split()
        for i in range(len(words) - 2):
            first[tuple(words[i : i + 3])] = min(first.get(tuple(words[i : i + 3]), 99), low[c])
    want = {(c, i): first[tuple(n.split()[i : i + 3])] for c, n in enumerate(contexts) for i in range(len(n.split()) - 2)}
    assert got == {(c, i): v for (c, i), v in want.items() if high[c] > v}


@pytest.mark.parametrize("often", [1 << 30, 2])
def test_passages_brute_force(spark, docs, monkeypatch, often):
    monkeypatch.setattr(substring_dedup, "OFTEN", often)
    monkeypatch.setattr(substring_dedup, "HELD", 500)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = queries.op12_substring_dedup(spark, SMALL)
    assert table(got, *CUT) == cut_brute(rows)


@pytest.mark.parametrize("window, gram", [(13, 5), (3, 1), (4, 4), (2, 1)])
def test_passages_of_few_words(spark, window, gram):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randrange(60)))) for i in range(60)] + [(5, "a b c a"), (None, "a b a b a b"), (None, None)]
    got = substring_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string"), window, gram)
    assert table(got, *CUT) == cut_brute(rows, window)


def test_passages_awkward(awkward, empty):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = substring_dedup.removals(awkward)
    assert table(got, *CUT) == cut_brute(rows)
    for r in got.collect():
        assert sum(s["end"] - s["first"] for s in r["spans"]) == r["n_removed"] and hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
    assert substring_dedup.removals(empty).count() == 0


# --- periodic runs ------------------------------------------------------------------------------


def runs_brute(words, least=12):
    ids = np.array([hash(w) for w in words])
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        starts, ends = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(~same[1:] & same[:-1])
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a + q >= max(least, 2 * q):
                found.setdefault((a, b + q), q)
    return sorted((a, e - a, q) for (a, e), q in found.items())


def told_brute(doc, text, least=12):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = runs_brute(words, least)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


RUN = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_brute_force(spark, docs):
    got = queries.op13_periodic_runs(spark, SMALL)
    want = [told_brute(r["doc_id"], r["text"]) for r in docs.collect()]
    assert table(got, *RUN) == sorted(want, key=repr) and sum(w[1] for w in want) > 20


@pytest.mark.parametrize("least", [12, 13, 5, 2])
def test_runs_of_few_words(least):
    rng = random.Random(least)
    texts = [rng.choices("ab" if i % 2 else "abc", k=rng.randrange(80)) for i in range(150)]
    a, b = "a", "ab"
    while len(b) < 400:  # squares overlap everywhere in these
        a, b = b, b + a
    texts += [list(b), list("abaab" * 30), ["x"] * 200, list("aaaaaaaaab" * 20), (list("abcdefgh" * 3) + list("xy" * 9)) * 3]
    for _ in range(40):
        block = rng.choices("abcde", k=rng.randrange(1, 30))
        texts.append(rng.choices("abcde", k=10) + block * rng.randrange(2, 5) + block[: rng.randrange(len(block))] + rng.choices("abcde", k=10))
    runs, collapsed = periodic_runs._several([" ".join(t).encode() for t in texts], least)
    for words, found, rest in zip(texts, runs, collapsed):
        want = runs_brute(words, least)
        assert found == want, words
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert rest == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_very_long_texts():
    same, block = b"the " * 200_000, [b"w%d" % i for i in range(70_000)]
    runs, collapsed = periodic_runs._several([same, b" ".join(block * 3), b"a b " * 50_000 + b"c"], 12)
    assert runs == [[(0, 200_000, 1)], [(0, 210_000, 70_000)], [(0, 100_000, 2)]]
    assert collapsed == ["the", " ".join(w.decode() for w in block), "a b c"]


def test_runs_awkward(awkward, empty):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(awkward)))
    assert table(got, *RUN) == sorted((told_brute(*r) for r in rows), key=repr)
    assert periodic_runs.digests(periodic_runs.periodic_runs(empty)).count() == 0 and periodic_runs.planted(empty).count() == 0
