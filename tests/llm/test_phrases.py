"""Operator 11 against counting in Python, and its quicksort against plain prefixes."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from marketscope.llm import phrases as P

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in cand.items():
        if any(len(v) > len(w) and g == lang and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1)) and 100 * b >= 80 * a
               for (g, v), b in cand.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    result = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        result += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine)]
    return sorted(result)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def random_rows(rng, count):
    words = ["a", "B", "the", "ÉT", "é", "x-y", "of", " ", "q'", "\x1c"]
    seps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!\x0b", "\r\n"]
    return [("".join(w for _ in range(rng.randint(0, 30)) for w in (rng.choice(words), rng.choice(seps))), rng.choice(["en", "fr", None, ""]))
            for _ in range(count)]


@pytest.mark.parametrize("seed,least,hot,per_task", [(1, 3, 20_000, 500), (2, 5, 2, 100), (3, 2, 1, 300), (4, 30, 3, 10_000)])
def test_matches_counting(spark, monkeypatch, seed, least, hot, per_task):
    """Also with few words a task and thresholds that make most prefixes common (routed by three or all words)."""
    rng = random.Random(seed)
    rows = random_rows(rng, 120) + [("the of the of the of a", "en")] * 40 + [(None, "en"), ("", None), ("...", "fr")]
    monkeypatch.setattr(P, "HOT", hot)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    docs = docs.selectExpr("*", "1 as n", "'z' as phrase", "2 as words", "3 as cnt")
    assert rows_of(P.collocations(docs, least, words_per_task=per_task)) == brute(rows, least)


def test_small_bloom_filter_changes_nothing(spark, monkeypatch):
    rows = random_rows(random.Random(9), 80)
    monkeypatch.setattr(P, "BLOOM_MAX_BITS", 64)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert rows_of(P.collocations(docs, 3)) == brute(rows, 3)


def test_top_and_ties(spark):
    rows = [("b c. d e. a z", "en")] * 4
    got = rows_of(P.collocations(spark.createDataFrame(rows, "text string, lang string"), 4, top=2))
    assert [r[2] for r in got] == ["a z", "b c"] and {r[7] for r in got} == {1_000_000}


def test_empty_tables_and_long_text(spark):
    assert P.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert P.collocations(spark.createDataFrame([(None, None), (" .\n", "en")], "text string, lang string")).count() == 0
    text = "one two three four five " * 200_000
    got = rows_of(P.collocations(spark.createDataFrame([(text, "en")], "text string, lang string")))
    assert {r[3] for r in got} <= {200_000, 199_999} and {r[6] for r in got} == {1_000_000} and len(got) == 5


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 4, (400, 4)).astype(np.int32)
    for row, size in zip(codes, rng.integers(1, 5, 400)):
        row[size:] = -1
    weight = rng.integers(1, 6, 400)
    expected = Counter()
    for row, w in zip(codes.tolist(), weight.tolist()):
        for d in range(1, 5):
            if row[d - 1] >= 0:
                expected[tuple(row[:d])] += w
    for least in (1, 10, 50):
        got = {tuple(codes[p, :d].tolist()): n for p, d, n in P.multikey_quicksort(codes, weight, least)}
        assert got == {k: n for k, n in expected.items() if n >= least}
    assert P.multikey_quicksort(codes[:0], weight[:0], 1) == []
