"""Quality rules against plain counts, distances and references."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from candlewick.llm import quality_rules as q
from candlewick.llm.queries import op6_quality_rules

SCHEMA = "doc_id long, text string, lang string, kept string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(inside) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside), failed


def plain_kind(c):
    if c in " \t":
        return 0
    if c in "\n\r":
        return 1
    if ord(c) >= 0x80:
        return 5
    if c.islower():
        return 2
    if c.isupper():
        return 3
    if c.isdigit():
        return 4
    if c in ".,;:'\"-()?":
        return 6
    return 7 if 0x21 <= ord(c) < 0x7F else 8


def plain_distance(x, y):
    keys = set(x) | set(y)
    out = 0.0
    for side in (x, y):
        for k in keys:
            p, m = side.get(k, 0), (x.get(k, 0) + y.get(k, 0)) / 2
            out += p * math.log2(p / m) / 2 if p else 0
    return math.sqrt(max(0.0, out))


def shares(counts):
    n = sum(counts.values())
    return {k: v / n for k, v in counts.items()}


def plain_rows(rows, common=0.002):
    counts = q.Counts()
    bucket = lambda w: int(q.Counts.places(counts.words(w.encode())[0])[0])
    of = {w: bucket(w) for _, t, _ in rows for w in set(WORD.findall(t or ""))}
    kinds, words = defaultdict(Counter), defaultdict(Counter)
    for _, t, lang in rows:
        kinds[lang].update(map(plain_kind, t or ""))
        words[lang].update(of[w] for w in WORD.findall(t or ""))
    often = {lang: {b for b, n in c.items() if n >= common * sum(c.values())} for lang, c in words.items()}
    grouped = lambda lang, c: shares(Counter({b: n for b, n in c.items() if b in often[lang]}) + Counter({-1: sum(n for b, n in c.items() if b not in often[lang])}))
    out = []
    for i, t, lang in rows:
        base = plain_counts(t)
        k = w = None
        if base[0] >= 30:
            k = plain_distance(shares(Counter(map(plain_kind, t))), shares(kinds[lang]))
            w = plain_distance(grouped(lang, Counter(of[x] for x in WORD.findall(t))), grouped(lang, words[lang]))
        grown = 1 + 4.5 / math.sqrt(max(base[0], 1))
        kept = not base[-1] and (k is None or (k <= 0.2 * grown and w <= 0.26 * grown))
        out.append((i, *base, k, w, kept))
    return out


def agree(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert a[:7] == b[:7] and a[9] == b[9]
        assert a[7:9] == pytest.approx(b[7:9], abs=1e-6) if a[7] is not None else b[7] is b[8] is a[8] is None


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    agree([tuple(r) for r in op6_quality_rules(spark, sf).collect()], plain_rows(rows))


def test_follows_the_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = op6_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed and n_words >= 60").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.995 and got[got.quality == 0].kept.mean() < 0.2


def test_cases(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdé"), 3))
    rows = [(i, " ".join(word() for _ in range(40)) + ".\nA line here\n \nA line here", "xx") for i in range(20)]
    rows += [(50, None, "xx"), (51, "", None), (52, "  \n\n", None), (53, "a b c d e " * 9_000, None), (54, "#|<>" * 40, "yy")]
    rows += [(55, "\x0b\x1c\x85tab\tcr\r", "yy"), (56, "WORD!! " * 3 + " ".join(f"W{i}!!" for i in range(60)), "xx"), rows[0], (None, rows[1][1], "xx")]
    df = spark.createDataFrame([(i, t, lang, "clash", 1) for i, t, lang in rows], SCHEMA)
    agree([tuple(r) for r in q.judged(df).collect()], plain_rows(rows))
    assert q.judged(df.limit(0)).count() == 0
