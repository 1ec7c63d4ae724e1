"""The divergence audit against SQL and a plain version."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from candlewick.llm import divergence_audit
from candlewick.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def result(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def plain_audit(rows, least_docs=3, top=200, unit=10**9):
    """From rows (lang, source, text)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        own = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        counts[lang or "", source or ""].update(own)
        docs[lang or ""].update(own.keys())
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, d in docs[lang].items() if d >= least_docs]
        whole = Counter()
        for g, c in counts.items():
            if g[0] == lang:
                whole.update({t: c[t] for t in kept})

        def prices(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + unit * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: prices(c) for (x, s), c in counts.items() if x == lang}, prices(whole)
        for s in p:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in p if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, rank) for rank, (v, i) in enumerate(found, 1)]
    return sorted(out)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = sorted(tuple(r) for r in con.sql(f"select {', '.join(COLUMNS)} from ({ORACLE['op12_divergence_audit']})").fetchall())
    got = result(QUERIES["op12_divergence_audit"](spark, SMALL))
    assert got == want
    assert {r[2] for r in got} == {"pair", "term"}


def test_random_rows_equal_plain_version(spark, monkeypatch):
    monkeypatch.setattr(divergence_audit, "HELD_PAIRS", 5)
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}" for i in range(12)]
    rows = []
    for _ in range(150):
        lang, source = rng.choice(["x", "y"]), f"s{rng.integers(0, 6)}"
        weight = rng.random(12) ** (1 + int(source[1:]) % 3)
        rows.append((str(lang), source, " ".join(rng.choice(words, rng.integers(0, 12), p=weight / weight.sum()))))
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    for options in ({}, {"top": 2, "least_docs": 40, "unit": 1000}):
        assert result(divergence_audit.audit(docs, **options)) == plain_audit(rows, **options)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "a", "x y z"), ("", "a", "x y z"), (None, "b", "X y É_É é"), ("", None, "x-x x1x"), ("k", "a", ""), ("k", "b", None)]
    rows += [("l", "a", "long " * 50_000), ("l", "a", "long é日"), ("l", "b", "Long x  "), ("l", "b", "long long"), ("m", "a", "only one")]
    docs = spark.createDataFrame([(*r, 1, 2, "t") for r in rows], "lang string, source string, text string, n int, value int, term string")
    got = result(divergence_audit.audit(docs))
    assert got == plain_audit(rows)
    assert ("k", "a", "pair", "b", 0, 1) in got  # a language without kept terms
    assert result(divergence_audit.audit(docs.limit(0))) == []


def test_large_counts_are_exact(spark):
    n = 2 * 10**13  # more occurrences than a product of longs could price
    row = spark.createDataFrame([(n - 1, 3 * n, 7)], "c long, total long, terms long")
    got = row.select(divergence_audit.price(row.c, row.total, row.terms).alias("p")).first().p
    assert got == 1 + 10**9 * n // (3 * n + 7)


def test_tree_counts_rows_through_nodes():
    rows, times = [[1], [1, 2], [1, 2, 3], [1, 4], [2, 3], [2, 3]], [5, 1, 2, 3, 4, 6]
    flat = np.array([x for r in rows for x in r])
    offset = np.append(0, np.cumsum([len(r) for r in rows]))
    at, deep, count = divergence_audit.tree_nodes(offset, flat, np.array(times))
    start = {int(a): next(r for r, s in zip(rows, offset, strict=False) if s <= a < s + len(r)) for a in at}
    got = {tuple(start[int(a)][: d + 1]): int(c) for a, d, c in zip(at, deep, count, strict=True)}
    assert got == {(1,): 11, (1, 2): 3, (1, 2, 3): 2, (1, 4): 3, (2,): 10, (2, 3): 10}
