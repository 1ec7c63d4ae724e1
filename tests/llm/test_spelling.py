"""Spelling variants against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from candlewick.llm import spelling
from candlewick.llm.common import documents
from candlewick.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def plain_counts(rows, every=spelling.CUT_EVERY, least=spelling.LEAST_LETTERS) -> Counter:
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                out[run] += 1
    return out


def edits(a: str, b: str) -> int:
    """The edit distance, by the table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def plain_variants(rows, least_count=spelling.LEAST_COUNT, ratio=spelling.RATIO, **options):
    n = {w: c for w, c in plain_counts(rows, **options).items() if c >= least_count}
    gaps = {}  # words that may be near: equal but for one letter, or left out
    for w in n:
        for key in {w[:i] + "*" + w[i + 1 :] for i in range(len(w))} | {w[:i] + "*" + w[i:] for i in range(len(w) + 1)}:
            gaps.setdefault(key, []).append(w)
    near = {w: set() for w in n}
    for together in gaps.values():
        for a in together:
            near[a].update(b for b in together if b != a and abs(len(a) - len(b)) <= 1)
    near = {a: {b for b in bs if edits(a, b) == 1} for a, bs in near.items()}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in documents(spark, SMALL).select("doc_id", "text").collect()]
    got = result(QUERIES["op11_spelling"](spark, SMALL))
    assert got == plain_variants(rows)
    assert any(r[1] for r in got)


@pytest.mark.parametrize("symbols", [1, 3, 8])
def test_any_alphabet_and_block_size(spark, symbols):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abÀÿ"), rng.integers(3, 6))) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words, 30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    options = {"least_letters": 3, "least_count": 2, "ratio": 2}
    got = result(spelling.variants(docs, symbols=symbols, block_words=7, **options))
    assert got == plain_variants(rows, least=3, least_count=2, ratio=2)


def test_chain_leads_to_last_root(spark):
    text = " ".join(["abcdef"] * 1 + ["abcdeg"] * 5 + ["abcdgg"] * 25 + ["abcggg"] * 125 + ["abgggg"] * 625 + ["aggggg"] * 3125)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r[0]: r for r in result(spelling.variants(docs, cut_every=10**12, least_count=1))}
    assert {r[2] for r in got.values()} == {"aggggg"}
    assert got["abcdef"][1] == "abcdeg"


def test_odd_rows(spark):
    rows = [
        (None, "Straße straße STRAßE straße straße"), (None, None), (1, ""), (1, "÷×÷×÷×÷ " * 6), (1, "x" * 300 + " " + "x" * 301),
        (1, "tie_one" + " grabs grabbs" * 2), (2, "日本語日本語 abcdefĀghijkl"), (2, "ABCDEF abcdef abcdef abcdef abcdef abcdeF"),
    ]
    rows += [rows[4]] * 4  # repeated rows count each
    docs = spark.createDataFrame([(i, t, "a", 1, 1) for i, t in rows], "doc_id long, text string, word string, n int, r int")
    got = result(spelling.variants(docs))
    assert got == plain_variants(rows)
    assert {len(r[0]) for r in got} >= {6, 7, 300, 301}
    assert result(spelling.variants(docs.limit(0))) == []


def test_one_edit_and_neighbourhood():
    assert spelling.one_edit(b"abc", b"abd") and spelling.one_edit(b"abc", b"ab") and spelling.one_edit(b"bc", b"abc")
    assert not spelling.one_edit(b"abc", b"bcd") and not spelling.one_edit(b"abc", b"a")
    own = np.array([[1, 2, 2]], dtype=np.uint64)
    made = set(spelling.neighbourhood(own, 3).ravel().tolist())
    want = {(1, 2), (2, 2)}
    for s in (1, 2, 3):
        want |= {tuple([*w[:i], s, *w[i:]]) for w in [(1, 2, 2)] for i in range(4)}
        want |= {tuple([*w[:i], s, *w[i + 1 :]]) for w in [(1, 2, 2)] for i in range(3)}
    assert made == {int(spelling.beginnings(np.array([w], dtype=np.uint64))[0, -1]) for w in want}
